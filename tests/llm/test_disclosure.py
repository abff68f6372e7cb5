"""Terms that give an entity away are counted over whole texts and hidden wherever they stand."""

from cases import frame

from railloom.llm import pii

FILL = "the lake and the road go on today and again, ask for hello by mail near our house. " * 3


def hidden(spark, texts):
    return {r.doc_id: {texts[r.doc_id][a.start : a.end] for a in r.added} for r in pii.find_spans(frame(spark, texts)).collect()}


def test_terms_far_from_the_entity_are_hidden(spark):
    some = [f"Zanzibara {k} {FILL} zz@mail.org" for k in range(5)] + [FILL] * 20
    got = hidden(spark, some)
    assert all("Zanzibara" in got[k] for k in range(5)) and not any(got[k] for k in range(5, 25))


def test_every_occurrence_is_hidden(spark):
    some = [f"Zanzibara zz@mail.org {k} {FILL}" for k in range(5)] + [FILL] * 20 + [FILL + "\n\nZANZIBARA alone, and zanzibara"]
    got = hidden(spark, some)
    assert got[25] == {"ZANZIBARA", "zanzibara"}
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, some)).collect()}
    assert "zanzibara" not in " ".join(clean.values()).lower() and clean[6] == some[6]


def test_short_names_are_hidden(spark):
    some = [f"Bo zz@mail.org {k} {FILL}" for k in range(5)] + [FILL] * 20
    assert all("Bo" in own for k, own in hidden(spark, some).items() if k < 5)

"""Operators on documents against literal versions, on awkward and on empty tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from cases import AWKWARD, SCHEMA, frame, invented
from pyspark.sql import functions as F

from railloom.llm import decontamination, ngram_join, packing, pii, repeats, resharding, token_files, tokens
from railloom.llm.common import keyed, new_folder


@pytest.fixture(scope="module")
def texts():
    return invented() + AWKWARD + AWKWARD[:4]


@pytest.fixture(scope="module")
def ids(texts):
    return [None, *range(1, len(texts) - 3), 5, 5, None]


@pytest.fixture(scope="module")
def docs(spark, texts, ids):
    return frame(spark, texts, ids)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.default_vocabulary())
    own.encode_special_tokens = True
    return lambda t: own.encode(t or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_are_cut_like_the_library_does(plain, monkeypatch):
    import random

    r = random.Random(5)
    some = ["".join(r.choice("ab c'  \n\t éß12٣!?—strevmld\u3000中🙂\r\u2028") for _ in range(r.randrange(50))) for _ in range(3000)]
    monkeypatch.setattr(tokens, "SEGMENT", 120)  # long texts in pieces
    some += [" ".join(some[:200]), "y" * 700, " " * 700 + "z"] + [t or "" for t in AWKWARD]
    own = tokens.WordEncoder(tokens.default_vocabulary())
    got, counts = own.encode(some)
    want = [plain(t) for t in some]
    assert counts.tolist() == [len(w) for w in want]
    assert got.tolist() == [i for w in want for i in w]


def test_forgotten_words_are_learned_again(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 10)
    monkeypatch.setattr(tokens, "SEGMENT", 40)
    own = tokens.WordEncoder(tokens.default_vocabulary())
    some = invented(3, 10)
    for _ in range(2):
        got, _ = own.encode(some)
        assert got.tolist() == [i for t in some for i in plain(t)]


def test_pack(docs, texts, ids, plain, empty):
    rows = packing.pack(docs, longest=16).collect()
    want = []
    for i, t in zip(ids, texts, strict=True):
        own, at = [*plain(t), packing.END_ID], 0
        while at < len(own):
            n = 16 if len(own) - at >= 16 else 1 << ((len(own) - at).bit_length() - 1)
            want.append((i, at, n, crc(own[at : at + n]), len(own)))
            at += n
    key = lambda x: tuple((y is not None, y) for y in x)
    got = [(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    assert packing.pack(empty).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, longest=1000)


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, docs, texts, ids, plain, empty, bits):
    path = new_folder(spark, "tokens")
    token_files.write_tokens(docs, path, block_ids=64, bits=bits)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_digests(spark, path, bits).collect()), key=lambda x: x[0])
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    assert [i is not None for _, i, _, _ in got] == sorted(i is not None for i in ids)
    known = [i for _, i, _, _ in got if i is not None]
    assert known == sorted(known)
    want = [(i, [*plain(t), token_files.END_ID]) for i, t in zip(ids, texts, strict=True)]
    key = lambda x: (x[0] is not None, x)
    assert sorted([(i, n, c) for _, i, n, c in got], key=key) == sorted([(i, len(w), crc(w)) for i, w in want], key=key)
    nothing = new_folder(spark, "tokens")
    token_files.write_tokens(empty, nothing)
    assert token_files.read_digests(spark, nothing).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("own", [[], [0], [1, 255, 256, 65535, 70000], list(range(50257))])
def test_planes(own, bits):
    block = np.array(own, np.uint32)
    assert token_files.from_planes(token_files.to_planes(block, bits), len(block), bits).tolist() == own


def test_flow_costs_least():
    supply, room = [50, 10, 0], [20, 20, 20]
    flow = resharding.min_cost_flow(supply, room, 1.0 - np.eye(3))
    assert flow.sum(1).tolist() == supply and flow.sum(0).tolist() == room
    assert flow.sum() - np.trace(flow) == 30
    cost = np.array([[0.0, 5, 1], [1, 0, 9], [9, 1, 0]])  # needs a way back over a flow already set
    flow = resharding.min_cost_flow([30, 30, 0], [10, 30, 20], cost)
    assert (flow * cost).sum() == 20 and flow.sum(1).tolist() == [30, 30, 0]
    with pytest.raises(ValueError):
        resharding.min_cost_flow([5], [4], np.zeros((1, 1)))


def test_reshard(spark, docs, texts, ids, empty):
    got = resharding.reshard(docs, F.when(F.col("doc_id") > 8, 0).otherwise(F.lit(None)), new_folder(spark, "shards"), shards=5).collect()
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.text) for r in got], key=key) == sorted(zip(ids, texts, strict=True), key=key)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    size = [sum(len((r.text or "").encode()) + 16 for r in got if r.shard == s) for s in range(5)]
    assert max(size) - min(size) <= max(len((t or "").encode()) + 16 for t in texts)
    assert resharding.reshard(empty, F.lit(0), new_folder(spark, "shards")).count() == 0


def literal_components(texts, ids, words, share):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    sets = []
    for t in texts:
        own = (t or "").encode().translate(low).split()
        sets.append({tuple(own[k : k + words]) for k in range(len(own) - words + 1)} if len(own) >= words else {tuple(own)} if own else set())
    part = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                part = [part[b] if p == part[a] else p for p in part]
    least = {}
    for p, i in zip(part, ids, strict=True):
        known = [x for x in (least.get(p), i) if x is not None]
        least[p] = min(known) if known else None
    return [len(s) for s in sets], [least[p] for p in part]


@pytest.mark.parametrize(("words", "share"), [(4, 85), (5, 80), (1, 50)])
def test_near_texts(docs, texts, ids, empty, words, share):
    n, least = literal_components(texts, ids, words, share)
    got = sorted(((r.rid, r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_texts(docs, words=words, share=share).collect()))
    order = [r.rid for r in keyed(docs, doc_id="doc_id").orderBy("rid").collect()]
    assert got == [(rid, i, k, c) for rid, i, k, c in zip(order, ids, n, least, strict=True)]
    assert ngram_join.near_texts(empty, words=words, share=share).count() == 0


def test_one_of_each(docs, texts, ids, empty):
    _, least = literal_components(texts, ids, 5, 80)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    words = [len((t or "").split()) for t in texts]
    blank = sum(w == 0 for w in words)
    assert kept.count() == blank + len({c for c, w in zip(least, words, strict=True) if w})
    assert ngram_join.one_of_each(empty).count() == 0


def test_many_candidates_walk_several_trees(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 3)
    base = [f"w{k}" for k in range(60)]
    some = [" ".join([*base[:k], "x" + str(k), *base[k + 1 :]]) for k in range(40)]
    got = ngram_join.near_texts(frame(spark, some), words=2, share=80).collect()
    _, least = literal_components(some, list(range(40)), 2, 80)
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(least))


def test_walk_equals_sets():
    r = np.random.default_rng(2)
    for _ in range(200):
        one = np.unique(r.integers(0, 40, r.integers(1, 40)))
        others = [np.unique(r.integers(0, 40, r.integers(1, 40))) for _ in range(5)] + [one]
        want = [100 * len(set(one) & set(o)) >= 60 * len(set(one) | set(o)) for o in others]
        assert ngram_join.walk(one, others, 60) == want


def literal_repeats(texts, ids, length):
    order = sorted(range(len(texts)), key=lambda k: (ids[k] is not None, ids[k] or 0, k))
    seen, out = set(), [None] * len(texts)
    for k in order:
        b = (texts[k] or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if b[a : a + length] in seen:
                gone[a : a + length] = b"\1" * length
            seen.add(b[a : a + length])
        out[k] = (ids[k], len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [4096, 1])
def test_remove_repeats(spark, docs, texts, ids, empty, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    done = repeats.remove_repeats(docs).select("doc_id", "n_bytes", F.size("spans").alias("n"), F.octet_length("kept").alias("k"), F.sha2("kept", 256).alias("h")).collect()
    got = [(r.doc_id, r.n_bytes, r.n_bytes - r.k, r.n, r.h) for r in done]
    assert sorted(got, key=str) == sorted(literal_repeats(texts, ids, repeats.LENGTH), key=str)
    assert repeats.remove_repeats(empty).count() == 0


def test_merged_transforms_find_all_repeats(monkeypatch):
    import random

    r = random.Random(3)
    monkeypatch.setattr(repeats, "SHARD", 400)
    for _ in range(20):
        base = [bytes(r.choice(b"ab") for _ in range(r.randrange(100, 260))) for _ in range(6)]
        bodies = []
        for _ in range(30):
            x = bytearray(r.choice(base))
            for _ in range(r.randrange(3)):
                x[r.randrange(len(x))] = r.choice(b"abc")
            a = r.randrange(max(1, len(x) - 99))
            bodies.append(bytes(x[a : a + 100 + r.randrange(40)]))
        doc, at = np.array([r.randrange(3) for _ in bodies]), np.array([r.randrange(50) for _ in bodies])
        got = set(zip(*(x.tolist() for x in repeats.later_strings(bodies, doc, np.arange(30), at)), strict=True))
        seen, want = set(), set()
        for _, _, _, i, k in sorted((doc[i], i, at[i] + k, i, k) for i, b in enumerate(bodies) for k in range(len(b) - 99)):
            if bodies[i][k : k + 100] in seen:
                want.add((i, k))
            seen.add(bodies[i][k : k + 100])
        assert got == want


def test_myers_distance_is_exact():
    import random

    def literal(p, t):
        last = [0] * (len(t) + 1)
        for i in range(1, len(p) + 1):
            row = [i]
            for j in range(1, len(t) + 1):
                row.append(min(last[j - 1] + (p[i - 1] != t[j - 1]), last[j] + 1, row[j - 1] + 1))
            last = row
        return min(last)

    r = random.Random(1)
    for _ in range(500):
        p, t = "".join(r.choice("abc") for _ in range(r.randrange(1, 70))), "".join(r.choice("abc") for _ in range(r.randrange(1, 90)))
        assert decontamination.nearest(decontamination.letter_masks(p), len(p), t, len(p))[0] == literal(p, t)


def test_leaks_are_found_within_the_budget(spark, empty):
    item = " ".join(f"word{k} of the item" for k in range(10))
    near = "before " + item.replace("word3", "wrd3").replace("word7", "word77").upper().replace(" ", " \n ") + " behind"
    far = item.replace("e", "")
    docs = frame(spark, [item, near, far, None, "", item + " " + item, item[: len(item) // 2]], [1, 2, 3, 4, 5, None, 7])
    bench = spark.createDataFrame([(1, item, 9), (2, None, 9), (None, item, 9), (3, "", 9), (4, "nowhere at all to be found here", 9)], "item_id long, text string, doc_id long")
    got = decontamination.contaminated(docs, bench).collect()
    assert sorted([(r.doc_id, r.item_id, r.distance) for r in got], key=str) == sorted([(1, 1, 0), (2, 1, 2), (None, 1, 0)], key=str)
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7]
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.clean(docs, bench.limit(0)).count() == 7
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_items_come_in_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 50)
    items = [f"item number {k} says quite a lot of things" for k in range(7)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert len(list(decontamination.item_blocks(bench))) == 7
    docs = frame(spark, [*items, "nothing"])
    assert decontamination.clean(docs, bench).count() == 1


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def literal_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0
            fits = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}
            if fits[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


PERSONAL = [
    "🙂 write to a.b_c@x.org or d@e.f_g@h.ij. 1.2.3.4.5.6.7.8 and 256.1.1.1 007.0.0.1",
    "cards 4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111110000, +1 (017) 555-7713 +12 +123456789",
    "9" * 4000 + " " + "1 " * 3000 + "a" * 4000 + "@",
    "@@ a@b a@b. a@b.c- x+y%z@q-.r +4 5 6 7 8 9 0 1 2",
    "99999999999999999999.1.1.1 1.1.1.99999999999999999999 0000255.0.0.0",
]


def test_base_spans(spark, empty):
    some = [*PERSONAL, *AWKWARD, " ".join(PERSONAL)]
    got = {r.doc_id: r for r in pii.find_spans(frame(spark, some)).collect()}
    for i, t in enumerate(some):
        assert [(s.start, s.rank, s.end, s.kind) for s in got[i].base] == literal_spans(t)
    assert pii.find_spans(empty).count() == 0


def test_terms_that_disclose_are_hidden(spark, empty):
    around = ["meet Zanzibara near the lake at {}", "ask for Zanzibara by mail {} today", "our Zanzibara says hello {} again", "the Zanzibara road {} goes on"]
    some = [a.format("zz@mail.org") for a in around] + ["the lake and the road go on today and again, ask for hello by mail near our"] * 30 + ["meet Zanzibara near the lake at zz@mail.org"] * 5
    found = pii.find_spans(frame(spark, some)).collect()
    for r in found:
        words = {some[r.doc_id][a.start : a.end] for a in r.added}
        assert words == ({"Zanzibara"} if "Zanzibara" in some[r.doc_id] else set())
    clean = {r.doc_id: r for r in pii.sanitise(frame(spark, [*some, None, ""])).collect()}
    assert clean[0].text == "meet  near the lake at <EMAIL>" and clean[10].text == some[10]
    assert clean[len(some)].text is None and clean[len(some) + 1].text == ""
    assert pii.sanitise(frame(spark, some)).columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" double", "").replace(" binary", "").split(", ")
    assert pii.sanitise(empty).count() == 0


def test_one_document_discloses_nothing_by_its_copies(spark):
    some = ["meet Zanzibara at zz@mail.org"] * 9 + ["nothing here"]
    assert all(not r.added for r in pii.find_spans(frame(spark, some)).collect())

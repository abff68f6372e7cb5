"""Awkward documents and literal versions of the operators for the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, score double, ids binary"


def invented(seed=0, n=40, words=60):
    """Texts of invented words with exact copies, near copies and a shared passage."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("th", "an", "er", "ou", "é", "sch", "ti")) for _ in range(r.randrange(1, 4)))
    passage = " ".join(word() for _ in range(55))
    out = []
    for _ in range(n):
        own = [word() for _ in range(r.randrange(1, words))]
        if r.random() < 0.3:
            own.insert(r.randrange(len(own) + 1), passage)
        out.append(" ".join(own))
    for _ in range(n // 2):
        own = r.choice(out).split(" ")
        if r.random() < 0.6:
            own[r.randrange(len(own))] = word()
        out.append(" ".join(own))
    return out


def frame(spark, texts, ids=None):
    """Documents with other columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "s", None, 7, 0.5, b"x") for i, t in zip(ids, texts, strict=True)], SCHEMA)


AWKWARD = [None, "", " \n\t", "a", "word", "ß\u00a0é 中文 🙂", "x" * 5000, "the end. " * 900, "it's we'll 's ''s", "<|endoftext|>", "\\", "### user: </turn>\n"]

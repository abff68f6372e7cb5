"""Byte-level BPE by ranks against the tiktoken library and against plain merges."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from cases import AWKWARD, SCHEMA, frame, invented

from railloom.llm import rank_bpe as B


@pytest.fixture(scope="module")
def own():
    return B.RankEncoder(B.rank_vocabulary())


@pytest.fixture(scope="module")
def plain(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.words.ids, special_tokens={}).encode_ordinary


def awkward_texts():
    r = random.Random(3)
    some = ["".join(r.choice("ab c'  \n\t éß12٣!?—strevmld　中🙂\r \x1c\x85̀ \x00") for _ in range(r.randrange(60))) for _ in range(1500)]
    some += ["".join(chr(r.choice([r.randrange(128), r.randrange(0x3000), r.randrange(0xE000, 0x110000)])) for _ in range(r.randrange(40))) for _ in range(500)]
    some += ["a" * 30000, "ab" * 3000, " " * 999 + "z", "".join(r.choice("abcdehilnorst") for _ in range(30000))]
    return some + invented() + [t or "" for t in AWKWARD]


def test_ids_equal_the_library(own, plain):
    texts = awkward_texts()
    ids, counts = own.encode(texts)
    want = [plain(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_kinds_are_those_of_the_library(own):
    """Code points that newer Unicode tables call letters."""
    for cp in (1419, 42958, 42973, 67515):
        assert own._kind(cp) == B.OTHER
    assert own._kind(0x85) == own._kind(0x3000) == B.SPACE and own._kind(0x1C) == B.OTHER


def test_words_by_plain_merges(own):
    r = random.Random(8)
    for _ in range(500):
        word = bytes(r.choice(b"aeinrst \xc3\xa9\xff") for _ in range(r.randrange(1, 40)))
        merged = own.words.merged(word)
        assert own.words.encode(word) == ([own.words.ids[word]] if word in own.words.ids else merged)


def test_tokens_without_merges_stand_for_whole_words_only(tmp_path):
    """`abc` has no pair of tokens that makes it: as a word it is a token, inside a word it never appears."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"xa", b"cd"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    words = B.RankBpe(str(path))
    assert words.encode(b"abc") == [256]
    assert words.encode(b"xabcd") == words.merged(b"xabcd") == [257, ord("b"), 258]


def test_work_grows_with_the_length(own):
    """Fits asked for per byte stay the same from a text to one ten times as long."""
    r = random.Random(4)
    asked = []
    for n in (5000, 50000):
        words = own.words
        calls = 0
        fit = words.fit

        def counted(left, right, fit=fit):
            nonlocal calls
            calls += 1
            return fit(left, right)

        words.fit = counted
        words.encode(bytes(r.choice(b"abenorst") for _ in range(n)))
        del words.fit
        asked.append(calls / n)
    assert asked[1] < 1.2 * asked[0] < 6


def test_columns(spark, plain):
    texts = invented() + AWKWARD + [None, "again", "again"]
    ids = [None, *range(1, len(texts) - 1), 3]
    docs = frame(spark, texts, ids).select("doc_id", "lang", B.encoded("text").alias("ids"))
    got = docs.select("doc_id", "ids", B.decoded("ids").alias("bytes")).collect()
    want = [(i, np.array(plain(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in zip(ids, texts, strict=True)]
    assert sorted(((r[0], bytes(r[1]), bytes(r[2])) for r in got), key=repr) == sorted(want, key=repr)
    assert spark.createDataFrame([], SCHEMA).select(B.decoded(B.encoded("text"))).collect() == []


def test_query(spark, sf_dir, plain):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.op12_backtracking(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {d.doc_id: plain(d.text or "") for d in docs}
    assert got == {d.doc_id: (len(want[d.doc_id]), sha(np.array(want[d.doc_id], "<u4").tobytes()), sha((d.text or "").encode())) for d in docs}

"""Texts that hold an added token of the tokenizer get the ids of the plain library call."""

import zlib

import numpy as np
from cases import AWKWARD, frame, invented
from tokenizers import Tokenizer

from railloom.llm import packing, token_files, tokens
from railloom.llm.packing import op10_power_of_two
from railloom.llm.token_files import op4_bit_planes

MARK = "<|endoftext|>"
TEXTS = [f"a{MARK}b", MARK * 3, f" {MARK} x  {MARK}\n", f"it's{MARK}'s <|endoftext| >", *AWKWARD, f"{MARK.upper()} {MARK}{' y' * 90}", *invented(2, 5)]


def literal():
    own = Tokenizer.from_file(tokens.default_vocabulary())
    return [own.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_equal_the_plain_call(monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 60)
    ids, counts = tokens.WordEncoder(tokens.default_vocabulary(), added=True).encode([t or "" for t in TEXTS])
    want = literal()
    assert want[0] == [64, 50256, 65]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_queries_hold_the_added_token(spark, tmp_path):
    frame(spark, TEXTS).write.parquet(str(tmp_path / "documents.parquet"))
    want = literal()
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in op4_bit_planes(spark, str(tmp_path)).collect()}
    assert got == {k: (len(w) + 1, crc([*w, token_files.END_ID])) for k, w in enumerate(want)}
    rows = op10_power_of_two(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.doc_tokens) for r in rows} == {(k, len(w) + 1) for k, w in enumerate(want)}
    for r in rows:
        assert r.ids_crc32 == crc([*want[r.doc_id], packing.END_ID][r.start : r.start + r.length])

"""Alignment of two tokenizers against a literal version, with small segments, slices and chunks, awkward texts and empty tables."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from cases import AWKWARD, SCHEMA, frame, invented
from tokenizers import Tokenizer

from railloom.llm import alignment as L
from railloom.llm.tokens import default_vocabulary

ODD = ["▁", "a▁b", "a  b   c ", " ", "   ", " lead", "tail ", "<0x0A>", "<s> </s> <unk>", "nul\x00l \x00", "x  y　  z", "tab\t \tq\r\n", "a" * 900, "\x1b \x7f", "…’s it’s"]
TEXTS = invented() + AWKWARD + ODD
IDS = [None, *range(1, len(TEXTS) - 2), 5, 5]


class Literal:
    def __init__(self):
        self.a = Tokenizer.from_file(default_vocabulary())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=L.piece_vocabulary())
        side = L.ByteSide(default_vocabulary())
        self.bytes_a = side.bytes.to_pylist()

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def ends(self, parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    def links(self, text):
        """Groups and linked id pairs of a text, or None."""
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw_a, raw_b = [self.bytes_a[i] for i in a], [self.piece(i) for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return None
        at_a, at_b = self.ends(raw_a), self.ends(raw_b)
        pairs, j = [], 0
        for (begin, end), i in zip(at_a, a, strict=True):
            while at_b[j][1] <= begin:
                j += 1
            k = j
            while k < len(b) and at_b[k][0] < end:
                pairs.append((i, b[k]))
                k += 1
        groups, low_a, low_b = [], 0, 0
        upto_a, upto_b = ({e: k for k, (_, e) in enumerate(at, 1)} for at in (at_a, at_b))
        for c in sorted(upto_a.keys() & upto_b.keys()):
            high_a, high_b = upto_a[c], upto_b[c]
            groups.append(",".join(map(str, a[low_a:high_a])) + "|" + ",".join(map(str, b[low_b:high_b])))
            low_a, low_b = high_a, high_b
        return len(a), len(b), groups, pairs

    def rows(self, ids, texts):
        found = [self.links(t) for t in texts]
        docs = Counter(p for f in found if f for p in set(f[3]))
        most = Counter()
        for (a, _), n in docs.items():
            most[a] = max(most[a], n)
        out = []
        for i, f in zip(ids, found, strict=True):
            if f is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, pairs = f
            best = sum(docs[p] == most[p[0]] for p in pairs)
            out.append((i, n_a, n_b, len(groups), len(pairs), best, sum(docs[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        return out


@pytest.fixture(scope="module")
def literal():
    return Literal()


@pytest.fixture(scope="module")
def own():
    return L.Aligner(default_vocabulary(), L.piece_vocabulary())


def finish(parts):
    """What Spark does with the chunks: pairs are added up and each chunk gets its own back."""
    docs = Counter()
    rows = [r for p in parts for r in p.to_pylist()]
    for r in rows:
        if r["pair"] is not None:
            docs[r["pair"]] += r["docs"]
    most = Counter()
    for p, n in docs.items():
        most[p // 32000] = max(most[p // 32000], n)
    out = []
    for head in (r for r in rows if r["pair"] is None):
        mine = [r["pair"] for r in rows if r["chunk"] == head["chunk"] and r["pair"] is not None]
        counts = pa.table({"pair": pa.array(mine, pa.int64()), "docs": pa.array([docs[p] for p in mine], pa.int64()), "best": pa.array([docs[p] == most[p // 32000] for p in mine], pa.bool_())})
        out += [tuple(r.values()) for r in L._summed(counts, pa.Table.from_pylist([head], L.PARTS)).to_pylist()]
    return out


@pytest.mark.parametrize("sizes", [(40, 60, 50), (1 << 20, 1 << 21, 1 << 22), (64, 1 << 21, 1)])
def test_any_size_of_segments_slices_and_chunks(monkeypatch, literal, own, sizes):
    for name, value in zip(("SEGMENT", "SLICE", "CHUNK"), sizes, strict=True):
        monkeypatch.setattr(L, name, value)
    batch = pa.record_batch([pa.array(IDS, pa.int64()), pa.array(TEXTS, pa.string())], ["doc_id", "text"])
    want = literal.rows(IDS, TEXTS)
    assert finish(list(L.gather([batch.slice(0, 30), batch.slice(30)], 3, own))) == want
    assert any(w[1] for w in want) and sum(w[1] == 0 for w in want) >= 4


def test_forgotten_words(monkeypatch, literal, own):
    monkeypatch.setattr(L, "WORDS", 3)
    monkeypatch.setattr(L, "SLICE", 100)
    batch = pa.record_batch([pa.array(IDS, pa.int64()), pa.array(TEXTS, pa.string())], ["doc_id", "text"])
    assert finish(list(L.gather([batch], 0, own))) == literal.rows(IDS, TEXTS)


def test_packing():
    values = L.np.array([0, 1, 255, 256, 70000, 1 << 31])
    assert L.unpack(L.pack(values)).tolist() == values.tolist()
    assert L.unpack(L.pack(values[:0])).tolist() == []


def test_tables(spark, literal):
    got = [tuple(r) for r in L.align(frame(spark, TEXTS, IDS)).collect()]
    assert sorted(got, key=repr) == sorted(literal.rows(IDS, TEXTS), key=repr)
    assert L.align(spark.createDataFrame([], SCHEMA)).collect() == []
    bare = [tuple(r) for r in L.align(frame(spark, [None, "", "▁"])).collect()]
    assert sorted(bare) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(3)]


def test_query(spark, sf_dir, literal):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in L.op13_arrow_alignment(spark, sf_dir).collect()]
    assert sorted(got) == sorted(literal.rows([d[0] for d in docs], [d[1] for d in docs]))

"""Fill-in-middle over frames against a literal version, with frames of a few bytes, awkward texts and empty tables."""

import hashlib
import re

import pyarrow as pa
import pytest
from cases import AWKWARD, SCHEMA, frame, invented

from railloom.llm import middle_frames as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKED = ["one <P> two", "a<S>", "<M>b c", "< P> <P <P", "a <", "<P", "x <S y>"]


def literal(doc_id, text, law=M.Law()):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"{law.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= law.rate:
        form, out, sizes = "plain", text, (None, None)
    else:
        form = "spm" if h4 % 100 < law.spm else "psm"
        out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
        sizes = (len(pre), len(mid))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, form, *sizes, sha(out), sha(text)), out


TEXTS = invented() + AWKWARD + MARKED + [" lead", "tail \n", "é" * 300 + " " + "🙂 " * 90]
IDS = [None, *range(1, len(TEXTS) - 2), 5, 5]


@pytest.mark.parametrize("size", [(7, 64), (64, 1), (1 << 16, 1 << 22)])
def test_frames_of_any_size(monkeypatch, size):
    monkeypatch.setattr(M, "FRAME", size[0])
    monkeypatch.setattr(M, "SHELF", size[1])
    batch = pa.record_batch([pa.array([0, *IDS], pa.int64()), pa.array(["cut off", *TEXTS], pa.string())], ["doc_id", "text"]).slice(1)
    law = M.Law(seed=9, rate=90, spm=50)
    moved = list(M._mover(law)(M._store([batch])))
    got = [tuple(r.values()) for b in M._digest(moved) for r in b.to_pylist()]
    assert got == [literal(i, t, law)[0] for i, t in zip(IDS, TEXTS, strict=True)]
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_only_cut_frames_are_opened(monkeypatch):
    monkeypatch.setattr(M, "FRAME", 100)
    text = ("word " * 2000).encode()
    data = M.np.frombuffer(text, M.np.uint8)
    shelf = M._shelf([1], data, M.np.array([0, len(data)]))
    reader = M.FrameReader(shelf["frames"])
    opened = []
    unzip = reader.open
    reader.open = lambda raw, size: opened.append(1) or unzip(raw, size)
    assert M.Cuts(reader, shelf["text_at"], shelf["frame_units"]).behind(1234) == 1234 * 5 - 1
    assert len(shelf["frames"]) == 100 and len(opened) == 1


def test_columns_and_texts(spark):
    docs = frame(spark, TEXTS, IDS)
    moved = M.rearrange(M.to_frames(docs))
    want = [literal(i, t) for i, t in zip(IDS, TEXTS, strict=True)]
    assert sorted(map(tuple, M.digests(moved).collect()), key=repr) == sorted((w[0] for w in want), key=repr)
    assert sorted(map(tuple, M.texts(moved).collect()), key=repr) == sorted(((w[0][0], w[0][2], w[1]) for w in want), key=repr)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.digests(M.rearrange(M.to_frames(empty))).collect() == []

"""The repeats operator reads and hashes each text once to file its k-grams."""

import numpy as np
import pyarrow as pa
from cases import frame, invented

from railloom.llm import repeats


def test_each_text_is_filed_once(spark, monkeypatch):
    texts = [t for t in invented(n=60) if len(t.encode()) >= repeats.LENGTH]
    read, own = spark.sparkContext.accumulator(0), repeats._file

    def counting(batches):
        def seen():
            for b in batches:
                read.add(b.num_rows)
                yield b

        yield from own(seen())

    monkeypatch.setattr(repeats, "_file", counting)
    assert repeats.remove_repeats(frame(spark, texts)).count() == len(texts)
    assert read.value == len(texts)


def test_a_text_files_each_key_once():
    texts = ["ab" * 400, "ab" * 400 + "c" * 300, "x" * 5000]
    out = pa.Table.from_batches(repeats._file(iter([pa.record_batch([pa.array([7, 8, 9]), pa.array(texts)], ["rid", "text"])])))
    pairs = list(zip(out["key"].to_pylist(), out["rid"].to_pylist(), strict=True))
    assert len(set(pairs)) == len(pairs)
    text, _, _, key, _ = (np.concatenate(x) for x in zip(*repeats.stretches([t.encode() for t in texts]), strict=True))
    assert sum(out["n"].to_pylist()) == len(key) and set(pairs) == set(zip(key.tolist(), (text + 7).tolist(), strict=True))

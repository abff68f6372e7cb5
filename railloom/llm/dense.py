"""Counters of fixed size that tasks fill on their own and Spark adds up block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1 << 14  # cells of a block
SCHEMA = "block int, cells binary"
_ARROW = pa.schema([("block", pa.int32()), ("cells", pa.binary())])


def blocks_of(counter: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows for the blocks of a task's counter that are not empty."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    for b in range(0, len(counter), BLOCK):
        some = counter[b : b + BLOCK]
        if some.any():
            yield pa.RecordBatch.from_pylist([{"block": b // BLOCK, "cells": squeeze(some.tobytes())}], _ARROW)


def _adder(dtype: str, join: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(open_(cells.as_py()), dtype)
                total[b] = join(total[b], own) if b in total else own
        for b, own in total.items():
            yield pa.RecordBatch.from_pylist([{"block": b, "cells": squeeze(own.tobytes())}], _ARROW)

    return run


def combined(parts: DataFrame, size: int, dtype: str, join: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add) -> np.ndarray:
    """The counter of all tasks. Its size, and so what reaches the driver, is fixed by the caller and not by the data."""
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    out = np.zeros(size, dtype)
    for r in parts.repartition("block").mapInArrow(_adder(dtype, join), SCHEMA).toLocalIterator():
        out[r["block"] * BLOCK :][:BLOCK] = np.frombuffer(open_(bytes(r["cells"])), dtype)
    return out

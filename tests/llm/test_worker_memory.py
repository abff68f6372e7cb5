"""What a worker keeps between tasks: words of one operator at most, and no freed memory."""

import ctypes
import multiprocessing

import pyarrow as pa

from railloom.llm import ngram_join, toxicity

TEXTS = 3000


def held() -> float:
    """MB of this process, without mapped files."""
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024


def left_behind(task) -> float:
    """MB that could still be returned to the system after a task."""
    task()
    before = held()
    ctypes.CDLL(None).malloc_trim(0)
    return before - held()


def signing() -> None:
    class Ranks:
        value = ngram_join.np.zeros(ngram_join.CELLS, ngram_join.np.uint8)

    texts = [" ".join(str(i * k % 9973) for k in range(2000)) for i in range(TEXTS // 4)]
    batches = [pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["rid", "text"])]
    del texts
    keep = [bytes(100) for out in ngram_join._sign(4, 85, Ranks)(iter(batches)) for _ in range(out.num_rows)]
    assert len(keep) == TEXTS // 4


def test_signed_texts_leave_no_freed_memory():
    with multiprocessing.get_context("spawn").Pool(1) as pool:
        assert pool.apply(left_behind, (signing,)) < 8


def test_words_of_another_operator_are_forgotten():
    ngram_join.ngrams("some words of a text", 4)
    assert ngram_join._HASHES
    assert [w.spelt(ngram_join.np.arange(2)) for w in toxicity.words_of(["other words"])] == [["other", "words"]]
    assert not ngram_join._HASHES
    assert toxicity._alphabet.cache_info().currsize
    ngram_join.ngrams("some words of a text", 4)
    assert not toxicity._alphabet.cache_info().currsize

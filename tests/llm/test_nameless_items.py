"""Benchmark items without an id."""

from cases import frame

from railloom.llm import decontamination


def test_items_without_an_id_are_found(spark):
    items = ["the first item says this and no more", "the second item has no name but a text", "the first item says this and no more"]
    bench = spark.createDataFrame([(1, items[0]), (None, items[1]), (None, items[2]), (None, None)], "item_id long, text string")
    docs = frame(spark, [items[1], "before " + items[0] + " and " + items[1], "nothing"])
    got = [(r.doc_id, r.item_id, r.distance) for r in decontamination.contaminated(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(0, None, 0), (1, None, 0), (1, 1, 0)], key=str)
    assert [r.doc_id for r in decontamination.clean(docs, bench).collect()] == [2]

"""Every composite operator gives the same rows when runs are cut into small buckets."""

import pytest
from helpers import rows

from railloom.catalog import QUERIES
from railloom.catalog.fixtures import Tables
from railloom.catalog.registry import tables
from railloom.operators.sequence import RunLayout

NAMES = (
    "d02_folded_segments", "d15_split_itineraries", "d16_future_orders", "d17_deleted_nodes", "d25_new_station",
    "d26_consolidated_station", "d27_line_extension", "d42_final_itineraries", "g07_route_vertices", "w08_imputed_clock",
)


@pytest.fixture(scope="module")
def cut(spark, sf_dir):
    tables_ = Tables(spark, sf_dir)
    tables_.layout = RunLayout(2)
    return tables_


@pytest.mark.parametrize("name", NAMES)
def test_small_buckets(spark, sf_dir, cut, name, monkeypatch):
    plain = rows(QUERIES[name](spark, sf_dir))
    assert tables(spark, sf_dir).layout.rows is None
    monkeypatch.setattr("railloom.catalog.registry.tables", lambda s, d: cut)
    assert rows(QUERIES[name](spark, sf_dir)) == plain

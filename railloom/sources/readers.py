"""Readers with declared schemas: feed files, coding sheets, keyed tables, vertex text."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_RUN = (
    "line STRING, shape_id STRING, description STRING, mode STRING, route_id STRING, route_long_name STRING,"
    " direction STRING, terminal STRING, speed DOUBLE"
)
FEED_SEGMENT = (
    "line STRING, it_order INT, itin_a INT, itin_b INT, dep_time INT, arr_time INT, ltime DOUBLE, zone_id_a STRING,"
    " zone_id_b STRING, dw_code INT, shape_id STRING, shape_dist_trav_a DOUBLE, shape_dist_trav_b DOUBLE"
)
HEADER_SHEET = (
    "tr_line STRING, description STRING, mode STRING, veh_type STRING, headway STRING, speed DOUBLE, tod STRING,"
    " scenario STRING, action INT, tip_id INT, rsp_id STRING, completion_year INT, notes STRING"
)
ITINERARY_SHEET = (
    "tr_line STRING, ord DOUBLE, itin_a INT, itin_b INT, layover INT, dw_code STRING, trv_time DOUBLE, zn_fare DOUBLE"
)
LINK_VERTEX = "a INT, b INT, directions INT, miles DOUBLE, modes1 STRING, modes2 STRING, id INT, x DOUBLE, y DOUBLE"
VERTEX_LINE = "rte INT, x DOUBLE, y DOUBLE, m DOUBLE"
ROUTE_VERTEX = "rte INT, tr_line STRING, x DOUBLE, y DOUBLE, m DOUBLE"
ACTION_VERTEX = "link INT, tr_line STRING, action INT, x DOUBLE, y DOUBLE"


REFUSED = "_refused"


@dataclass(frozen=True)
class Layout:
    """Columns of a text file, whether its files begin with a header, and what stands between fields."""

    schema: str
    header: bool = True
    sep: str = ","


FEED_RUNS, FEED_SEGMENTS = Layout(FEED_RUN), Layout(FEED_SEGMENT)
HEADERS, ITINERARIES = Layout(HEADER_SHEET), Layout(ITINERARY_SHEET)
LINK_VERTICES, ROUTE_VERTICES, ACTION_VERTICES = (Layout(schema, False, ";") for schema in (LINK_VERTEX, ROUTE_VERTEX, ACTION_VERTEX))


def records(spark: SparkSession, path: str, layout: Layout, named: bool = False) -> DataFrame:
    """All records, in `_refused` the text of those with a field that is no value of its column, or with too few or too many fields.

    Columns are taken by place. With `named` the files' headers must name them in this order, or the job ends where it reads the
    file; without, headers are passed over. Empty fields are null, blank lines nothing.
    """
    reader = spark.read.schema(f"{layout.schema}, {REFUSED} STRING").option("header", layout.header).option("sep", layout.sep)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REFUSED)
    rows = reader.option("enforceSchema", not named).csv(path)
    # Only columns that a query needs are parsed. This condition, always true, needs all, so that every query refuses the same records.
    return rows.withColumn(REFUSED, F.when(F.xxhash64(*rows.columns[:-1]) >= -(1 << 63), F.col(REFUSED)))


def refused(spark: SparkSession, path: str, layout: Layout, named: bool = False) -> DataFrame:
    """Refused records as violations: the file is the key, the record's text the detail."""
    rows = records(spark, path, layout, named).filter(F.col(REFUSED).isNotNull())
    return rows.select(F.lit("refused_record").alias("check"), F.col("_metadata.file_name").alias("key"), F.col(REFUSED).alias("detail"))


def _accepted(spark: SparkSession, path: str, layout: Layout, named: bool = False) -> DataFrame:
    rows = records(spark, path, layout, named)
    return rows.filter(F.col(REFUSED).isNull()).drop(REFUSED)


def read_feed_runs(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """Run headers; names are cut to 20 characters and the shape number is dropped."""
    return cut_line(_accepted(spark, path, FEED_RUNS, named).drop("shape_id"))


def read_feed_segments(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """Run segments; rows without a line are dropped."""
    rows = cut_line(_accepted(spark, path, FEED_SEGMENTS, named).drop("shape_id", "shape_dist_trav_a", "shape_dist_trav_b"))
    return drop_blank_lines(rows)


def cut_line(df: DataFrame) -> DataFrame:
    return df.withColumn("line", F.substring("line", 1, 20))


def drop_blank_lines(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.trim("line"), F.lit("")) != "")


def read_coding_sheets(spark: SparkSession, header_path: str, itinerary_path: str, named: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two sheets of a coding workbook, saved as CSV."""
    return _accepted(spark, header_path, HEADERS, named), _accepted(spark, itinerary_path, ITINERARIES, named)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columnar table with only the declared columns."""
    return spark.read.schema(schema).parquet(path)


def read_link_vertices(spark: SparkSession, path: str) -> DataFrame:
    """`a;b;dir;miles;mode1;mode2;id;x;y`, one vertex per row.

    The row order of the text is the drawing order. It is kept as `seq`, which grows along each file.
    """
    return in_file_order(_accepted(spark, path, LINK_VERTICES))


def read_route_vertices(spark: SparkSession, path: str) -> DataFrame:
    return in_file_order(_accepted(spark, path, ROUTE_VERTICES))


def read_action_vertices(spark: SparkSession, path: str) -> DataFrame:
    return in_file_order(_accepted(spark, path, ACTION_VERTICES))


def in_file_order(df: DataFrame) -> DataFrame:
    """Position by file block and row: splits of one file are read in block order."""
    meta = F.col("_metadata")
    return df.withColumns({"_f": meta["file_path"], "_b": meta["file_block_start"], "_i": F.monotonically_increasing_id()}).withColumn(
        "seq", F.struct("_f", "_b", "_i")
    ).drop("_f", "_b", "_i")


def as_polylines(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Vertex rows to one array per link; a link has as many vertices as its drawing."""
    rows = vertices.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("_v"))
    return rows.select(*keys, F.transform("_v", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("vertices"))


def read_systems(spark: SparkSession, paths: dict[str, str], schema: str) -> DataFrame:
    """Several route systems as one table with a `system` column, so that one job serves all."""
    parts = [read_table(spark, p, schema).withColumn("system", F.lit(n)) for n, p in sorted(paths.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Full copy of a table as it is now; later edits do not reach it."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Dates of records are read once, and rows of one source need not meet in one task."""

from pyspark.sql import functions as F

from assetloom.functions import scalars
from assetloom.operators import ingest
from assetloom.schema import NODE

LINK = "value_1 string, value_2 string, type_1 string, type_2 string, source_uuid string, detection_date string, update_date string"
PROPERTY = "value string, type string, source_uuid string, payload string, version string, detection_date string, pos bigint"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_outputs_of_a_batch_read_no_dates_again(spark):
    links = spark.createDataFrame([("a.com", "1.1.1.1", "fqdn", "ip", "u", "2020-01-02 00:00:00", "soon")], LINK)
    props = spark.createDataFrame([("a.com", "fqdn", "u", "p", "100000", "", 1)], PROPERTY)
    rows, prop, _, rejects = ingest.upsert_batch(links, props, spark.createDataFrame([("u", 1)], "uuid string, id_source int"), spark.createDataFrame([], NODE), 5)
    for df in (rows, prop, rejects):
        assert "unix_timestamp" not in plan(df).lower() and "rlike" not in plan(df).lower()
    assert {(r.detection_date, r.version) for r in rows.collect()} == {(1577923200, 5)} and rows.count() == 2
    assert [(r.detection_date, r.version) for r in prop.collect()] == [(100000, 100000)]
    assert [tuple(r) for r in rejects.collect()] == [("link", "unread_date", 1)]


def test_links_are_joined_once_for_both_ways(spark):
    df = spark.createDataFrame([("fqdn", 1, "ip", 2, 7)], "type_1 string, id_1 bigint, type_2 string, id_2 bigint, id_source int")
    both = ingest.both_ways(df.join(spark.range(3).select(F.col("id").alias("id_1")), "id_1").select(df.columns))
    assert plan(both).count("Join") == 1 and "Union" not in plan(both)
    assert sorted(map(tuple, both.collect())) == [("fqdn", 1, "ip", 2, 7), ("ip", 2, "fqdn", 1, 7)]
    assert both.columns == df.columns


def test_sources_are_joined_without_a_shuffle(spark):
    rows = spark.range(10_000).select(F.lit(" U ").alias("source_uuid"), "id").repartition(4)
    out = ingest.sources(rows, spark.createDataFrame([("u", 3), ("U", 2)], "uuid string, id_source int"))
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.select("id_source").distinct().collect() == [(2,)]


def test_plain_dates_are_read_as_before(spark):
    texts = ["2020-01-01 00:00:00", "2020-01-01T00:00:01", " 2020-01-01 00:00:02 ", "2020-13-01 00:00:00", "2020-01-01 25:00:00", "1969-12-31 23:59:59", "1970-01-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(scalars.seconds(F.col("t")).alias("s"))
    assert [r.s for r in df.collect()] == [1577836800, 1577836801, 1577836802, None, None, None, None, None]

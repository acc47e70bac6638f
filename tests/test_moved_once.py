"""Rows that were shuffled more often than the result needs."""

from assetloom.operators import ingest
from assetloom.plans import derived
from assetloom.schema import LINK
from assetloom.sources import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_of_order_lines_are_moved_once_after_their_join(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(derived, "ROWS_OF_A_TASK", 10_000)
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lined = derived.derived(spark, sf_dir).one_way[0]
        text = plan(lined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert text.count("Exchange rangepartitioning(") == 1 and text.count("Exchange hashpartitioning(") == 2  # the join's two sides
    assert lined.rdd.getNumPartitions() == 6  # 60,000 lines


def test_ranged_rows_are_stored_as_they_lie(spark, tmp_path):
    rows = spark.range(100).selectExpr("'fqdn' type_1", "id % 10 id_1", "'ip' type_2", "id id_2", "0 id_source", "0 detection_date", "0L version", "0L ingest_seq")
    path = str(tmp_path / "link")
    sinks.append(rows.repartitionByRange(3, "id_1"), path, "link", ranged=True)
    stored = spark.read.schema(LINK).parquet(path).select(rows.columns)
    assert len(stored.inputFiles()) == 3 and stored.exceptAll(rows).count() == 0 and stored.count() == 100


def test_stored_links_are_those_of_both_ways(spark, sf_dir):
    stored, own = derived.graph(spark, sf_dir).link, derived.derived(spark, sf_dir).link
    assert stored.columns == own.columns and stored.count() == own.count()
    assert stored.exceptAll(own).count() == 0
    assert ingest.reverse(ingest.reverse(stored)).exceptAll(stored).count() == 0

"""Candidates that were found anew for each use of them."""

from pyspark.sql import functions as F

from assetloom.operators import classify, domains
from assetloom.plans import derived, queries


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_are_found_once_for_all_verdicts(spark, sf_dir):
    for report in queries._verdicts(spark, sf_dir):
        assert "sort_array" not in logical(report)  # of a host's scores


def test_candidates_are_found_once_for_a_holdout(spark, sf_dir):
    g = derived.graph(spark, sf_dir)
    out = classify.evaluate(g.node, g.link, domains.suffix_rules(spark), 10)
    assert "sort_array" not in logical(out)
    assert out.where(F.col("signal") == "total").count() == 1

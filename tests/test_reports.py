"""Records and runs of the printed reports: how the work is spread and what the planner may broadcast."""

import pandas as pd
from pyspark.sql import functions as F

from docspark.operators import fields as FI
from docspark.operators import models as M
from docspark.plans import quality, reports
from docspark.sources.reports import customers, gold_records, report_blocks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_citations_are_never_broadcast(spark):
    cited = spark.createDataFrame(
        [(1, "f", "1-0"), (1, "g", "1-9"), (1, "h", None), (1, "i", ""), (2, "f", "1-0"), (2, "g", "2-1"), (2, "h", "2-1x")],
        "doc_id bigint, field string, block_id string",
    )
    blocks = spark.createDataFrame([(1, "1-0"), (1, "1-0"), (2, "2-1"), (3, "1-9")], "doc_id bigint, block_id string")
    found = FI.fabricated_citations(cited, blocks)
    assert "Broadcast" not in plan_of(found) and "SortMergeJoin" in plan_of(found)
    assert sorted(tuple(r) for r in found.select("doc_id", "field", "block_id").collect()) == [(1, "g", "1-9"), (2, "f", "1-0"), (2, "h", "2-1x")]


def test_customers_are_spread_before_they_become_reports(spark, small):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert customers(spark, small).rdd.getNumPartitions() == least
    rows = customers(spark, small).count()
    assert customers(spark, small, per_task=5).rdd.getNumPartitions() == max(least, -(-rows // 5))
    for made in (report_blocks(spark, small), gold_records(spark, small)):
        used = made.select(F.spark_partition_id().alias("p"), "doc_id").distinct().groupBy("doc_id").count()
        assert made.rdd.getNumPartitions() == least and used.filter("count > 1").isEmpty()


def test_records_are_folded_where_their_customer_lies(spark, small):
    """The only shuffle is that of the customers, not of the blocks."""
    for name, of in (("record_fields", reports), ("provenance", reports), ("validate_records", quality), ("scorecards", quality)):
        assert plan_of(of.QUERIES[name](spark, small)).count("Exchange hashpartitioning") == 1, name


def test_report_runs_need_no_join(spark, small):
    plan = plan_of(reports.QUERIES["report_runs"](spark, small))
    assert "Join" not in plan and plan.count("FileScan") == 1 and "customer.parquet" in plan


def test_small_results_are_handed_back_together():
    frames = [pd.DataFrame({"a": [i] * n}) for i, n in enumerate([1, 0, 3, 2, 9, 1])]
    out = list(M.gathered(iter(frames), rows=4))
    assert [len(f) for f in out] == [4, 11, 1]
    assert pd.concat(out)["a"].tolist() == pd.concat(frames)["a"].tolist()
    assert list(M.gathered(iter([]))) == [] and list(M.gathered(iter([pd.DataFrame({"a": []})]))) == []

"""Properties of physical plans that must hold at any size."""

import re

import pytest
from tidemark.registry.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
LAZY = ["stg2_stg_orders", "gld1_order_facts", "gld2_daily_metrics", "gld3_customer_360", "jn3_anti_join", "jn4_row_counts_side_by_side",
        "ag15_category_counts", "wn1_latest_version", "wn9_history_at_order_time", "dq13_cardinality_equality", "dq14_equality",
        "src5_pull_in_chunks", "br2_segment_at_order", "br5_derive_shipments"]


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


@pytest.mark.parametrize("name", ["wn1_latest_version", "stg2_stg_orders", "wn2_best_payment"])
def test_rank_filter_runs_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "row_number(), 1, Partial" in text and text.index("1, Partial") > text.index("Exchange hashpartitioning")


def test_facts_share_one_partitioning_by_order(spark):
    text = plan(spark, "gld1_order_facts")
    # two by record key, three by order; the joins add none
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5


def test_columns_are_pruned_at_the_scan(spark):
    text = plan(spark, "wn9_history_at_order_time")
    scanned = re.findall(r"ReadSchema: struct<([^>]*)", QUERIES["ag2_count_distinct"](spark, FOLDER)._jdf.queryExecution().toString())
    assert scanned and all("l_comment" not in s and "l_extendedprice" not in s for s in scanned)
    assert "o_shippriority" not in text


def test_filters_reach_the_scan(spark):
    text = QUERIES["dq7_accepted_range"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in text


def test_windows_are_partitioned(spark):
    for name in ("gld3_customer_360", "wn9_history_at_order_time", "ag8_mode_latest_tie"):
        assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*SinglePartition", plan(spark, name))


def test_refresh_reads_only_new_landing_folders(spark, scratch):
    from tidemark.operators.filters import newer_than
    from pyspark.sql import functions as F
    rows = spark.range(10).select("id", F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2024-01-01 06:00:00").cast("timestamp")).alias("_ingestion_ts"))
    rows.withColumn("ingestion_date", F.to_date("_ingestion_ts")).write.partitionBy("ingestion_date").parquet(scratch)
    landed = spark.read.parquet(scratch)
    found = newer_than(landed, landed.where("id < 7"), folder="ingestion_date")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "ingestion_date#" in text.split("PartitionFilters: ")[1].split("]")[0] and "2024-01-07" in text
    assert sorted(r.id for r in found.collect()) == [7, 8, 9]


@pytest.mark.parametrize("name", ["gld1_order_facts", "jn3_anti_join", "wn1_latest_version", "stg5_stg_shipments"])
def test_plan_does_not_depend_on_size(spark, name):
    """The same exchanges over a hundred times the rows."""
    def exchanges(folder):
        text = QUERIES[name](spark, folder)._jdf.queryExecution().sparkPlan().toString()
        full = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        return len(re.findall(r"Exchange (?:hash|range|single|RoundRobin)", full)) + full.count("BroadcastExchange"), text.count("Join")
    assert exchanges(FOLDER) == exchanges("/root/testdata/sf0.1")


def test_suite_groups_each_table_once(spark):
    from tidemark.operators import checks
    text = plan(spark, "dq21_declared_suite")
    tables = len(checks.KEYS)
    relations = sum(c.failing is not None for c in checks.declared_suite())
    # per table a grouping and the count over it, each in two halves; a relation groups its child and its parent and counts
    assert text.count("HashAggregate") + text.count("SortAggregate") <= 4 * tables + 8 * relations
    assert text.count("Scan parquet") <= tables + 2 * relations


def test_suite_writes_what_is_read_of_a_model(spark, monkeypatch):
    from tidemark.registry import quality
    written, stage = {}, quality.stage

    def seen(df, label):
        written[label] = df.columns
        return stage(df, label)
    monkeypatch.setattr(quality, "stage", seen)
    assert QUERIES["dq21_declared_suite"](spark, FOLDER).count() == 33
    assert written["stg_payments"] == ["payment_id", "order_id", "payment_status", "payment_date", "amount"]
    assert not {"_record_hash", "created_at", "is_paid"} & {*written["stg_orders"], *written["order_facts"]}


@pytest.mark.parametrize("name", ["stg3_stg_payments", "stg5_stg_shipments"])
def test_texts_of_timestamps_are_not_shuffled(spark, name):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    above = text[:text.index("Window ")]
    assert "rlike" not in above.lower() and "gettimestamp" not in above.lower()


def test_colocated_tables_meet_without_a_shuffle(spark):
    from tidemark.registry.layers import colocated_facts
    from tidemark.sinks import colocated
    from tidemark.sources.bronze import Lake
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = colocated_facts(Lake(spark, FOLDER))
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert df.count() == QUERIES["gld1_order_facts"](spark, FOLDER).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert colocated.buckets_for(1) == 1 and colocated.buckets_for(3 * 128 << 20) == 4 and colocated.buckets_for(4 * 128 << 20) == 4


@pytest.mark.parametrize("name", ["gld4_rfm_scores", "gld2_daily_distinct_orders", "gld2_monthly_distinct_orders"])
def test_what_is_read_several_times_is_built_once(spark, name):
    from tidemark.registry.catalog import QUERIES
    assert not [f for f in QUERIES[name](spark, FOLDER).inputFiles() if f.startswith(f"file://{FOLDER}")]


def test_scans_are_cut_small_unless_the_session_says_how(spark):
    from tidemark import session
    before = {n: spark.conf.get(n) for n in (session.SCAN, session.CLEANUP)}
    try:
        spark.conf.unset(session.SCAN)
        session.spare_disk(spark)
        assert spark.conf.get(session.SCAN) == session.SCAN_BYTES and spark.conf.get(session.CLEANUP) == "true"
        spark.conf.set(session.SCAN, "64m")
        session.spare_disk(spark)
        assert spark.conf.get(session.SCAN) == "64m"
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def test_files_are_dense_unless_the_session_says_how(spark):
    from tidemark import session
    before = spark.conf.get(session.CODEC)
    try:
        spark.conf.unset(session.CODEC)
        session.spare_disk(spark)
        assert spark.conf.get(session.CODEC) == "zstd"
        spark.conf.set(session.CODEC, "gzip")
        session.spare_disk(spark)
        assert spark.conf.get(session.CODEC) == "gzip"
    finally:
        spark.conf.set(session.CODEC, before)


def test_timestamps_are_written_as_numbers_unless_the_session_says_how(spark, scratch):
    import pyarrow.parquet
    from tidemark import session
    before = spark.conf.get(session.STAMPS)
    try:
        spark.conf.unset(session.STAMPS)
        session.spare_disk(spark)
        spark.sql("select timestamp '0001-01-01 00:00:00.000001' as at union all select timestamp '9999-12-31 23:59:59.999999' union all select null").write.parquet(scratch)
        at = sorted(spark.read.parquet(scratch).selectExpr("cast(at as string) as at").where("at is not null").collect())
        assert [r["at"] for r in at] == ["0001-01-01 00:00:00.000001", "9999-12-31 23:59:59.999999"]
        files = [f.removeprefix("file://") for f in spark.read.parquet(scratch).inputFiles()]
        assert {pyarrow.parquet.ParquetFile(f).schema.column(0).physical_type for f in files} == {"INT64"}
        spark.conf.set(session.STAMPS, "TIMESTAMP_MILLIS")
        session.spare_disk(spark)
        assert spark.conf.get(session.STAMPS) == "TIMESTAMP_MILLIS"
    finally:
        spark.conf.set(session.STAMPS, before)


def test_buckets_follow_the_rows(spark, monkeypatch):
    from tidemark.registry import layers
    from tidemark.sinks import colocated
    from tidemark.sources.bronze import Lake
    dealt = []
    monkeypatch.setattr(colocated, "write_colocated", lambda df, name, key, buckets, path: dealt.append(buckets) or df)
    layers.colocated_facts(Lake(spark, FOLDER))
    monkeypatch.setattr(colocated, "buckets_for", lambda n, own=colocated.buckets_for: own(n, 1 << 16))
    layers.colocated_facts(Lake(spark, FOLDER))
    assert dealt[:3] == [8] * 3 and dealt[3] > 8 and len(set(dealt[3:])) == 1

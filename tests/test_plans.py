"""What Spark makes of the operators: shuffles, pruning, skew."""

import re

import pytest
from pyspark.sql import functions as F

import placemill as pm
from placemill import schema as S
from placemill.plans.fixtures import page_log, places_dup, places_raw

from .conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


def plan(df, run=False):
    """The physical plan; after ``run`` the final one."""
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.split(r"(?m)^\+- == Initial Plan ==", text)[0] if run else text


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "table")
    places_dup(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_silver_takes_one_shuffle_and_no_python(bronze):
    text = plan(pm.build_silver(bronze))
    assert len(re.findall(r"Exchange ", text)) == 1
    assert "Python" not in text
    assert text.count("WindowGroupLimit") == 2  # on both sides of the shuffle


def test_gold_reads_only_its_columns(bronze):
    text = plan(pm.build_gold(pm.build_silver(bronze)))
    assert re.search(r"ReadSchema: struct<id:string,brewery_type:string,state:string,load_seq:bigint>", text)


def test_gold_counts_before_the_shuffle(spark, bronze):
    text = plan(pm.count_by(bronze, "state", "brewery_type"))
    assert text.count("HashAggregate") == 2
    assert len(re.findall(r"Exchange ", text)) == 1


def test_dense_count_scans_once(bronze):
    text = plan(pm.count_by_dense(bronze, "state", "brewery_type"), run=True)
    assert text.count("FileScan") == 1
    assert text.count("ReusedExchange") == 2
    assert "Cartesian" not in text
    assert "NestedLoop" not in text


def test_dedup_sends_one_row_per_key_and_task(spark):
    # A key with a third of the rows shrinks to one row for each map task before the shuffle.
    df = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("seq")
    )
    text = plan(pm.dedup_first(df, "key", "seq"))
    partial = text.index("WindowGroupLimit [key", text.index("Exchange"))
    assert "row_number(), 1, Partial" in text[partial:]
    assert pm.dedup_first(df, "key", "seq").filter("key = -1").first().seq == 0
    assert pm.dedup_first(df, "key", "seq").count() == 200_001


def test_ingest_decodes_nothing_below_the_stop_filter(spark, tmp_path):
    page_log(spark, SF_DIR).write.parquet(str(tmp_path / "log"))
    pages = spark.read.parquet(str(tmp_path / "log"))
    for df in (pm.ingest_pages(pages), pm.ingest_pages(pages, stop=4)):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        below = text[text.index("Generate") :].split("\n", 1)[1]
        assert "from_json" not in below
        assert "NestedLoop" not in plan(df)
    assert "EqualTo(status,200), LessThan(pa" in plan(pm.ingest_pages(pages, stop=4))


def test_stop_reads_three_columns_and_shuffles_page_numbers(spark, tmp_path):
    page_log(spark, SF_DIR).withColumn("headers", F.lit("x")).write.parquet(str(tmp_path / "log"))
    text = plan(pm.first_bad_page(spark.read.parquet(str(tmp_path / "log"))))
    assert "ReadSchema: struct<page:int,status:int,body:string>" in text
    assert "partial_max(good" in text
    assert "Window" not in text


def test_impute_max_moves_only_rows_with_gaps(bronze):
    df = pm.rename_columns(bronze)
    text = plan(pm.impute_site_max(df))
    assert "PushedFilters: [IsNull(website_url)]" in text
    assert "PushedFilters: [IsNotNull(website_url)]" in text
    assert "Window" not in text
    assert text.count("FileScan") == 3
    assert text.count("partial_max(") == 1


def test_impute_fill_never_sorts_a_whole_group(bronze):
    df = pm.rename_columns(bronze)
    text = plan(pm.impute_site_fill(df, S.LOAD_SEQ), run=True)
    assert re.search(r"Exchange hashpartitioning\(nome#\d+, __chunk#\d+L", text)
    # The chunk table is worked out once: its second reader takes the same shuffle.
    assert text.count("FileScan") == 3 and "ReusedExchange" in text
    # Windows over a group as such run on one row for each block of chunks, those over chunks on one block.
    windows = re.findall(r"Window \[.*?\], \[(\w+)#\d+(?:, (\w+)#\d+L)?\], \[", text)
    assert set(windows) == {("__fill_group", ""), ("__fill_group", "__fill_block"), ("nome", "__chunk")}
    by_group = next(line for line in text.split("\n") if re.search(r"Window .*\], \[__fill_group#\d+\], \[", line))
    assert "__block_first" in by_group and "__chunk_first" not in by_group


def test_positions_read_the_input_once(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS k", "'x' AS wide").write.parquet(str(tmp_path / "in"))
    before = spark.read.parquet(str(tmp_path / "in"))
    for unique, order in ((False, ["k"]), (True, ["id"])):
        text = plan(pm.page_plan(before, *order, unique=unique))
        # Of what was pinned, rows with all columns are read once; the rest are partition numbers. No join but with the
        # partitions' sizes, which are broadcast.
        assert "SortMergeJoin" not in text and "__tie" not in text
        scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
        assert sum("wide" in columns for columns in scans) == 1
        assert all(columns.startswith("__number#") for columns in scans if "," not in columns)
        assert len(scans) <= 4


def test_url_functions_stay_in_codegen(spark):
    df = spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet").select("page_id", *pm.url_flags("url"))
    codegen = df._jdf.queryExecution().executedPlan().toString()
    assert codegen.startswith("*(1) Project")
    assert "ReadSchema: struct<page_id:bigint,url:string>" in codegen


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    pm.write_dataset(places_raw(spark, SF_DIR), str(tmp_path / "x"), partition_by=["country"])
    layer = pm.read_layer(spark, str(tmp_path / "x"))
    text = plan(layer.filter(F.col("country") == " Country ASIA").select("id"))
    assert "PartitionFilters: [isnotnull(country" in text
    assert "ReadSchema: struct<id:string>" in text


def test_dedup_any_sorts_by_keys_alone(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z")], "id string, x int, `t.u` string")
    found = pm.dedup_any(df, "id")
    assert found.columns == df.columns and found.count() == 2
    sorts = [line for line in plan(found).split("\n") if re.search(r"\bSort \[", line)]
    assert sorts and all(re.search(r"Sort \[id#\d+ ASC NULLS FIRST\]", line) for line in sorts)

"""Table operators: literal cases, agreement with plain Python on random rows, and properties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import placemill as pm
from placemill import schema as S
from placemill.operators import impute
from placemill.operators.impute import chunk_span

from .conftest import TESTDATA


def brute_fill(rows):
    """(group, order, value) rows: next value of the group, else the previous one; none without a group."""
    out = []
    for group, order, value in rows:
        mates = sorted((o, v) for g, o, v in rows if g == group and v is not None)
        if group is None:
            value = None
        elif value is None and mates:
            value = next((v for o, v in mates if o > order), mates[-1][1])
        out.append((group, order, value))
    return out


def brute_max(rows):
    out = []
    for group, order, value in rows:
        mates = [v for g, _, v in rows if g == group and v is not None]
        out.append((group, order, value if value is not None or not mates else max(mates)))
    return out


def random_rows(seed, n=300, hot=0.4):
    """Many small groups, a hot one, a null one, one without values; order values with holes, some negative."""
    rng = random.Random(seed)
    orders = rng.sample(range(-500, 5000), n)
    rows = []
    for order in orders:
        group = "hot" if rng.random() < hot else rng.choice([None, "empty", *"abcdefghij"])
        value = None if group == "empty" or rng.random() < 0.7 else f"v{rng.randrange(50)}"
        rows.append((group, order, value))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "nome string, k bigint, site string")


SORT = {"key": lambda r: r[1]}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("span", [1, 7, 300, 1_000_000])
def test_impute_fill_equals_python(spark, seed, span):
    rows = random_rows(seed)
    got = pm.impute_site_fill(frame(spark, rows), "k", span=span).collect()
    assert sorted(map(tuple, got), **SORT) == sorted(brute_fill(rows), **SORT)


@pytest.mark.parametrize("bits", [0, 1, 3])
@pytest.mark.parametrize("hot", [0.05, 0.9])
def test_impute_fill_carries_across_blocks(spark, monkeypatch, bits, hot):
    """Blocks of one, two and eight chunks of five order values: most gaps are filled from another block."""
    monkeypatch.setattr(impute, "BLOCK_BITS", bits)
    rows = [(group, order, value if order % 40 < 8 else None) for group, order, value in random_rows(21, hot=hot)]
    got = pm.impute_site_fill(frame(spark, rows), "k", span=5).collect()
    assert sorted(map(tuple, got), **SORT) == sorted(brute_fill(rows), **SORT)


def test_impute_fill_at_the_ends_of_a_long(spark):
    ends = [-(2**63) + 2**40, -1, 0, 1, 2**63 - 2]
    rows = [("g", ends[0], None), ("g", ends[1], "a"), ("g", ends[2], None), ("g", ends[3], None), ("g", ends[4], None)]
    got = pm.impute_site_fill(frame(spark, rows), "k", span=2**33).collect()
    assert sorted(map(tuple, got), **SORT) == sorted(brute_fill(rows), **SORT)


def test_chunks_of_a_hot_group_spread_over_tasks(spark, shuffled_joins):
    """The window over chunks gets a hot group's thousands of chunks in blocks, that over blocks one row for each."""
    lines = spark.read.parquet(f"{TESTDATA}/sf0.01/lineitem.parquet")
    lines = lines.groupBy("l_orderkey", "l_linenumber").agg(
        *(F.max(name).alias(name) for name in ("l_partkey", "l_suppkey", "l_shipdate"))
    )
    df = lines.select(
        F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("l_partkey").cast("string")).alias("nome"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
        F.when(F.col("l_suppkey") % 5 == 0, F.col("l_shipdate").cast("string")).alias("site"),
    )
    hot = df.filter("nome = 'hot'").select(F.expr("k div 8").alias("chunk"), F.expr("k div 8192").alias("block")).distinct()
    blocks = hot.groupBy("block").count().agg(F.sum("count"), F.count("*"), F.max("count")).first()
    assert blocks[0] > 2000 and blocks[1] > 10 and blocks[2] <= 1024
    got = pm.impute_site_fill(df, "k", span=8).toPandas().sort_values("k")
    wanted = df.toPandas().sort_values("k")
    wanted["site"] = wanted.groupby("nome")["site"].transform(lambda part: part.bfill().ffill())
    assert list(got["k"]) == list(wanted["k"]) and list(got["site"].fillna("")) == list(wanted["site"].fillna(""))


@pytest.mark.parametrize("seed", range(4))
def test_impute_max_equals_python(spark, seed):
    rows = random_rows(seed)
    got = pm.impute_site_max(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), **SORT) == sorted(brute_max(rows), **SORT)


@pytest.fixture
def shuffled_joins(spark):
    """Joins as on data too large to broadcast; explicit broadcasts stay."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(names[0])
    for name in names:
        spark.conf.set(name, "-1")
    yield
    spark.conf.set(names[0], before)
    spark.conf.unset(names[1])


def test_imputation_by_shuffled_joins(spark, shuffled_joins):
    rows = random_rows(11)
    got = pm.impute_site_max(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), **SORT) == sorted(brute_max(rows), **SORT)
    got = pm.impute_site_fill(frame(spark, rows), "k", span=100).collect()
    assert sorted(map(tuple, got), **SORT) == sorted(brute_fill(rows), **SORT)


def test_default_chunks_follow_the_order_column(spark):
    """Few chunks of at most the stated size, for a dense number and for the landing order."""
    assert chunk_span("k") == 1_000_000
    assert chunk_span(S.LOAD_SEQ, per_page=50) == 20_000 * pm.RECORD_SEQ_STRIDE
    pages = [(p, 200, "[" + ",".join('{"id": "%d-%d", "name": "n"}' % (p, k) for k in range(50)) + "]") for p in range(1, 401)]
    records = pm.ingest_pages(spark.createDataFrame(pages, "page int, status int, body string"))
    span = chunk_span(S.LOAD_SEQ)
    assert records.select(F.floor(F.col(S.LOAD_SEQ) / span)).distinct().count() == 1
    filled = pm.impute_site_fill(records, S.LOAD_SEQ, "name", "website_url")
    assert filled.count() == 20_000 and filled.filter("website_url IS NOT NULL").isEmpty()


def test_imputation_of_a_group_with_a_third_of_all_rows(spark, rows):
    gap = (F.col("k") % 4 != 0).alias("gap")
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 9000)).alias("nome"),
        F.col("id").alias("k"),
    )
    df = df.select("nome", "k", F.when(~gap, F.format_string("v%06d", "k")).alias("site"))
    hot = F.col("nome") == "hot"
    by_max = pm.impute_site_max(df)
    assert by_max.count() == 90_000
    assert rows(by_max.filter(hot & gap).select("site").distinct()) == [("v089988",)]
    by_fill = pm.impute_site_fill(df, "k", span=1000)
    assert by_fill.count() == 90_000
    following = F.ceil(F.col("k") / 12) * 12
    wanted = F.format_string("v%06d", F.least(following, F.lit(89_988)))
    assert by_fill.filter(hot & (F.col("site") != wanted)).count() == 0
    assert by_fill.filter(hot & F.col("site").isNull()).count() == 0


def test_impute_max_equals_ordered_window(spark):
    df = frame(spark, random_rows(9))
    window = Window.partitionBy("nome").orderBy(F.col("site").desc())
    first = F.first("site", ignorenulls=True).over(window)
    wanted = df.withColumn("site", F.when(F.col("site").isNull(), first).otherwise(F.col("site")))
    assert sorted(map(tuple, pm.impute_site_max(df).collect()), **SORT) == sorted(map(tuple, wanted.collect()), **SORT)


def test_impute_literal_cases(spark):
    rows = [("a", 1, None), ("a", 2, "u1"), ("a", 3, "u2"), (None, 4, "zz"), (None, 5, None), ("b", 6, None)]
    by_max = {r.k: r.site for r in pm.impute_site_max(frame(spark, rows)).collect()}
    assert by_max == {1: "u2", 2: "u1", 3: "u2", 4: "zz", 5: "zz", 6: None}
    by_fill = {r.k: r.site for r in pm.impute_site_fill(frame(spark, rows), "k").collect()}
    assert by_fill == {1: "u1", 2: "u1", 3: "u2", 4: None, 5: None, 6: None}


def test_impute_keeps_columns_and_nothing_to_do(spark):
    df = spark.createDataFrame([("x", "a", 1, "u")], "id string, nome string, k bigint, site string")
    for got in (pm.impute_site_max(df), pm.impute_site_fill(df, "k")):
        assert got.columns == df.columns
        assert [tuple(r) for r in got.collect()] == [("x", "a", 1, "u")]
    assert pm.impute_site_max(df.limit(0)).count() == 0


def test_columns_named_like_common_helpers_survive(spark):
    names = ["rank", "rows", "block", "start", "number", "heavy", "chunk", "gaps", "fill_value", "threshold", "tie"]
    df = spark.range(30).withColumns({n: F.concat(F.lit(n), F.col("id")) for n in names})
    df = df.withColumns({"nome": F.lit("g"), "site": F.when(F.col("id") % 2 == 0, F.lit("s"))})
    for got in (
        pm.impute_site_max(df),
        pm.impute_site_fill(df, "id"),
        pm.global_position(df, "rank").drop("position"),
        pm.page_plan(df, "tie", unique=True).drop("page", "total_pages"),
        pm.dedup_first(df, "id", "rank"),
    ):
        assert got.columns == df.columns
        assert got.drop("site").exceptAll(df.drop("site")).isEmpty()
        assert got.count() == 30


def test_impute_fill_wants_whole_number_order(spark):
    with pytest.raises(TypeError, match="site"):
        pm.impute_site_fill(frame(spark, []), "site")


def test_dedup_first(spark, rows):
    df = spark.createDataFrame(
        [("a", 3, "late"), ("a", 1, "first"), (None, 5, "n2"), (None, 2, "n1"), ("b", 9, "only")],
        "id string, seq bigint, what string",
    )
    once = pm.dedup_first(df, "id", "seq")
    assert rows(once) == [(None, 2, "n1"), ("a", 1, "first"), ("b", 9, "only")]
    assert rows(pm.dedup_first(once, "id", "seq")) == rows(once)


def test_dedup_first_with_repeated_or_null_order(spark, rows):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("b", None, "z"), ("b", 2, "w")], "id string, k int, v string")
    assert rows(pm.dedup_first(df, "id", "k")) == [("a", 1, "x"), ("b", None, "z")]
    with pytest.raises(Exception, match="k is null"):
        pm.dedup_first(df.filter("id = 'b'"), "id", "k", unique=True).collect()
    with pytest.raises(Exception, match="k repeats"):
        pm.dedup_first(df.filter("id = 'a'"), "id", "k", unique=True).collect()
    single = df.filter("v IN ('x', 'w')")
    assert rows(pm.dedup_first(single, "id", "k", unique=True)) == rows(single)


def test_dedup_first_by_page_and_position(spark, rows):
    df = spark.createDataFrame([("a", 2, 0), ("a", 1, 7), ("a", 1, 3)], "id string, page int, pos int")
    assert rows(pm.dedup_first(df, "id", ["page", "pos"])) == [("a", 1, 3)]


def test_dedup_any(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2)], "id string, x int")
    assert rows(pm.dedup_any(df, "id")) == [(None, 2), ("a", 1)]
    assert rows(pm.dedup_any(df.select("id"), "id")) == [(None,), ("a",)]


def test_dedup_any_keeps_a_whole_row_and_always_the_same(spark, rows):
    data = [(f"k{i % 7}", i * 37 % 101, f"t{i * 37 % 101}") for i in range(100)]
    df = spark.createDataFrame(data, "id string, x int, t string")
    kept = rows(pm.dedup_any(df, "id"))
    assert len(kept) == 7
    assert set(kept) <= set(data)
    assert rows(pm.dedup_any(df.repartition(13).orderBy(F.desc("x")), ["id"])) == kept


def test_rename_ignores_absent_columns(spark):
    df = spark.createDataFrame([("1", "n", "x")], "id string, name string, other string")
    assert pm.rename_columns(df).columns == ["id", "nome", "other"]


def test_fill_constants_leaves_other_columns(spark):
    df = spark.createDataFrame([(None,) * 16], S.RECORD_SCHEMA)
    row = pm.fill_constants(pm.rename_columns(df)).first().asDict()
    assert {k for k, v in row.items() if v == "-"} == set(S.FILLED)
    assert all(row[k] is None for k in row if k not in S.FILLED)


def test_fill_comes_too_late_for_empty_text(spark):
    df = spark.createDataFrame([("***",)], "estado string")
    clean = df.select(pm.normalise_text("estado", strip_chars=True).alias("estado"))
    assert pm.fill_constants(clean, {"estado": "-"}).first()[0] == ""


def test_union_records(spark, rows):
    a = spark.createDataFrame([("1", "x")], "id string, name string")
    b = spark.createDataFrame([("p", "2")], "phone string, id string")
    wanted = [("1", "x", None), ("1", "x", None), ("2", None, "p")]
    assert rows(pm.union_records(a, b, a), "id", "name", "phone") == wanted


def test_counts(spark, rows):
    data = [("x", "p")] * 3 + [("x", None), ("y", "q"), ("z", None), (None, "r"), ("", "p")]
    df = spark.createDataFrame(data, "estado string, tipo_cervejaria string")
    sparse = pm.count_by(df)
    assert rows(sparse) == [
        (None, "r", 1), ("", "p", 1), ("x", None, 1), ("x", "p", 3), ("y", "q", 1), ("z", None, 1)
    ]
    dense = pm.count_by_dense(df)
    assert dense.schema["count"].dataType.simpleString() == "bigint"
    seen = {(a, b): n for a, b, n in rows(sparse)}
    assert rows(dense) == [(a, b, seen.get((a, b), 0)) for a in ("", "x", "y", "z") for b in "pqr"]
    assert [tuple(r) for r in pm.count_by_dense(df, sort=True).collect()] == rows(dense)
    assert [r[0] for r in pm.count_by(df, "estado", sort=True).collect()] == [None, "", "x", "y", "z"]


def test_dense_count_of_larger_domains(spark):
    df = spark.range(3000).select((F.col("id") % 300).alias("a"), (F.col("id") % 70).cast("string").alias("b"))
    dense = pm.count_by_dense(df, "a", "b", name="n")
    assert dense.count() == 300 * 70
    assert dense.agg(F.sum("n")).first()[0] == 3000


def test_dense_count_without_rows(spark):
    assert pm.count_by_dense(spark.createDataFrame([], "estado string, tipo_cervejaria string")).count() == 0


def test_global_position(spark):
    rng = random.Random(3)
    values = [(rng.randrange(40), i) for i in range(2000)]
    df = spark.createDataFrame(values, "v int, i int").repartition(5)
    got = pm.global_position(df, "v", "i", unique=True)
    assert got.columns == ["v", "i", "position"]
    wanted = [(*pair, p) for p, pair in enumerate(sorted(values))]
    assert [tuple(r) for r in got.orderBy("position").collect()] == wanted
    assert [tuple(r) for r in pm.global_position(df, "v", "i").orderBy("position").collect()] == wanted


def test_global_position_of_equal_rows(spark):
    # A third and more of the rows have one order value: they still spread over several blocks.
    df = spark.range(9000).select(F.when(F.col("id") < 5000, 0).otherwise(F.col("id")).alias("v"))
    got = pm.global_position(df, "v").collect()
    assert sorted(r.position for r in got) == list(range(9000))
    assert max(r.position for r in got if r.v == 0) == 4999


def test_page_plan(spark):
    df = spark.range(0, 121).withColumn("key", 500 - F.col("id"))
    by_key = {r.key: (r.page, r.total_pages) for r in pm.page_plan(df, "key", per_page=50).collect()}
    assert by_key == {500 - i: ((120 - i) // 50 + 1, 3) for i in range(121)}
    dense = pm.page_plan(df, per_page=50, position="id")
    assert {r.id: r.page for r in dense.collect()} == {i: i // 50 + 1 for i in range(121)}
    assert dense.columns == ["id", "key", "page", "total_pages"]

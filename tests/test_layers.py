"""Sinks, stored layers and whole runs."""

import json
import uuid
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F

import placemill as pm
from placemill import schema as S
from placemill import staging
from placemill.plans import layers
from placemill.plans.fixtures import page_log, places_dup, places_raw
from placemill.plans.ledger import fingerprint_of_pages
from placemill.staging import SHARED_MOUNT, pin, scratch, shared_dir

from .conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture
def schemas(spark):
    suffix = uuid.uuid4().hex
    names = tuple(f"{layer}_{suffix}" for layer in ("bronze", "silver", "gold"))
    yield names
    for name in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_landing_writes_nulls_and_reads_back(spark, tmp_path, rows):
    path = str(tmp_path / "landing")
    places = places_raw(spark, SF_DIR)
    pm.write_landing(places, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert all(set(line) == set(S.SOURCE_COLUMNS) for line in lines)
    back = pm.read_landing(spark, path)
    assert back.columns == S.LANDING_SCHEMA.names
    assert rows(back.drop(S.LOAD_SEQ)) == rows(places)
    pm.write_landing(places.limit(3), path)
    assert pm.read_landing(spark, path).count() == 3


def test_landing_malformed_line(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": "1"}\n{oops\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        pm.read_landing(spark, str(tmp_path)).collect()
    assert pm.read_landing(spark, str(tmp_path), mode="DROPMALFORMED").count() == 1


def test_partition_values_read_back(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", ""), ("2", "a/b"), ("3", "01"), ("4", "-")], "id string, estado string")
    path = str(tmp_path / "silver")
    pm.write_dataset(df, path, partition_by=["estado"])
    assert (tmp_path / "silver" / "estado=a%2Fb").is_dir()
    wanted = [("1", None), ("2", "a/b"), ("3", "01"), ("4", "-")]
    assert rows(pm.read_layer(spark, path), "id", "estado") == wanted
    assert rows(pm.read_layer(spark, path, df.schema), "id", "estado") == wanted
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    plan = pm.read_layer(spark, path).filter("estado = '01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(estado" in plan


def test_dataset_modes(spark, tmp_path):
    df = spark.createDataFrame([(str(i), "x") for i in range(5)], "id string, estado string")
    path = str(tmp_path / "set")
    for mode, count in (("overwrite", 5), ("append", 10), ("overwrite", 5)):
        pm.write_dataset(df, path, partition_by=["estado"], mode=mode)
        assert pm.read_layer(spark, path).count() == count


def test_one_file_for_a_small_partition_value(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("estado")).repartition(8)
    pm.write_dataset(df, str(tmp_path / "set"), partition_by=["estado"])
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "set").glob("estado=*"))


def test_large_partition_value_is_split(spark, tmp_path):
    """A value with most of the rows is written by several tasks once it exceeds the advisory size."""
    df = spark.range(0, 400_000, 1, 16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 < 8, "hot").otherwise((F.col("id") % 7).cast("string")).alias("estado"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        pm.write_dataset(df, str(tmp_path / "set"), partition_by=["estado"])
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "set" / "estado=hot").glob("*.parquet"))) > 4
    assert pm.read_layer(spark, str(tmp_path / "set")).count() == 400_000


def test_write_table_schema_change(spark, schemas):
    name = f"{schemas[0]}.t"
    pm.ensure_schemas(spark, schemas[0])
    pm.ensure_schemas(spark, schemas[0])
    pm.write_table(spark.range(3).withColumn("k", F.lit("a")), name, partition_by=["k"])
    pm.write_table(spark.range(2).withColumn("k", F.lit("b")), name, partition_by=["k"], replace_schema=False)
    assert pm.read_layer(spark, name).count() == 2
    with pytest.raises(ValueError, match="would change"):
        pm.write_table(spark.range(1), name, replace_schema=False)
    assert pm.read_layer(spark, name).columns == ["id", "k"]
    pm.write_table(spark.range(1), name)
    assert pm.read_layer(spark, name).columns == ["id"]


def _failing(df, column="id"):
    """Rows of which the last cannot be worked out."""
    return df.withColumn(column, F.when(F.col("id") == 999, F.raise_error(F.lit("half-way")).cast("bigint")).otherwise(F.col(column)))


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
def test_failed_overwrite_leaves_the_table(spark, schemas, rows, keys):
    name = f"{schemas[0]}.t"
    pm.ensure_schemas(spark, schemas[0])
    old = spark.range(10).selectExpr("id", "'a' k", "'b' j")
    pm.write_table(old, name, partition_by=keys)
    wanted, files = rows(old), set(pm.read_layer(spark, name).inputFiles())
    new = _failing(spark.range(0, 1000, 1, 8)).selectExpr("id", "'c' k", "'d' j", "1 added")
    for _ in range(2):
        with pytest.raises(Exception, match="half-way"):
            pm.write_table(new, name, partition_by=keys)
        assert rows(pm.read_layer(spark, name), "id", "k", "j") == wanted
    assert set(pm.read_layer(spark, name).inputFiles()) == files
    assert [row.tableName for row in spark.sql(f"SHOW TABLES IN {schemas[0]}").collect() if row.tableName != "t"] != []
    # A table may be made from itself, and readers of the version before are not disturbed.
    reader = pm.read_layer(spark, name)
    pm.write_table(reader.filter("id < 5"), name, partition_by=keys)
    assert rows(reader, "id", "k", "j") == wanted and pm.read_layer(spark, name).count() == 5
    pm.write_table(reader.limit(0), name, partition_by=keys, mode="append")
    pm.write_table(old.filter("id = 7"), name, partition_by=keys, mode="append")
    assert pm.read_layer(spark, name).count() == 6


def test_old_versions_go(spark, schemas, tmp_path):
    pm.ensure_schemas(spark, schemas[0], root=str(tmp_path))
    for size in range(1, 5):
        pm.write_table(spark.range(size), f"{schemas[0]}.t")
    assert len(list((tmp_path / schemas[0] / "t").glob("__v*"))) == 2
    assert spark.table(f"{schemas[0]}.t").count() == 4


def test_plain_table_is_taken_over(spark, schemas):
    pm.ensure_schemas(spark, schemas[0])
    spark.range(3).write.saveAsTable(f"{schemas[0]}.t")
    with pytest.raises(Exception, match="half-way"):
        pm.write_table(_failing(spark.range(1000)), f"{schemas[0]}.t")
    assert spark.table(f"{schemas[0]}.t").count() == 3
    pm.write_table(spark.range(5), f"{schemas[0]}.t")
    assert spark.table(f"{schemas[0]}.t").count() == 5


def test_split_landing(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1"}\n{oops\n\n[1]\n{"id": "2", "load_seq": 5}\n{"id": "3", "load_seq": "x"}\n')
    (tmp_path / "b.json").write_text('{"id": "4"}\n')
    landing = pm.split_landing(spark, str(tmp_path))
    assert landing.records.columns == S.LANDING_SCHEMA.names
    assert {row.id for row in landing.records.collect()} == {"1", "2", "4"}
    assert sorted(tuple(row) for row in landing.rejects.collect()) == [
        ("a.json", "[1]"), ("a.json", '{"id": "3", "load_seq": "x"}'), ("a.json", "{oops")]
    assert [tuple(row) for row in landing.reject_counts().collect()] == [("a.json", 3)]
    assert landing.rejects.count() == 3


def test_bronze_with_rejects(spark, schemas, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1"}\n{oops\n')
    pm.ensure_schemas(spark, schemas[0])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        pm.build_bronze(spark, str(tmp_path)).collect()
    assert pm.build_bronze(spark, str(tmp_path), rejects=f"{schemas[0]}.rejects").count() == 1
    assert spark.table(f"{schemas[0]}.rejects").first().line == "{oops"


@pytest.fixture
def counted(monkeypatch):
    """How often each step of a run is called."""
    calls = Counter()
    for name in ("ingest_pages", "first_bad_page", "build_bronze", "build_silver", "build_gold"):
        def call(*args, _name=name, _plain=getattr(layers, name), **options):
            calls[_name] += 1
            return _plain(*args, **options)
        monkeypatch.setattr(layers, name, call)
    return calls


def test_run_goes_on_where_it_failed(spark, schemas, tmp_path, rows, counted):
    pages = page_log(spark, SF_DIR)
    run = partial(pm.run_pipeline, spark, pages, str(tmp_path / "landing"), schemas=schemas, ledger=str(tmp_path / "ledger"))
    with pytest.raises(ValueError, match="needs an order"):
        run(order=None, fill_site_first=False, impute="fill")
    assert counted == {"first_bad_page": 1, "ingest_pages": 1, "build_bronze": 1, "build_silver": 1}
    counted.clear()
    gold = rows(run())
    assert counted == {"build_silver": 1, "build_gold": 1} and sum(row[-1] for row in gold) == 50
    counted.clear()
    assert rows(run()) == gold and not counted
    # Other options, a table that is gone or was written by another run, other pages: from there on anew.
    assert rows(run(dense=True)) != gold and counted == {"build_gold": 1}
    counted.clear()
    pm.write_table(spark.table(f"{schemas[1]}.places").limit(1), f"{schemas[1]}.places")
    assert rows(run()) == gold and counted == {"build_silver": 1, "build_gold": 1}
    counted.clear()
    fewer = pages.filter("page <> 2")
    assert sum(row.asDict()["count"] for row in pm.run_pipeline(
        spark, fewer, str(tmp_path / "landing"), schemas=schemas, ledger=str(tmp_path / "ledger")).collect()) == 50
    assert counted["ingest_pages"] == 1 and counted["build_gold"] == 1
    assert rows(run(ledger=None)) == gold


def test_a_layer_is_tried_again(spark, schemas, tmp_path, monkeypatch, counted):
    plain, failures = layers.build_silver, [ValueError("once")]

    def sometimes(*args, **options):
        if failures:
            raise failures.pop()
        return plain(*args, **options)

    monkeypatch.setattr(layers, "build_silver", sometimes)
    run = partial(pm.run_pipeline, spark, page_log(spark, SF_DIR), str(tmp_path / "landing"), schemas=schemas)
    assert run(retries=1).count() > 0
    assert counted["build_bronze"] == counted["build_silver"] == 1
    failures += [ValueError("once"), ValueError("twice")]
    with pytest.raises(ValueError, match="once"):
        run(retries=1)


def test_fingerprint_of_pages(spark):
    rows = [(1, 200, "[]"), (2, 200, None), (2, 200, None)]
    frame = lambda rows: spark.createDataFrame(rows, "page int, status int, body string")
    first = fingerprint_of_pages(frame(rows))
    assert fingerprint_of_pages(frame(rows[::-1]).repartition(3)) == first
    assert len({first, fingerprint_of_pages(frame(rows[:2])), fingerprint_of_pages(frame(rows[:0])), fingerprint_of_pages(frame([(1, 200, "[ ]"), *rows[1:]]))}) == 4


def test_write_if_nonempty(spark, tmp_path):
    written = []
    assert not pm.write_if_nonempty(spark.range(0), written.append)
    assert pm.write_if_nonempty(spark.range(1), written.append)
    assert len(written) == 1


def test_guard_works_rows_out_once(spark, tmp_path):
    """A frame with a shuffle is run once, whether rows come of it or not."""
    for empty in (False, True):
        worked = spark.sparkContext.accumulator(0)

        @F.udf("bigint")
        def seen(k, worked=worked):
            worked.add(1)
            return k

        once = seen.asNondeterministic()  # so that the filter does not call it as well
        counted = spark.range(0, 100, 1, 4).groupBy((F.col("id") % 10).alias("k")).count().select(once("k").alias("k"), "count")
        counted = counted.filter(F.col("k") < (0 if empty else 10))
        wrote = pm.write_if_nonempty(counted, lambda df, empty=empty: pm.write_dataset(df, str(tmp_path / f"set{empty}")))
        assert (wrote, worked.value) == (not empty, 10)
        assert (tmp_path / f"set{empty}").exists() == wrote
    assert pm.write_if_nonempty(spark.range(1).select(), lambda _: None)
    assert not pm.write_if_nonempty(spark.range(0).select(), lambda _: None)


def test_overwrite_replaces_all_in_a_dynamic_session(spark, tmp_path):
    path, setting = str(tmp_path / "set"), "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        for key in ("a", "b"):
            pm.write_dataset(spark.createDataFrame([("1", key)], "id string, estado string"), path, partition_by=["estado"])
    finally:
        spark.conf.set(setting, before)
    assert [row["estado"] for row in pm.read_layer(spark, path).collect()] == ["b"]


def test_dataset_without_partitions(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "id string, estado string")
    for _ in range(2):
        pm.write_dataset(df, str(tmp_path / "set"))
    assert rows(pm.read_layer(spark, str(tmp_path / "set"))) == rows(df)


def test_schema_names_and_places_are_quoted(spark, tmp_path):
    name, root = f"1_{uuid.uuid4().hex}", tmp_path / "it's here"
    pm.ensure_schemas(spark, name, root=str(root))
    assert spark.catalog.databaseExists(f"`{name}`")
    spark.sql(f"DROP SCHEMA `{name}`")


def test_silver_refuses_records_without_landing_order(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": "1"}\n{"id": "1"}\n')
    with pytest.raises(Exception, match="load_seq is null"):
        pm.build_silver(pm.read_landing(spark, str(tmp_path))).collect()
    assert pm.build_silver(pm.read_landing(spark, str(tmp_path)), order=None).count() == 1


def test_scratch_leaves_nothing(spark, schemas, tmp_path, monkeypatch):
    pages = page_log(spark, SF_DIR)
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path / "shared"))
    pm.run_pipeline(spark, pages, str(tmp_path / "landing"), schemas=schemas, fill_site_first=False)
    folder = tmp_path / "shared" / "placemill"
    assert folder.is_dir() and list(folder.iterdir()) == []
    with pytest.raises(ZeroDivisionError), scratch(spark):
        pin(spark.range(3))
        assert len(list(folder.iterdir())) == 1
        raise ZeroDivisionError
    assert list(folder.iterdir()) == []


def test_unknown_fields_reach_silver(spark, schemas, tmp_path):
    record = [{"id": "a", "name": "n", "rating": 4, "tags": ["x"]}, {"id": "b"}]
    pages = spark.createDataFrame([(1, 200, json.dumps(record)), (2, 200, "[]")], "page int, status int, body string")
    pm.run_pipeline(spark, pages, str(tmp_path / "landing"), schemas=schemas)
    stored = {row["id"]: row[S.REST] for row in spark.table(f"{schemas[1]}.places").collect()}
    assert {key: value and json.loads(value) for key, value in stored.items()} == {
        "a": {"rating": "4", "tags": '["x"]'}, "b": None}
    wider = S.RECORD_SCHEMA.add("rating", "integer")
    try:
        pm.run_pipeline(spark, pages, str(tmp_path / "landing"), schemas=schemas, record_schema=wider, rest=None)
    finally:
        S.RECORD_SCHEMA.fields.pop()
        S.RECORD_SCHEMA.names.pop()
    assert {row["id"]: row["rating"] for row in spark.table(f"{schemas[1]}.places").collect()} == {"a": 4, "b": None}


def test_run_with_a_known_total(spark, schemas, tmp_path):
    pages = spark.createDataFrame(
        [(p, 200, json.dumps([{"id": f"{p}{k}"} for k in "ab"])) for p in (1, 2, 3)], "page int, status int, body string"
    )
    for total, count in ((3, 4), (0, 6), (2, 2)):
        pm.run_pipeline(spark, pages, str(tmp_path / "landing"), schemas=schemas, total_count=total, per_page=2)
        assert spark.table(f"{schemas[0]}.places").count() == count


def test_pin(spark):
    df = spark.range(5)
    copy = pin(df)
    assert f"{shared_dir(spark)}/placemill/" in copy.inputFiles()[0]
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert copy.count() == 5


class _Session:
    def __init__(self, **settings):
        self.conf = {f"spark.{name.replace('_', '.')}": value for name, value in settings.items()}


def test_shared_dir(tmp_path):
    assert shared_dir(_Session(checkpoint_dir="hdfs://x/ck/", master="yarn")) == "hdfs://x/ck"
    local = shared_dir(_Session(master="local[2]", app_id="a"))
    assert local == shared_dir(_Session(master="local[2]", app_id="a"))
    assert local != shared_dir(_Session(master="local[2]", app_id="b"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session(master="yarn"))
    with pytest.raises(ValueError, match="one machine"):
        shared_dir(_Session(checkpoint_dir="file:/tmp/x", master="yarn"))
    mounted = _Session(checkpoint_dir="file:/mnt/x", master="yarn")
    mounted.conf[SHARED_MOUNT] = "true"
    assert shared_dir(mounted) == "file:/mnt/x"
    assert shared_dir(_Session(checkpoint_dir="file:/tmp/x", master="local-cluster[2,1,1024]")) == "file:/tmp/x"


def test_silver_columns(spark):
    places = places_dup(spark, SF_DIR)
    silver = pm.build_silver(places)
    assert tuple(silver.columns) == S.SILVER_COLUMNS
    assert silver.schema.simpleString() == S.SILVER_SCHEMA.simpleString()
    struct = pm.build_silver(places, keep_struct=True)
    flags = struct.schema[S.FLAG_STRUCT].dataType
    assert flags.simpleString() == "struct<valida_forma:boolean,indicador_seguranca_site:boolean>"
    assert len(struct.columns) == 19


def test_silver_keeps_first_copy_and_unique_ids(spark):
    silver = pm.build_silver(places_dup(spark, SF_DIR))
    assert silver.count() == silver.select("id").distinct().count() == 150
    assert silver.filter("telefone = 'late'").count() == 0


def test_imputing_after_the_fill_changes_nothing(spark, rows):
    places = places_dup(spark, SF_DIR)
    silver = pm.build_silver(places)
    filled = silver.select("nome", "site", F.monotonically_increasing_id().alias("k"))
    assert rows(pm.impute_site_max(filled), "nome", "site") == rows(filled, "nome", "site")
    by_fill = pm.build_silver(places, impute="fill")
    lost = by_fill.filter("site IS NULL")
    assert lost.count() == silver.filter("nome IS NULL").count() > 0
    assert lost.filter("nome IS NOT NULL").count() == 0


def test_silver_options(spark, rows):
    places = places_dup(spark, SF_DIR)
    assert pm.build_silver(places).filter("estado = ''").count() > 0
    assert pm.build_silver(places, empty_to="-").filter("estado = ''").count() == 0
    same = places.drop(S.LOAD_SEQ, "phone").withColumn("phone", F.lit(None).cast("string"))
    any_copy = pm.build_silver(same, order=None)
    assert rows(any_copy.drop("telefone")) == rows(pm.build_silver(places).drop("telefone"))
    imputed = pm.build_silver(places, fill_site_first=False)
    assert imputed.filter("site = '-'").count() < pm.build_silver(places).filter("site = '-'").count()
    with pytest.raises(ValueError, match="order"):
        pm.build_silver(places, order=None, impute="fill", fill_site_first=False)


def test_gold_adds_up(spark):
    silver = pm.build_silver(places_dup(spark, SF_DIR))
    gold, dense = pm.build_gold(silver), pm.build_gold(silver, dense=True)
    assert gold.schema.simpleString() == S.GOLD_SCHEMA.simpleString() == dense.schema.simpleString()
    assert gold.agg(F.sum("count")).first()[0] == silver.count()
    left = dense.filter("count > 0").exceptAll(gold.filter("tipo_cervejaria IS NOT NULL"))
    assert left.isEmpty()


def test_run_twice(spark, schemas, tmp_path, rows):
    pages = page_log(spark, SF_DIR)
    landing = str(tmp_path / "landing")
    first = rows(pm.run_pipeline(spark, pages, landing, schemas=schemas))
    tables = [rows(spark.table(f"{schema}.places")) for schema in schemas]
    assert rows(pm.run_pipeline(spark, pages, landing, schemas=schemas)) == first
    assert [rows(spark.table(f"{schema}.places")) for schema in schemas] == tables
    bronze, silver, gold = tables
    assert len(bronze) == len(silver) == sum(r[-1] for r in gold) == 50


def test_run_with_options(spark, schemas, tmp_path):
    gold = pm.run_pipeline(
        spark, page_log(spark, SF_DIR), str(tmp_path / "landing"), schemas=schemas, table="sites", root=str(tmp_path),
        silver_partitions=["estado", "cidade"], gold_partitions=S.GOLD_KEYS, dense=True,
        fill_site_first=False, impute="fill", unicode=True, keep_struct=True, empty_to="-",
    )
    assert gold.columns == ["count", *S.GOLD_KEYS]
    silver = spark.table(f"{schemas[1]}.sites")
    assert silver.columns[-2:] == ["estado", "cidade"]
    assert len(silver.columns) == 20
    assert silver.filter("estado IS NULL").isEmpty()
    assert (tmp_path / schemas[1] / "sites").is_dir()


def test_run_without_records_writes_nothing(spark, schemas, tmp_path):
    pages = spark.createDataFrame([(1, 500, "oops")], "page int, status int, body string")
    assert pm.run_pipeline(spark, pages, str(tmp_path / "landing"), schemas=schemas) is None
    assert not (tmp_path / "landing").exists()
    assert not spark.catalog.databaseExists(schemas[0])


def test_run_stops_at_an_error(spark, schemas, tmp_path):
    pages = spark.createDataFrame([(1, 200, '[{"id": "a"}]'), (2, 200, "{oops")], "page int, status int, body string")
    with pytest.raises(Exception, match="no JSON list in page 2"):
        pm.run_pipeline(spark, pages, str(tmp_path / "landing"), schemas=schemas)
    assert not spark.catalog.databaseExists(schemas[0])

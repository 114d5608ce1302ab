"""Registered queries: each operator over whole given tables, or over place records derived from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill import schema as S
from placemill.functions import normalise_text, rewrite_scheme, url_flags, url_flags_struct
from placemill.operators import (
    add_url_flags,
    count_by,
    count_by_dense,
    dedup_any,
    dedup_first,
    fill_constants,
    global_position,
    impute_site_fill,
    impute_site_max,
    ingest_pages,
    normalise_columns,
    page_plan,
    rename_columns,
    rewrite_site,
    union_records,
)
from placemill.plans.fixtures import page_log, places_dup, places_raw, table
from placemill.plans.layers import build_gold, build_silver, run_pipeline
from placemill.sinks import ensure_schemas, write_dataset, write_if_nonempty, write_landing, write_table
from placemill.sources import read_landing, read_layer, read_page_files, split_landing
from placemill.staging import pin, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def _scratch_schema(spark: SparkSession) -> str:
    root, name = scratch_path(spark, "layers").rsplit("/", 1)
    name = name.replace("-", "_")
    ensure_schemas(spark, name, root=root)
    return name


# Rows


@_query
def q_rename(spark, sf_dir):
    return rename_columns(places_raw(spark, sf_dir))


@_query
def q_normalise(spark, sf_dir):
    return normalise_columns(rename_columns(places_raw(spark, sf_dir))).select("id", *S.STRIPPED, *S.TRIMMED)


@_query
def q_normalise_unicode(spark, sf_dir):
    wrapped = F.concat(F.lit("\t "), "name", F.lit(" x\u001f\n"))
    return places_raw(spark, sf_dir).select(
        "id",
        normalise_text(wrapped, unicode=True).alias("trimmed"),
        normalise_text(wrapped, strip_chars=True, unicode=True).alias("stripped"),
    )


@_query
def q_normalise_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", normalise_text("text").alias("trimmed"), normalise_text("text", strip_chars=True).alias("stripped")
    )


@_query
def q_normalise_unicode_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", normalise_text("text", strip_chars=True, unicode=True).alias("stripped")
    )


@_query
def q_fill_constants(spark, sf_dir):
    return fill_constants(rename_columns(places_raw(spark, sf_dir))).select("id", *S.FILLED)


@_query
def q_url_flags(spark, sf_dir):
    return add_url_flags(places_raw(spark, sf_dir).select("id", "website_url"), "website_url")


@_query
def q_url_flags_struct(spark, sf_dir):
    places = places_raw(spark, sf_dir).select("id", url_flags_struct("website_url").alias("flags"))
    return places.select("id", "flags.*")


@_query
def q_url_flags_pages(spark, sf_dir):
    valid, secure = url_flags("url")
    return table(spark, sf_dir, "pages").select("page_id", valid.alias("valid"), secure.alias("secure"))


@_query
def q_rewrite_scheme(spark, sf_dir):
    flagged = add_url_flags(places_raw(spark, sf_dir).select("id", F.col("website_url").alias("site")))
    return rewrite_site(flagged).select("id", "site")


@_query
def q_rewrite_scheme_pages(spark, sf_dir):
    # Page URLs are well-formed, so only cutting the host down to one word gives the repair something to do.
    dotless = F.regexp_replace("url", r"\.", "")
    cut = table(spark, sf_dir, "pages").select("page_id", dotless.alias("url"))
    return cut.select("page_id", rewrite_scheme("url", url_flags("url")[0]).alias("url"))


@_query
def q_union_records(spark, sf_dir):
    places = places_raw(spark, sf_dir)
    return union_records(places.select("id", "name", "phone"), places.select("id", "street", "name"))


# Deduplication


@_query
def q_dedup_first(spark, sf_dir):
    return dedup_first(places_dup(spark, sf_dir), "id", S.LOAD_SEQ)


@_query
def q_dedup_any(spark, sf_dir):
    return dedup_any(places_dup(spark, sf_dir).drop(S.LOAD_SEQ, "phone"), "id")


@_query
def q_dedup_first_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return dedup_first(lines, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@_query
def q_dedup_first_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return dedup_first(events, "user_id", "event_id")


@_query
def q_dedup_first_repeated_order(spark, sf_dir):
    # A user has many events of the first type; the row itself breaks the tie.
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return dedup_first(events, "user_id", "event_type")


# Imputation, on records whose missing sites have not been filled


def _unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Imputation reads its input several times.
    return pin(normalise_columns(rename_columns(places_dup(spark, sf_dir))).select("id", "nome", "site", S.LOAD_SEQ))


@_query
def q_impute_site_max(spark, sf_dir):
    return impute_site_max(_unfilled(spark, sf_dir))


@_query
def q_impute_site_fill(spark, sf_dir):
    return impute_site_fill(_unfilled(spark, sf_dir), S.LOAD_SEQ)


def _gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    clerk = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("p"), F.col("o_totalprice").cast("bigint")))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", clerk.alias("price_tag"))


@_query
def q_impute_site_max_orders(spark, sf_dir):
    return impute_site_max(_gappy_orders(spark, sf_dir), "o_orderstatus", "price_tag")


@_query
def q_impute_site_fill_orders(spark, sf_dir):
    return impute_site_fill(_gappy_orders(spark, sf_dir), "o_orderkey", "o_orderstatus", "price_tag")


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.when(F.col("event_id") % 5 == 0, F.concat_ws("-", "event_type", "event_id"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", tag.alias("tag"))


@_query
def q_impute_site_max_events(spark, sf_dir):
    return impute_site_max(_gappy_events(spark, sf_dir), "user_id", "tag")


@_query
def q_impute_site_fill_events(spark, sf_dir):
    # Many groups, each in many chunks.
    return impute_site_fill(_gappy_events(spark, sf_dir), "event_id", "user_id", "tag", span=97)


@_query
def q_impute_site_fill_ingested(spark, sf_dir):
    # The landing order, with the span that goes with it.
    places = ingest_pages(page_log(spark, sf_dir)).select("id", "name", "website_url", S.LOAD_SEQ)
    return impute_site_fill(pin(places), S.LOAD_SEQ, "name", "website_url")


# Silver and gold


@_query
def q_silver(spark, sf_dir):
    return build_silver(places_dup(spark, sf_dir))


@_query
def q_silver_impute_first(spark, sf_dir):
    return build_silver(places_dup(spark, sf_dir), fill_site_first=False)


@_query
def q_silver_impute_fill(spark, sf_dir):
    return build_silver(places_dup(spark, sf_dir), fill_site_first=False, impute="fill", chunk=1_000_000)


@_query
def q_silver_fill_then_impute(spark, sf_dir):
    return build_silver(places_dup(spark, sf_dir), impute="fill")


@_query
def q_silver_empty_to(spark, sf_dir):
    return build_silver(places_dup(spark, sf_dir), empty_to="?")


@_query
def q_silver_struct(spark, sf_dir):
    places = build_silver(places_dup(spark, sf_dir), keep_struct=True)
    flags = F.col(S.FLAG_STRUCT)
    valid, secure = flags[S.FLAG_STRUCT_VALID], flags[S.SECURE_FLAG]
    return places.select("id", "site", valid.alias("valid"), secure.alias("secure"))


@_query
def q_silver_table_two_keys(spark, sf_dir):
    name = f"{_scratch_schema(spark)}.silver"
    write_table(build_silver(places_dup(spark, sf_dir)), name, partition_by=["estado", "cidade"])
    return read_layer(spark, name)


@_query
def q_gold_count(spark, sf_dir):
    return build_gold(build_silver(places_dup(spark, sf_dir)))


@_query
def q_gold_count_dense(spark, sf_dir):
    return build_gold(build_silver(places_dup(spark, sf_dir)), dense=True, sort=True)


@_query
def q_gold_from_table(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_dataset(build_silver(places_dup(spark, sf_dir)), path, partition_by=["estado"])
    return build_gold(read_layer(spark, path))


@_query
def q_table_partitioned_by_keys(spark, sf_dir):
    name = f"{_scratch_schema(spark)}.gold"
    gold = build_gold(build_silver(places_dup(spark, sf_dir)))
    write_table(gold.select("estado"), name)
    write_table(gold, name, partition_by=S.GOLD_KEYS, replace_schema=True)
    return read_layer(spark, name)


@_query
def q_table_after_failed_write(spark, sf_dir):
    # The second write fails at its last records, when others are written already; the table is as the first left it.
    name = f"{_scratch_schema(spark)}.silver"
    silver = pin(build_silver(places_dup(spark, sf_dir)))
    write_table(silver, name, partition_by=["estado"])
    largest = silver.agg(F.max("id")).scalar()
    oops = F.raise_error(F.lit("a record that cannot be written")).cast("string")
    broken = silver.withColumn("nome", F.when(F.col("id") == largest, oops).otherwise(F.lit("second write")))
    try:
        write_table(broken, name, partition_by=["estado"])
    except Exception as error:
        if "cannot be written" not in str(error):
            raise
        return read_layer(spark, name)
    raise RuntimeError("the second write should have failed")


def _run(spark: SparkSession, pages: DataFrame, **options) -> tuple[DataFrame | None, tuple[str, ...]]:
    root = scratch_path(spark, "run")
    suffix = root.rsplit("-", 1)[1]
    schemas = tuple(f"{layer}_{suffix}" for layer in ("bronze", "silver", "gold"))
    return run_pipeline(spark, pages, f"{root}/landing", schemas=schemas, root=root, **options), schemas


@_query
def q_medallion_gold(spark, sf_dir):
    return _run(spark, page_log(spark, sf_dir))[0]


@_query
def q_medallion_gold_total(spark, sf_dir):
    # The source announces half as many records as it holds.
    announced = table(spark, sf_dir, "customer").count() // 2
    return _run(spark, page_log(spark, sf_dir), total_count=announced, per_page=50)[0]


@_query
def q_medallion_unknown_field(spark, sf_dir):
    # Records have a seventeenth field, of which the schema knows nothing.
    _, (_, silver, _) = _run(spark, page_log(spark, sf_dir, extra=True))
    return read_layer(spark, f"{silver}.places").select("id", S.REST)


@_query
def q_medallion_resumed(spark, sf_dir):
    # The first run fails in silver; the second goes on there, from the bronze table of the first.
    log, root = page_log(spark, sf_dir), scratch_path(spark, "run")
    suffix = root.rsplit("-", 1)[1]
    schemas = tuple(f"{layer}_{suffix}" for layer in ("bronze", "silver", "gold"))
    run = partial(run_pipeline, spark, log, f"{root}/landing", schemas=schemas, root=root, ledger=f"{root}/ledger")
    try:
        run(order=None, fill_site_first=False, impute="fill")
    except ValueError:
        return run()
    raise RuntimeError("the first run should have failed")


@_query
def q_first_page_failed(spark, sf_dir):
    # Records that are ingested if the first page answers, and if it does not.
    log = page_log(spark, sf_dir)
    down = log.withColumn("status", F.when(F.col("page") == 1, 503).otherwise(F.col("status")))
    counts = [
        ingest_pages(pages).agg(F.lit(case).alias("first_page"), F.count(F.lit(1)).alias("records"))
        for case, pages in (("up", log), ("down", down))
    ]
    return counts[0].union(counts[1])


@_query
def q_nothing_written_when_empty(spark, sf_dir):
    path = scratch_path(spark, "landing")
    places = places_raw(spark, sf_dir)
    outcomes = []
    for step, records in (("all", places), ("none", places.filter("id IS NULL"))):
        wrote = write_if_nonempty(records, partial(write_landing, path=path))
        stored = pin(read_landing(spark, path, S.RECORD_SCHEMA).agg(F.count(F.lit(1)).alias("stored")))
        outcomes.append(stored.select(F.lit(step).alias("step"), F.lit(wrote).alias("wrote"), "stored"))
    return outcomes[0].union(outcomes[1])


# Grouped counts on the other tables


@_query
def q_count_documents(spark, sf_dir):
    return count_by(table(spark, sf_dir, "documents"), "lang", "source")


@_query
def q_count_documents_dense(spark, sf_dir):
    return count_by_dense(table(spark, sf_dir, "documents"), "lang", "source")


@_query
def q_count_events(spark, sf_dir):
    return count_by(table(spark, sf_dir, "events"), "user_id", "event_type")


@_query
def q_count_events_dense(spark, sf_dir):
    return count_by_dense(table(spark, sf_dir, "events"), "user_id", "event_type")


@_query
def q_count_orders(spark, sf_dir):
    return count_by(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", sort=True)


@_query
def q_count_lineitem(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


# Paging


@_query
def q_page_plan(spark, sf_dir):
    return page_plan(table(spark, sf_dir, "customer").select("c_custkey"), position="c_custkey")


@_query
def q_page_plan_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page_plan(orders, "o_totalprice", "o_orderkey", unique=True)


@_query
def q_global_position_events(spark, sf_dir):
    # Events of a user have one type or another, so order values repeat; equal rows may take each other's place.
    events = table(spark, sf_dir, "events").select("event_type", "user_id")
    return global_position(events, "event_type", "user_id")


@_query
def q_ingest_pages(spark, sf_dir):
    return ingest_pages(page_log(spark, sf_dir))


@_query
def q_ingest_pages_unknown_field(spark, sf_dir):
    # Two records of three have a seventeenth field; no option says so.
    return ingest_pages(page_log(spark, sf_dir, extra=True))


@_query
def q_ingest_pages_total(spark, sf_dir):
    # The source announces half as many records as it holds: reading stops at the page that completes them.
    return ingest_pages(page_log(spark, sf_dir), total_count=table(spark, sf_dir, "customer").count() // 2)


@_query
def q_page_files(spark, sf_dir):
    path = scratch_path(spark, "pages")
    page_log(spark, sf_dir).write.partitionBy("page", "status").text(path)
    return ingest_pages(read_page_files(spark, path, r"/page=(\d+)/status=(\d+)/[^/]*$"))


# Files


@_query
def q_landing_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(places_raw(spark, sf_dir), path)
    return read_landing(spark, path, S.RECORD_SCHEMA)


@_query
def q_landing_rejects(spark, sf_dir):
    # Every seventh line is cut off behind its id.
    path = scratch_path(spark, "landing")
    places = places_raw(spark, sf_dir)
    cut = F.concat(F.lit('{"id": "'), "id", F.lit('"'))
    whole = F.to_json(F.struct(*S.SOURCE_COLUMNS))
    broken = F.substr("id", F.lit(4)).cast("bigint") % 7 == 0
    places.select(F.when(broken, cut).otherwise(whole).alias("line")).write.text(path)
    landing = split_landing(spark, path, S.RECORD_SCHEMA)
    return union_records(landing.records, landing.rejects.select("line"))


def _write_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    path = scratch_path(spark, "dataset")
    write = partial(write_dataset, places_raw(spark, sf_dir), path, partition_by=["state"])
    write(mode="overwrite")
    write(mode=mode)
    return read_layer(spark, path)


@_query
def q_dataset_append(spark, sf_dir):
    return _write_twice(spark, sf_dir, "append")


@_query
def q_dataset_overwrite(spark, sf_dir):
    return _write_twice(spark, sf_dir, "overwrite")


@_query
def q_dataset_unpartitioned(spark, sf_dir):
    path = scratch_path(spark, "dataset")
    write_dataset(places_raw(spark, sf_dir), path)
    return read_layer(spark, path)


@_query
def q_documents_by_lang(spark, sf_dir):
    path = scratch_path(spark, "documents")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", normalise_text("text").alias("text"))
    write_dataset(documents, path, partition_by=["lang"])
    return read_layer(spark, path)

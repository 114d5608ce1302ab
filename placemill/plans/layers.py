"""The three layers and the run that builds them."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill import schema as S
from placemill.operators import (
    add_url_flags,
    count_by,
    count_by_dense,
    dedup_any,
    dedup_first,
    fill_constants,
    first_bad_page,
    impute_site_fill,
    impute_site_max,
    ingest_pages,
    normalise_columns,
    rename_columns,
    rewrite_site,
)
from placemill.operators.ingest import page_limit
from placemill.plans.ledger import Ledger, attempt, digest_of, fingerprint_of_pages
from placemill.sinks import ensure_schemas, write_landing, write_table
from placemill.sinks.versions import current_version
from placemill.sources import read_landing, read_layer, split_landing
from placemill.staging import path_exists, pin, scratch


def build_bronze(
    spark: SparkSession, landing: str, schema: T.StructType = S.LANDING_SCHEMA, *, rejects: str | None = None
) -> DataFrame:
    """Landed records, unchanged, with their landing order. A line that is no record fails the job, unless ``rejects``
    names a table: then such lines go there, as rows (file, line), in place of those of an earlier call."""
    if rejects is None:
        return read_landing(spark, landing, schema)
    split = split_landing(spark, landing, schema)
    write_table(split.rejects, rejects)
    return split.records


def build_silver(
    bronze: DataFrame,
    *,
    order: str | None = S.LOAD_SEQ,
    impute: Literal["max", "fill"] = "max",
    fill_site_first: bool = True,
    unicode: bool = False,
    keep_struct: bool = False,
    empty_to: str | None = None,
    chunk: int | None = None,
    per_page: int = 50,
) -> DataFrame:
    """Clean records: rename, deduplicate, normalise, fill nulls, flag URLs, impute and repair sites.

    * ``order``: keep the first record of an id in this column's order, of which a null or, within an id, repeated value
      fails the job; None keeps any.
    * ``fill_site_first``: missing sites become ``-`` before imputation, which then finds nothing to fill and is left
      out. False imputes first and fills what remains; flags and repair then see the imputed site.
    * ``impute``: ``"max"`` takes the group's largest site, a missing name being a group; ``"fill"`` the next site in
      ``order``, else the previous one, and records without a name lose their site. ``chunk`` is its ``span``, by
      default one for pages of ``per_page`` records.
    * ``unicode``: Unicode whitespace in text normalisation.
    * ``keep_struct``: add both URL flags as one struct column, too.
    * ``empty_to``: replaces state and city names that normalisation left empty. As partition values they would
      otherwise be read back as null.

    Columns that the source has beyond the declared ones come last, as they are. Needs one shuffle. Imputing first also
    writes the cleaned records to the shared folder, as several steps read them; build and write silver within
    ``scratch`` to have that copy deleted.
    """
    renamed = rename_columns(bronze)
    extra = [name for name in bronze.columns if name not in (*S.RENAMES, S.LOAD_SEQ, order)]
    unique = dedup_first(renamed, "id", order, unique=True) if order else dedup_any(renamed, "id")
    clean = normalise_columns(unique, unicode=unicode)
    if empty_to is not None:
        clean = clean.replace("", empty_to, subset=["estado", "cidade"])
    if fill_site_first:
        filled = fill_constants(clean)
    elif impute == "max":
        filled = fill_constants(impute_site_max(pin(clean, "clean")))
    elif order:
        filled = fill_constants(impute_site_fill(pin(clean, "clean"), order, span=chunk, per_page=per_page))
    else:
        raise ValueError('impute="fill" needs an order')
    flagged = add_url_flags(filled, keep_struct=keep_struct)
    if fill_site_first and impute == "fill":
        flagged = flagged.withColumn("site", F.when(F.col("nome").isNotNull(), F.col("site")))
    struct = [S.FLAG_STRUCT] if keep_struct else []
    return rewrite_site(flagged).select(*S.RENAMES.values(), *struct, S.VALID_FLAG, S.SECURE_FLAG, *extra)


def build_gold(silver: DataFrame, *, dense: bool = False, sort: bool = False) -> DataFrame:
    """Places by state and type: pairs that occur, or with ``dense`` all pairs."""
    return (count_by_dense if dense else count_by)(silver, *S.GOLD_KEYS, sort=sort)


def run_pipeline(
    spark: SparkSession,
    pages: DataFrame,
    landing: str,
    *,
    schemas: tuple[str, str, str] = ("bronze", "silver", "gold"),
    table: str = "places",
    root: str | None = None,
    silver_partitions: Sequence[str] = ("estado",),
    gold_partitions: Sequence[str] = (),
    dense: bool = False,
    max_pages: int | None = None,
    total_count: int | None = None,
    per_page: int = 50,
    record_schema: T.StructType = S.RECORD_SCHEMA,
    rest: str | None = S.REST,
    ledger: str | None = None,
    retries: int = 0,
    **silver_options,
) -> DataFrame | None:
    """Land the pages, then rebuild bronze, silver and gold, each from the stored layer before it.

    Returns the gold table, or None if there was nothing to land; then nothing is written. An error stops the run, and
    every layer stays as it was or is whole. ``max_pages``, ``total_count``, ``per_page``, ``record_schema`` and ``rest``
    are those of :func:`ingest_pages`; columns beyond the declared ones, and ``rest``, are kept up to silver. ``silver_options`` go to :func:`build_silver`. Intermediate copies are deleted when the run ends.

    ``ledger`` is a folder that notes each finished layer with a fingerprint of what it was made from: the pages, the
    options that matter, the layer before. A run with the same pages and options goes on at the first layer that is not
    noted or no longer stored as noted, and does not decode the pages again if they were landed. ``retries``: how often a
    layer that fails is tried again by itself before the run stops.
    """
    bronze, silver, gold = (f"{schema}.{table}" for schema in schemas)

    def land() -> dict:
        # One number, worked out once: it then filters the page scan of the landing. Each page before it has records.
        stop = first_bad_page(pages, max_pages=page_limit(max_pages, total_count, per_page)).first()["stop"]
        if stop <= 1:
            return {"schema": None}
        records = ingest_pages(pages, stop=stop, record_schema=record_schema, rest=rest)
        write_landing(records, landing)
        return {"schema": records.schema.json()}

    def make_bronze() -> dict:
        ensure_schemas(spark, *schemas, root=root)
        write_table(build_bronze(spark, landing, T.StructType.fromJson(json.loads(landed["schema"]))), bronze)
        return {"version": current_version(spark, bronze)}

    def make_silver() -> dict:
        with scratch(spark):
            cleaned = build_silver(read_layer(spark, bronze), per_page=per_page, **silver_options)
            write_table(cleaned, silver, partition_by=silver_partitions)
        return {"version": current_version(spark, silver)}

    def make_gold() -> dict:
        write_table(build_gold(read_layer(spark, silver), dense=dense), gold, partition_by=gold_partitions)
        return {"version": current_version(spark, gold)}

    def stored(name: str) -> Callable[[dict], bool]:
        return lambda noted: noted["version"] is not None and noted["version"] == current_version(spark, name)

    if ledger is None:
        landed = attempt(land, retries)
        if landed["schema"] is None:
            return None
        for make in (make_bronze, make_silver, make_gold):
            attempt(make, retries)
        return read_layer(spark, gold)
    book = Ledger(spark, ledger)
    options = (landing, max_pages, total_count, per_page, record_schema.json(), rest)
    made_from = digest_of(fingerprint_of_pages(pages), *options)
    there = lambda noted: noted["schema"] is None or path_exists(spark, f"{landing}/_SUCCESS")
    landed = book.run("landing", made_from, land, still=there, retries=retries)
    if landed["schema"] is None:
        return None
    made_from = digest_of(made_from, bronze)
    noted = book.run("bronze", made_from, make_bronze, still=stored(bronze), retries=retries)
    made_from = digest_of(made_from, noted["version"], silver, silver_partitions, silver_options)
    noted = book.run("silver", made_from, make_silver, still=stored(silver), retries=retries)
    made_from = digest_of(made_from, noted["version"], gold, gold_partitions, dense)
    book.run("gold", made_from, make_gold, still=stored(gold), retries=retries)
    return read_layer(spark, gold)

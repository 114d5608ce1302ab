"""Times the headline queries; prints one JSON line.

Inputs derived from the given tables (bronze records, landed pages, stored silver) are written once, before timing, as a
run would find them. Each query is run once to warm up; its time is the best of three further runs.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

import placemill as pm
from placemill.plans.fixtures import page_log, places_dup
from placemill.plans.queries import QUERIES
from placemill.staging import pin, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("placemill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(query) -> float:
    query()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        query()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def main() -> None:
    spark = session()
    bronze = pin(places_dup(spark, SF_DIR), "bronze")
    log = page_log(spark, SF_DIR)
    silver_path = scratch_path(spark, "silver")
    pm.write_dataset(pm.build_silver(bronze), silver_path, partition_by=["estado"])
    silver = pm.read_layer(spark, silver_path)
    root = scratch_path(spark, "run")
    schemas = tuple(f"{layer}_{root.rsplit('-', 1)[1]}" for layer in ("bronze", "silver", "gold"))

    queries = {
        "ingest_pages": lambda: run(pm.ingest_pages(log)),
        "url_flags": lambda: run(pm.add_url_flags(bronze, "website_url")),
        "silver": lambda: run(pm.build_silver(bronze)),
        "silver_impute_first": lambda: run(pm.build_silver(bronze, fill_site_first=False)),
        "gold_count": lambda: run(pm.build_gold(silver)),
        "gold_count_dense": lambda: run(pm.build_gold(silver, dense=True)),
        "medallion_gold": lambda: pm.run_pipeline(spark, log, f"{root}/landing", schemas=schemas, root=root).collect(),
    }
    queries["silver_impute_fill"] = lambda: run(pm.build_silver(bronze, fill_site_first=False, impute="fill", chunk=1_000_000))
    for name in (
        "dedup_any",
        "global_position_events",
        "impute_site_max_events",
        "impute_site_fill_events",
        "normalise_documents",
        "count_lineitem",
        "count_events_dense",
        "dedup_first_lineitem",
        "impute_site_max_orders",
        "impute_site_fill_orders",
        "page_plan_orders",
    ):
        queries[name] = lambda query=QUERIES[name]: run(query(spark, SF_DIR))

    seconds = {name: timed(query) for name, query in queries.items()}
    total = round(sum(seconds.values()), 4)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

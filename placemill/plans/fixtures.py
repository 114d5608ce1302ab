"""Place records derived from the given tables, for the registered queries and the tests.

``PLACES_RAW`` and ``PLACES_DUP`` are SQL that Spark and DuckDB both run, so that both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill import schema as S
from placemill.staging import pin

PER_PAGE = 50

# One record for each customer, with every kind of value the cleaning steps must deal with.
PLACES_RAW = """
WITH numbered AS (
  SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey,
         c_custkey % (SELECT count(*) FROM {pages}) AS url_no
  FROM {customer}),
base AS (
  SELECT c.k, c.seg, n.n_name AS nat, r.r_name AS reg, p.url
  FROM numbered c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN {pages} p ON p.page_id = c.url_no)
SELECT 'id-' || CAST(k AS STRING) AS id,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 4 = 0 THEN '- ' || seg || ' São "Co." ' || nat
       ELSE '  ' || seg || ' ' || nat || ' ' END AS name,
  CASE WHEN k % 19 = 0 THEN NULL ELSE ' ' || seg || ' ' END AS brewery_type,
  CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k AS STRING) || ' Main St' END AS address_1,
  CASE WHEN k % 6 = 0 THEN 'Suite ' || CAST(k AS STRING) ELSE NULL END AS address_2,
  CAST(NULL AS STRING) AS address_3,
  CASE WHEN k % 23 = 0 THEN NULL ELSE nat || '!' END AS city,
  reg || ' ' AS state_province,
  CAST(10000 + k AS STRING) AS postal_code,
  ' Country ' || reg AS country,
  CAST(k % 360 - 180 AS STRING) AS longitude,
  CAST(k % 180 - 90 AS STRING) AS latitude,
  CASE WHEN k % 8 = 0 THEN NULL ELSE CAST(5550000 + k AS STRING) END AS phone,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 11 = 0 THEN 'http://localhost/' || CAST(k AS STRING)
       WHEN k % 13 = 0 THEN upper(url) ELSE url END AS website_url,
  CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN '***' ELSE ' ' || reg || '# ' END AS state,
  CASE WHEN k % 3 = 0 THEN NULL ELSE ' Main St ' END AS street
FROM base
"""

# Every tenth id a second time, later and with another phone.
PLACES_DUP = """
SELECT *, CAST(substr(id, 4) AS BIGINT) AS load_seq FROM {places_raw}
UNION ALL
SELECT id, name, brewery_type, address_1, address_2, address_3, city, state_province, postal_code, country,
  longitude, latitude, 'late' AS phone, website_url, state, street,
  CAST(substr(id, 4) AS BIGINT) + 1000000000000 AS load_seq
FROM {places_raw} WHERE CAST(substr(id, 4) AS BIGINT) % 10 = 0
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "nation", "region", "pages")}
    return spark.sql(PLACES_RAW, **tables)


def places_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PLACES_DUP, places_raw=places_raw(spark, sf_dir))


def page_log(spark: SparkSession, sf_dir: str, *, extra: bool = False) -> DataFrame:
    """``places_raw`` as landed (so: stored) pages of 50 records. Two thirds through lies an empty page, behind it a
    failed one. With ``extra``, two records of three have a further field, ``rating``.
    """
    number = F.substr("id", F.lit(4)).cast("bigint")
    rating = [F.when(number % 3 != 0, (number % 5).cast("string")).alias("rating")] if extra else []
    record = F.struct(*S.SOURCE_COLUMNS, *rating)
    numbered = F.struct(number.alias("k"), record.alias("record"))
    pages = (
        places_raw(spark, sf_dir)
        .groupBy((F.floor(number / PER_PAGE) + 1).cast("int").alias("page"))
        .agg(F.array_sort(F.collect_list(numbered)).alias("numbered"))
        .select("page", F.to_json(F.transform("numbered", lambda n: n["record"])).alias("body"))
    )
    count = table(spark, sf_dir, "customer").agg(F.ceil(F.ceil(F.count(F.lit(1)) / PER_PAGE) * 2 / 3).alias("e"))
    empty = count.scalar()
    failed = F.col("page") == empty + 1
    log = pages.select(
        "page",
        F.when(failed, 500).otherwise(200).alias("status"),
        F.when(F.col("page") == empty, "[]").when(failed, "oops").otherwise(F.col("body")).alias("body"),
    )
    return pin(log, "pages")

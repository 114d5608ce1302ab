from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill import schema as S
from placemill.functions.paging import record_seq

# Bodies that decode to an empty page: an empty list, or any other JSON value that counts as nothing.
_EMPTY_BODY = r'^\s*(\[\s*\]|\{\s*\}|""|null|false|-?0+(\.0*)?)\s*\z'

#: Keys beyond the declared ones that may become columns.
MOST_KEYS = 1000


def first_bad_page(pages: DataFrame, *, max_pages: int | None = None) -> DataFrame:
    """One row, one column ``stop``: the number of the page at which reading stops.

    That is the lowest page number that is missing, has a status other than 200, is empty, or lies beyond
    ``max_pages``. Every page vouches for itself and names its successor, so one aggregation of small integers finds
    all of this, without sorting the pages or walking through them. A page before the stop that was landed twice with
    status 200 would double its records, and fails the job.
    """
    good = (F.col("status") == 200) & F.coalesce(~F.col("body").rlike(_EMPTY_BODY), F.lit(True))
    page = F.col("page").cast("bigint")
    landed = F.coalesce(F.col("status") == 200, F.lit(False)).cast("int")
    itself = F.struct(page.alias("page"), F.coalesce(good, F.lit(False)).alias("good"), landed.alias("landed"))
    successor = F.struct((page + 1).alias("page"), F.lit(False).alias("good"), F.lit(0).alias("landed"))
    named = _up_to(pages, max_pages).filter("page >= 1").select(F.inline(F.array(itself, successor)))
    first = pages.sparkSession.range(1, 2, 1, 1)
    start = first.select(F.col("id").alias("page"), F.lit(False).alias("good"), F.lit(0).alias("landed"))
    by_page = named.unionByName(start).groupBy("page").agg(F.max("good").alias("good"), F.sum("landed").alias("landed"))
    found = by_page.agg(
        F.min(F.when(~F.col("good"), F.col("page"))).alias("stop"),
        F.min(F.when(F.col("landed") > 1, F.col("page"))).alias("twice"),
    )
    doubled = F.raise_error(F.concat(F.lit("landed twice: page "), F.col("twice").cast("string"))).cast("bigint")
    return found.select(F.when(F.col("twice") < F.col("stop"), doubled).otherwise(F.col("stop")).alias("stop"))


def page_limit(max_pages: int | None, total_count: int | None, per_page: int) -> int | None:
    """Pages to read at most: ``max_pages``, and no more than ``total_count`` records need. Zero or None is no limit."""
    if total_count:
        needed = -(-total_count // per_page)
        max_pages = min(needed, max_pages) if max_pages else needed
    return max_pages


def _up_to(pages: DataFrame, max_pages: int | None) -> DataFrame:
    # A filter the scan can use. The page after the last is then missing, and so a stop like any other.
    return pages.filter(F.col("page") <= max_pages) if max_pages else pages


def _list_text() -> Column:
    """The body of a page, which must be a JSON list."""
    no_list = F.raise_error(F.concat(F.lit("no JSON list in page "), F.col("page").cast("string"))).cast("string")
    return F.when(F.col("body").rlike(r"^\s*\["), F.col("body")).otherwise(no_list)


def other_keys(pages: DataFrame, stop: int, record_schema: T.StructType, *, most: int = MOST_KEYS) -> list[T.StructField]:
    """Fields for the keys that records before page ``stop`` have and ``record_schema`` lacks, sorted by name.

    All are text, as the declared fields are: a key that holds a text here and a number there is one column, and the text
    of a number, list or object is its JSON. Keys are collected in each task, so names alone are shuffled. Records that
    use keys for data would make a column of each; with more than ``most`` such keys, or keys that differ from each other
    or from another column only in case, which columns cannot, the call fails and ``rest`` is the way to keep them.
    """
    read = pages.filter((F.col("page") >= 1) & (F.col("status") == 200) & (F.col("page") < stop))
    records = read.select(F.explode(F.from_json(_list_text(), "array<map<string, string>>", {"mode": "FAILFAST"})).alias("record"))
    names = records.select(F.explode(F.map_keys("record")).alias("name")).distinct()
    names = names.filter(~F.col("name").isin(record_schema.names))
    found = sorted(row["name"] for row in names.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"records have more than {most} keys beyond their schema; name a column for them with rest=")
    taken = {name.lower() for name in (*record_schema.names, S.LOAD_SEQ, "page", "pos")}
    for name in found:
        if name.lower() in taken:
            raise ValueError(f"key {name} clashes with another column; name a column for unknown keys with rest=")
        taken.add(name.lower())
    return [T.StructField(name, T.StringType()) for name in found]


def ingest_pages(
    pages: DataFrame,
    *,
    record_schema: T.StructType = S.RECORD_SCHEMA,
    max_pages: int | None = None,
    total_count: int | None = None,
    per_page: int = 50,
    stop: int | None = None,
    keep_position: bool = False,
    rest: str | None = None,
    extra: bool = True,
) -> DataFrame:
    """Records of the pages before the first bad one, from rows (page, status, body), one for each page.

    ``total_count`` limits the pages to those needed for that many records; zero means unknown. Fields a record lacks
    are null. A page before the stop that is no JSON list fails the job; what follows the stop is never decoded. Adds
    the landing order ``load_seq``, and with ``keep_position`` also ``page`` and ``pos``. Pass ``stop`` when it is
    known: it then filters the scan instead of being worked out first.

    The columns are the union of all records' keys: fields that ``record_schema`` does not name become columns of text
    behind it, in the order of their names (see :func:`other_keys`; this reads the pages before the stop once more, when
    the function is called). ``extra=False`` leaves such fields out. ``rest`` instead names one column for them: it holds
    them as a JSON object of texts, null where there are none; each record is then decoded twice.
    """
    pages = _up_to(pages, page_limit(max_pages, total_count, per_page))
    if extra and rest is None:
        stop = first_bad_page(pages).first()["stop"] if stop is None else stop
        record_schema = T.StructType([*record_schema, *other_keys(pages, stop, record_schema)])
    limit = F.lit(stop) if stop is not None else first_bad_page(pages).scalar()
    strict = {"mode": "FAILFAST"}
    decoded = F.from_json(_list_text(), T.ArrayType(T.StringType() if rest else record_schema), strict)
    # Not posexplode: from it Spark infers size(decoded) > 0 and may decode pages before the stop filter drops them.
    records = (
        pages.filter((F.col("page") >= 1) & (F.col("status") == 200) & (F.col("page") < limit))
        .select("page", F.posexplode_outer(decoded).alias("pos", "record"))
        .filter(F.col("pos").isNotNull())
    )
    fields, others = ["record.*"], []
    if rest:
        unnamed = F.map_filter(
            F.from_json("record", "map<string, string>", strict), lambda name, _: ~name.isin(record_schema.names)
        )
        records = records.withColumn("whole", F.from_json("record", record_schema, strict))
        fields, others = ["whole.*"], [F.when(F.size(unnamed) > 0, F.to_json(unnamed)).alias(rest)]
    position = ["page", "pos"] if keep_position else []
    return records.select(*fields, *position, record_seq(F.col("page"), F.col("pos")).alias(S.LOAD_SEQ), *others)

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill import schema as S

_INFER_PARTITION_TYPES = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_page_files(spark: SparkSession, path: str, pattern: str = r"/page-(\d+)(?:\.(\d+))?\.json$") -> DataFrame:
    """Page files as rows (page, status, body).

    ``pattern`` takes the page number, and optionally the status (else 200), from a file's path. Files are read whole:
    a JSON scan would yield nothing for an empty page and so hide it.
    """
    name = F.col("_metadata.file_path")
    status = F.regexp_extract(name, pattern, 2)
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(name, pattern, 1).cast("int").alias("page"),
        F.when(status == "", 200).otherwise(status.cast("int")).alias("status"),
        F.col("value").alias("body"),
    )


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType = S.LANDING_SCHEMA, *, mode: str = "FAILFAST"
) -> DataFrame:
    """Records from JSON lines, with a declared schema; a field that a line lacks is null."""
    return spark.read.schema(schema).json(path, mode=mode)


class Landing(NamedTuple):
    """A landing's ``records``, and the ``rejects``: lines that are no record, as rows (file, line)."""

    records: DataFrame
    rejects: DataFrame

    def reject_counts(self) -> DataFrame:
        """Rejected lines of each file that has any: rows (file, rejects)."""
        return self.rejects.groupBy("file").agg(F.count(F.lit(1)).alias("rejects"))


_LINE = "__rejected_line"


def split_landing(spark: SparkSession, path: str, schema: T.StructType = S.LANDING_SCHEMA) -> Landing:
    """Records and rejects of JSON lines. No line is lost: each is a record or a reject, but for blank ones.

    A line is rejected if it is no JSON object, is cut off, or has a value that its declared type cannot hold. Rejects
    keep the line as it was. Both sides scan the files by themselves; neither shuffles. :func:`read_landing` instead
    fails at the first such line.
    """
    wide = T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}
    # As text, since a JSON scan cannot be asked for the rejected lines alone.
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.col("_metadata.file_name").alias("file"), "value", F.from_json("value", wide, options).alias("record"))
    # A line that is JSON, but no object, gives no record at all.
    rejected = F.col("record").isNull() | F.col(f"record.{_LINE}").isNotNull()
    rejects = parsed.filter(rejected).select("file", F.col("value").alias("line"))
    return Landing(parsed.filter(~rejected).select("record.*").drop(_LINE), rejects)


def read_layer(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored layer: a table by ``schema.table``, or a Parquet dataset by path.

    Partition values are read as the text they were written as (``01`` stays ``01``), unless ``schema`` says otherwise.
    """
    if "/" not in source:
        return spark.table(source)
    if schema is not None:
        return spark.read.schema(schema).parquet(source)
    # In a session of its own, so that other threads keep their settings.
    own = spark.newSession()
    own.conf.set(_INFER_PARTITION_TYPES, "false")
    found = own.read.parquet(source).schema
    names = [name for name in found.names]
    return spark.read.schema(T.StructType([found[name] for name in names])).parquet(source)

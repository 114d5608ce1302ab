"""Token counts as rollups that signed deltas keep up to date.

A batch is a table of signed changes: +1 for an inserted document, -1 for a deleted one, both for a revised one. It is
summed by source, language and tokenizer version and committed under its own number. Totals are the sum over all
committed batches. Committing a number again with the same changes does nothing, whether the first attempt ended or died
half-way; with other changes it is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.staging import path_exists, remove_path

KEYS = ("source", "lang", "tokenizer")

#: Tokenizer versions that built-in expressions can count; ``bpe.count_tokens`` counts those of a vocabulary file.
TOKENIZERS = {
    "space-1": r"[^ \t\n\r]+",
    "word-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
}


def count_tokens(text: Column, tokenizer: str) -> Column:
    """Tokens of a whole text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("bigint")


def inserted(counts: DataFrame) -> DataFrame:
    """Changes that add documents, from rows with the columns KEYS and ``tokens``."""
    return counts.select(*KEYS, F.lit(1).cast("bigint").alias("docs"), F.col("tokens").cast("bigint").alias("tokens"))


def deleted(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("bigint").alias("docs"), (-F.col("tokens")).cast("bigint").alias("tokens"))


def revised(counts: DataFrame, *, old: str = "old_tokens", new: str = "tokens") -> DataFrame:
    """Changes for documents whose count was ``old`` and is ``new``."""
    return counts.select(*KEYS, F.lit(0).cast("bigint").alias("docs"), (F.col(new) - F.col(old)).cast("bigint").alias("tokens"))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def _digest(summed: DataFrame) -> int:
    """Of the rows of a batch, in any order; each key has one row."""
    row = F.xxhash64(F.to_json(F.struct(*KEYS, "docs", "tokens"), {"ignoreNullFields": "false"}))
    return summed.agg(F.coalesce(F.bit_xor(row), F.lit(0)).alias("digest")).first()["digest"]


class Rollup:
    """Committed batches below ``root``, a folder that all executors share.

    ``base=N`` holds the batches below N, folded together, ``seen=N`` their digests, ``batch=N`` each batch. A folder
    counts once its write has ended (Spark's ``_SUCCESS``); what a lost driver left half-written is replaced by the next
    attempt. One writer at a time commits or folds.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}={number}"

    def _done(self, path: str) -> bool:
        return path_exists(self.spark, f"{path}/_SUCCESS")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Commit ``changes`` as batch ``batch`` (0, 1, 2, ...); False if that batch is committed already.

        Batches are committed in order. A null source, language or tokenizer is a key like any other. Changes are summed
        in each task before the shuffle, so a hot source costs no more than any other. A batch that is delivered again is
        summed and compared with the digest of the committed one; ValueError if it holds other changes.
        """
        if self.is_committed(batch):
            if _digest(_summed(changes)) != self._digest_of(batch):
                raise ValueError(f"batch {batch} has been committed with other changes")
            return False
        if batch and not self.is_committed(batch - 1):
            raise ValueError(f"batch {batch - 1} has not been committed")
        _summed(changes).write.mode("overwrite").parquet(self._path("batch", batch))
        return True

    def is_committed(self, batch: int) -> bool:
        return batch < self._folded() or self._done(self._path("batch", batch))

    def _digest_of(self, batch: int) -> int:
        folded = self._folded()
        if batch < folded:
            seen = self.spark.read.schema("batch bigint, digest bigint").parquet(self._path("seen", folded))
            return seen.filter(F.col("batch") == batch).first()["digest"]
        return _digest(self._read([self._path("batch", batch)]))

    def _folded(self) -> int:
        """Batches below this number are in the base of the same number."""
        number, found = 1, 0
        while self._done(self._path("base", number)):
            found, number = number, number * 2
        # Bases are kept at powers of two, so a few looks find the last.
        return found

    def _open(self) -> list[str]:
        folded = self._folded()
        paths = [self._path("base", folded)] if folded else []
        batch = folded
        while self._done(self._path("batch", batch)):
            paths.append(self._path("batch", batch))
            batch += 1
        return paths

    def fold(self) -> None:
        """Sum up committed batches, so that later reads open few folders. Totals stay as they are.

        Batches that an earlier call folded are deleted: totals asked for before the last fold can still be read.
        """
        before = self._folded()
        while True:
            folded = self._folded()
            until = folded * 2 or 1
            if not all(self._done(self._path("batch", batch)) for batch in range(folded, until)):
                break
            new = [(batch, self._digest_of(batch)) for batch in range(folded, until)]
            digests = self.spark.createDataFrame(new, "batch bigint, digest bigint")
            if folded:
                digests = digests.union(self.spark.read.schema(digests.schema).parquet(self._path("seen", folded)))
            digests.write.mode("overwrite").parquet(self._path("seen", until))
            parts = ([self._path("base", folded)] if folded else []) + [
                self._path("batch", batch) for batch in range(folded, until)
            ]
            _summed(self._read(parts)).write.mode("overwrite").parquet(self._path("base", until))
        # From the lowest up, so that what an ended run leaves behind adjoins ``before`` and is found again.
        lowest = before
        while lowest and path_exists(self.spark, self._path("batch", lowest - 1)):
            lowest -= 1
        for batch in range(lowest, before):
            remove_path(self.spark, self._path("batch", batch))

    def _read(self, paths: list[str]) -> DataFrame:
        schema = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version; keys without documents are left out."""
        return _summed(self._read(self._open())).filter("docs != 0 OR tokens != 0")

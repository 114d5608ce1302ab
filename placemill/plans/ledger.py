"""Which layers a run has finished, so that a repeated run goes on where the one before failed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.staging import path_exists, remove_path


def fingerprint_of_pages(pages: DataFrame) -> str:
    """A text that differs for different pages, whatever order and files they lie in. Bodies are read, not decoded.

    Hashes of the rows are added up in each task; one number for each half of the hash and a count leave it.
    """
    columns = ["page", "status", "body"]
    halves = [F.xxhash64(F.lit(salt), *columns).cast("decimal(20,0)") for salt in (1, 2)]
    sums = [F.coalesce(F.sum(half), F.lit(0)).cast("string") for half in halves]
    found = pages.agg(F.count(F.lit(1)).cast("string").alias("n"), sums[0].alias("a"), sums[1].alias("b")).first()
    return digest_of("pages", *found)


def digest_of(*parts: object) -> str:
    """Of the parts' texts; a mapping counts by its sorted items."""
    texts = [json.dumps(dict(sorted(part.items())), default=str) if isinstance(part, Mapping) else str(part) for part in parts]
    return hashlib.sha256("\0".join(texts).encode()).hexdigest()


class Ledger:
    """Entries below ``root``, one for each finished layer: what it was made from, and what was made.

    An entry is written when its layer is whole, and deleted before the layer is written anew; so an entry that is there
    describes what is stored, whenever a run died.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")

    def finished(self, layer: str, made_from: str) -> dict | None:
        """What was noted when the layer was made from this; None if it was not, or not finished."""
        path = f"{self._root}/{layer}/{made_from}"
        if not path_exists(self._spark, f"{path}/_SUCCESS"):
            return None
        row = self._spark.read.text(path).first()
        return json.loads(row["value"]) if row else None

    def run(self, layer: str, made_from: str, make: Callable[[], dict], *, still: Callable[[dict], bool], retries: int = 0) -> dict:
        """What the layer's entry notes; made first, unless it was finished and is ``still`` there.

        A layer that fails is tried ``retries`` more times by itself.
        """
        noted = self.finished(layer, made_from)
        if noted is not None and still(noted):
            return noted
        remove_path(self._spark, f"{self._root}/{layer}")
        noted = attempt(make, retries)
        frame = self._spark.createDataFrame([(json.dumps(noted),)], "value string")
        frame.coalesce(1).write.text(f"{self._root}/{layer}/{made_from}")
        return noted


def attempt[T](make: Callable[[], T], retries: int) -> T:
    """``make()``, tried again up to ``retries`` times; the last error is raised."""
    for left in reversed(range(retries + 1)):
        try:
            return make()
        except Exception:
            if not left:
                raise
    raise AssertionError("unreachable")

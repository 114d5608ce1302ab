"""URL filter: rules first, then a list of URLs behind a blocked Bloom filter, in built-in expressions.

Most URLs are not on the list. A blocked Bloom filter of the list (each key sets one bit in each of the eight 64-bit
words of one block) lets nearly only URLs on it pass; these alone go through an exact hash join, which removes the false
positives.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.staging import pin

#: Bits of the filter for each listed URL. A block has WORDS words of 64 bits.
BITS_EACH = 16
WORDS = 8
#: A filter of at most so many bytes is broadcast; a larger one is joined by block number.
BROADCAST_BYTES = 32_000_000


class Rule(NamedTuple):
    """``host`` and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def _split(url: Column) -> tuple[Column, Column, Column]:
    """Host with A-Z lowered, path, and query with its question mark. All are empty for null or without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty for null or without ``://``."""
    return _split(url)[0]


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return _split(url)[1]


def canonical(url: Column) -> Column:
    """Host without a leading ``www.``, path without slashes at its end, query without ``utm_`` parameters; no scheme,
    no fragment. Null for URLs without a host."""
    host, path, query = _split(url)
    kept = F.regexp_replace(F.regexp_replace(query, r"([?&])utm_[^&]*", "$1"), r"&+", "&")
    kept = F.regexp_replace(F.regexp_replace(kept, r"\?&", "?"), r"[?&]+$", "")
    whole = F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""), kept)
    return F.when(host != "", whole)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: len(rule.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """For each word of the block the one bit that the key sets."""
    hashed = F.xxhash64(key, F.lit("bits"))
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(hashed, 6 * word).bitwiseAND(F.lit(63)).cast("int")
        )
        for word in range(WORDS)
    ]


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows (block, w0 .. w7), one for each block in which any bit is set."""
    bits = [bit.alias(f"w{word}") for word, bit in enumerate(_bits(F.col(key)))]
    marked = listed.select(_block(F.col(key), blocks).alias("block"), *bits)
    return marked.groupBy("block").agg(*[F.bit_or(f"w{word}").alias(f"w{word}") for word in range(WORDS)])


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule],
    *,
    url: str = "url",
    keep: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Judges every row: adds ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``).

    The longest rule that fits decides; ``rule`` is its name, else null. Otherwise a URL is blocked if its canonical form
    is a ``key`` of ``listed``, and allowed if not, as are null and URLs without ``://``, which have an empty host and
    path. Input columns of the added names are replaced. Repeated or null keys in the list change nothing; an empty list
    blocks nothing.

    Rows that the rules decide or the filter turns away are not shuffled, unless the filter is too large to broadcast:
    then all rows with a key that no rule decides are, by block. The list is shuffled by its keys, so a hot URL meets a
    single row there, and adaptive execution may split its rows. The pages are read twice, once for the few that pass the
    filter; the list is worked out once.
    """
    added = {"host", "path", "rule", "verdict"}
    columns = [name for name in (pages.columns if keep is None else keep) if name.lower() not in added]
    keys = pin(listed.select(F.col("key").alias("__listed")).filter("__listed IS NOT NULL").distinct(), "listed")
    blocks = max(1, math.ceil(keys.count() * BITS_EACH / (64 * WORDS)))
    filled = bloom_filter(keys, "__listed", blocks)
    filled = filled.select(F.col("block").alias("__at"), *[F.col(f"w{word}").alias(f"__w{word}") for word in range(WORDS)])
    parts = pages.withColumn("__url", F.col(url)).select(*[F.col(f"`{name}`") for name in columns], "__url")
    parts = parts.withColumns({"__host": host_of(F.col("__url")), "__path": path_of(F.col("__url"))})
    name, verdict = longest_rule(F.col("__host"), F.col("__path"), rules)
    judged = parts.withColumns({"__rule": name, "__verdict": verdict})
    judged = judged.withColumn("__key", F.when(F.col("__verdict").isNull(), canonical(F.col("__url"))))
    same_block = _block(F.col("__key"), blocks) == F.col("__at")
    if blocks * 8 * (WORDS + 1) <= broadcast_bytes:
        tried = judged.join(F.broadcast(filled), same_block, "left")
    else:
        # Rows without a key would all meet in one task.
        tried = judged.filter("__key IS NOT NULL").join(filled, same_block, "left")
        tried = tried.unionByName(judged.filter("__key IS NULL"), allowMissingColumns=True)
    passed = F.col("__key").isNotNull()
    for word, bit in enumerate(_bits(F.col("__key"))):
        passed &= F.coalesce(F.col(f"__w{word}").bitwiseAND(bit) != 0, F.lit(False))
    blocked = F.when(F.col("__listed").isNotNull(), "block").otherwise("allow")
    found = tried.filter(passed).join(keys, F.col("__key") == F.col("__listed"), "left").withColumn("__verdict", blocked)
    clear = tried.filter(~passed).withColumn("__verdict", F.coalesce("__verdict", F.lit("allow")))
    whole = [F.col(f"`{name}`") for name in judged.columns]
    rows = clear.select(*whole).union(found.select(*whole))
    return rows.select(
        *[F.col(f"`{name}`") for name in columns],
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.col("__verdict").alias("verdict"),
    )

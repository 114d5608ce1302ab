"""Document fingerprints from closed syncmers, in built-in expressions.

The alphabet is that of pieces of words: lower-cased runs of up to ``LONGEST`` characters that end behind a character of
``_CUT`` (vowels, some digits and signs), at white space, or when they are full. Characters of scripts that are written
without spaces stand alone. So where a passage is cut depends on its own characters, also inside a long unspaced run, and
a text of a few words has several pieces. Of all runs of ``K`` pieces those are kept whose smallest piece (by hash,
``S`` = 1) is the first or the last. Whether a run is kept depends on its own pieces alone, so it is kept wherever it
occurs, and of any K - S neighbouring runs at least one is kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 3, 1
LONGEST = 4
#: Ideographs, kana, hangul, and the scripts from Thai to Burmese and Khmer.
_ALONE = r"\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{D7FF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
_CUT = r"aeiouy\x{E0}-\x{E6}\x{E8}-\x{EF}\x{F2}-\x{F6}\x{F8}-\x{FD}02468+/=_\-"
#: Latin consonants and the digits left. They are listed, not excluded, because that is faster to match.
_REST = r"bcdfghjklmnpqrstvwxz\x{DF}\x{E7}\x{F1}13579"
_PIECE = rf"[{_REST}]{{0,{LONGEST - 1}}}+[{_CUT}]|[{_REST}]{{1,{LONGEST}}}+|[{_ALONE}]|[^\s{_ALONE}{_REST}{_CUT}]{{1,{LONGEST}}}+"

#: Ranges of ids for each shuffle partition, so that ranges spread evenly.
RANGES_EACH = 4


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _piece_hashes(text: Column) -> Column:
    found = F.regexp_extract_all(folded(text), F.lit(_PIECE), F.lit(0))
    return F.transform(found, lambda piece: F.xxhash64(piece))


def _kept(hashes: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the place (from 1) and the 32-bit hash of each run that is kept."""

    def at_edge(first: Column, place: Column) -> Column:
        middle, last = F.get(hashes, place + F.lit(1)), F.get(hashes, place + F.lit(2))
        return F.when((first <= middle) | (last <= middle), use(place + 1, F.hash(first, middle, last)))

    whole = F.array(use(F.lit(1), F.hash(hashes)))
    kept = F.array_compact(F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - F.lit(K - 1), F.lit(0))), at_edge))
    return F.when(F.size(hashes) == 0, F.slice(whole, 1, 0)).when(F.size(hashes) < K, whole).otherwise(kept)


def anchors(text: Column) -> Column:
    """Closed syncmers of a text in order: an array of (place of the first piece, from 1; 32-bit hash). A text of fewer
    than ``K`` pieces has one run, of all it has; one without pieces has none. Null is empty."""
    with_place = lambda place, hashed: F.struct(place.cast("int").alias("place"), hashed.alias("hash"))
    return _let(_piece_hashes(text), lambda hashes: _kept(hashes, with_place))


def anchor_hashes(text: Column) -> Column:
    """The hashes of ``anchors`` alone."""
    return _let(_piece_hashes(text), lambda hashes: _kept(hashes, lambda _, hashed: hashed))


def fingerprint(marks: Column) -> Column:
    """Hashes of anchors in order, eight hexadecimal digits each."""
    digits = F.transform(marks, lambda mark: F.substring(F.hex(mark.cast("bigint") + F.lit(2**40)), -8, 8))
    return F.lower(F.array_join(digits, ""))


def likeness(marks: Column, others: Column) -> Column:
    """Jaccard similarity of the sets of anchors' hashes; 1 if neither has any."""
    common, all_of = F.size(F.array_intersect(marks, others)), F.size(F.array_union(marks, others))
    return F.when(all_of == 0, F.lit(1.0)).otherwise(common / all_of)


def folded(text: Column) -> Column:
    """Lower case, of each character by itself: a sigma does not depend on whether it ends a word. Null is empty."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u03a3"), F.lit("\u03c3")))


def _ranges(docs: DataFrame, ranges: int) -> tuple[list[int], int | None]:
    """Upper bounds of ranges of ids with about equally many rows, all of them ids that occur; and the largest id."""
    shares = [k / ranges for k in range(1, ranges)]
    found = docs.agg(
        F.max("doc_id").alias("largest"),
        F.percentile_approx("doc_id", shares or [0.5], max(10_000, 20 * ranges)).alias("bounds"),
    ).first()
    bounds = sorted({bound for bound in found["bounds"] or [] if bound != found["largest"]}) if ranges > 1 else []
    return bounds, found["largest"]


def _range_of(doc_id: Column, bounds: list[int], *, at: bool = False) -> Column:
    """Number of bounds below an id, or ``at`` it too; found in two steps, each over the square root of all bounds."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    # As arrays, each is one literal of the plan, however many bounds there are.
    heads, every = F.lit(np.array(bounds[::step], np.int64)), F.lit(np.array(bounds, np.int64))
    below = lambda values: F.size(F.filter(values, lambda bound: (bound <= doc_id) if at else (bound < doc_id)))
    coarse = below(heads)
    part = F.slice(every, (coarse - 1) * step + 1, F.lit(step))
    fine = F.when(coarse > 0, (coarse - 1) * step + below(part)).otherwise(0)
    return F.coalesce(fine, F.lit(0))


def fingerprint_documents(docs: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text is the text without its last floor(n / 2) code points, followed by the first as many (or all) of the
    next document's, in descending order of ``doc_id``; the first document follows the last. Rows of equal ids follow in
    the order of their texts' hashes, then texts; rows without an id come last. A null text is empty. A single document
    is its own next. Returns ``doc_id`` (whole numbers), ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. Other columns are not read.

    Ids are dealt to ranges of about equal size, each sorted by itself; the row that follows a range's last is sent to
    that range as well. Texts are shuffled once.
    """
    spark = docs.sparkSession
    if ranges is None:
        ranges = RANGES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, largest = _ranges(docs, ranges)
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = _range_of(F.col("doc_id"), bounds)
    stays = F.struct(own.alias("range"), F.lit(0).alias("guest"))
    # An upper bound is the first row of its range, and so the next of the last row of the range above.
    ahead = F.struct((own + 1).alias("range"), F.lit(1).alias("guest"))
    wraps = F.struct(F.lit(0).alias("range"), F.lit(2).alias("guest"))
    is_bound = _range_of(F.col("doc_id"), bounds, at=True) > own
    places = F.array(
        stays,
        F.when(is_bound, ahead),
        F.when(F.col("doc_id").eqNullSafe(F.lit(largest).cast("bigint")), wraps),
    )
    dealt = rows.select("doc_id", "text", F.inline(F.array_compact(places)))
    marked = dealt.repartition("range").withColumn("marks", anchor_hashes(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    paired = marked.withColumn("next", F.lead(F.struct("text", "marks")).over(order)).filter("guest = 0")
    size, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring(F.col("next.text"), F.lit(1), half))
    both = paired.withColumn("edited", edited).withColumn("edited_marks", anchor_hashes(F.col("edited")))
    return both.select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("marks")).alias("fingerprint"),
        fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next.marks")).alias("near_next"),
    )

"""Spelling variants: words of the corpus that differ by one character are grouped around the frequent ones.

Words are counted on all documents in built-in expressions. Of two words that differ by one character at least one half
agrees, so they meet among the words with the same first, or the same last, few characters; there a bidirectional
FM-index of those words finds them (see ``fmindex``). What leaves a task is one row for each word, with the number of its
near words and the most frequent, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.fmindex import near_words, numbered
from placemill.llm.sets import whole_groups
from placemill.llm.shipping import ship_package
from placemill.staging import pin

#: Code points that a word must have, and occurrences.
LENGTH, OCCURRENCES = 6, 5
#: A word is a variant of a near one that occurs at least so many times as often.
TIMES = 5
#: One of so many occurrences loses a character.
TYPO = 199
#: Words of one index at most, and about how many words a task searches at a time.
INDEXED, SEARCHED = 40_000, 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = OCCURRENCES) -> DataFrame:
    """Rows (word, n): runs of letters of at least ``LENGTH`` code points that occur at least ``least`` times.

    A run is as long as can be of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lowered. Where the CRC-32 of ``<doc_id>:<run>`` (a null
    id: empty) is divisible by ``TYPO``, the run loses the character at its remainder by the run's length. Null text has
    no words. Counts are combined before the shuffle, so a frequent word is no more work there than a rare one.
    """
    lowered = F.translate(F.col(text), _UPPER, _LOWER)
    found = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{LENGTH},}}"), F.lit(0))
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("__id")
    each = docs.select(name, F.explode(found).alias("run"))
    hashed = each.select("run", F.crc32(F.concat_ws(":", "__id", "run")).alias("h"))
    word = F.expr(
        f"CASE WHEN h % {TYPO} = 0 THEN concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))"
        " ELSE run END AS word"
    )
    counts = hashed.select(word).filter(F.length("word") >= LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each searched word with near words among the indexed ones: how many, and the most frequent."""
    for table in whole_groups(batches, "group", SEARCHED):
        column = {name: table.column(name).to_pylist() for name in ("word", "n", "ending", "indexed")}
        for ending in (False, True):
            rows = [k for k, side in enumerate(column["ending"]) if side == ending]
            counts = {column["word"][k]: column["n"][k] for k in rows if column["indexed"][k]}
            known, asked = sorted(counts), sorted({column["word"][k] for k in rows})
            if not known:
                continue
            alphabet = np.unique(np.frombuffer("".join(asked).encode("utf-32-le"), np.uint32))
            words, index = numbered(asked, alphabet), numbered(known, alphabet)
            first, second = (None, words) if ending else (words, None)
            ((by, found),) = near_words(index, len(alphabet) + 1, first, second)
            if not len(by):
                continue
            n = np.array([counts[word] for word in known])
            order = np.lexsort((np.arange(len(n)), -n))
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n))
            best = np.full(len(asked), len(n))
            np.minimum.at(best, by, rank[found])
            near = np.bincount(by, minlength=len(asked))
            some = np.flatnonzero(near)
            chosen = order[best[some]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([asked[k] for k in some], pa.string()),
                    pa.array(near[some], pa.int64()),
                    pa.array([known[k] for k in chosen], pa.string()),
                    pa.array(n[chosen], pa.int64()),
                ],
                names=["word", "n_near", "best", "best_n"],
            )


def near_counts(words: DataFrame, *, indexed: int = INDEXED) -> DataFrame:
    """For words (word, n) that are near others: ``n_near``, and the most frequent near word ``best`` with ``best_n``
    (of equally frequent ones the smallest).

    Near means different by exactly one inserted, deleted or replaced code point. Words have at least ``LENGTH`` code
    points, so either their first or their last LENGTH // 2 agree with those of a near word. Words with equal ones form a
    group; a group of more than ``indexed`` words has its words dealt to several indexes, each of which is searched for
    all of them. So no index grows beyond that, and every pair still meets.
    """
    ship_package(words.sparkSession)
    edge = LENGTH // 2
    sides = F.array(
        F.struct(F.lit(False).alias("ending"), F.substring("word", 1, edge).alias("edge")),
        F.struct(F.lit(True).alias("ending"), F.substring("word", -edge, edge).alias("edge")),
    )
    placed = words.select("word", "n", F.inline(sides))
    sizes = placed.groupBy("ending", "edge").agg(F.ceil(F.count(F.lit(1)) / indexed).cast("int").alias("parts"))
    dealt = placed.join(sizes, ["ending", "edge"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")) == F.col("part")
    searched = dealt.select("word", "n", "ending", own.alias("indexed"), F.xxhash64("ending", "edge", "part").alias("group"))
    found = searched.repartition("group").sortWithinPartitions("group", "word").mapInArrow(
        _search, "word string, n_near bigint, best string, best_n bigint"
    )
    least = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    both = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("top"))
    return both.select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.minus")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) of words that have a form: the last that is reached from form to form.

    Each round follows twice as many forms at once; as a form is ``TIMES`` as frequent, few rounds end it.
    """
    at = pin(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not at.filter("moved").isEmpty():
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = pin(
            at.select("word", "root")
            .join(ahead, "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
    return at.select("word", "root")


def spelling_variants(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = OCCURRENCES, times: int = TIMES, indexed: int = INDEXED
) -> DataFrame:
    """The words of :func:`word_counts`, each with the word that it is a variant of.

    Returns ``word``, ``form`` (its most frequent near word, the smallest of several, if that occurs at least ``times``
    times as often; else null), ``root`` (the last word that is reached from form to form; the word itself without a
    form), ``n``, ``n_near`` (near words; 0 if none) and ``form_n`` (occurrences of the form, else null). Texts without
    such words, and an empty table, give no rows. Other columns are not read.
    """
    words = pin(word_counts(docs, doc_id=doc_id, text=text, least=least), "words")
    is_form = F.col("best_n") >= F.col("n") * times
    judged = words.join(near_counts(words, indexed=indexed), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    judged = pin(judged, "forms")
    rooted = judged.join(_roots(judged.filter("form IS NOT NULL").select("word", "form")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

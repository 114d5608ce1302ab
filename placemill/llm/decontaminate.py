"""Benchmark decontamination by winnowing.

Of every run of ``WINDOW`` words the smallest hash of its runs of ``GRAM`` words is a fingerprint. Equal windows have
equal fingerprints, so every window that a document shares with a benchmark item shows as a shared fingerprint. Each
shared fingerprint is extended word by word along its diagonal; what reaches a whole window is a hit.

A benchmark of up to ``INDEX_BYTES`` is broadcast as an index that documents are searched with. Of a larger one only a
Bloom filter of bounded size is broadcast; fingerprints that pass it are joined by a shuffle and carry the words around
them, so that a hit is extended where it is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.shipping import ship_package
from placemill.llm.texts import Scorer, add_text_columns
from placemill.llm.words import Words, blocks, mix, words_of
from placemill.staging import pin

GRAM = 5
WINDOW = 13
#: Benchmark text that is indexed and broadcast as a whole. A larger benchmark is joined.
INDEX_BYTES = 16_000_000
#: The Bloom filter of a joined benchmark: bits for each of its entries, and bits at most (32 MB).
BLOOM_BITS, MOST_BLOOM_BITS = 16, 2**28

#: A window reaches at most this many words beyond each side of a fingerprint, and at least half of that on one side.
REACH = WINDOW - GRAM
#: Kinds of entries that are joined: fingerprints with the words before or behind them, or (1 to 12) whole short items.
BEFORE, BEHIND = WINDOW, WINDOW + 1

_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("__items", T.ArrayType(T.StringType())),
    ]
)
_ENTRY = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("hash", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("around", T.BinaryType()),
    ]
)
_ENTRIES = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("__entries", T.ArrayType(_ENTRY))])


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed runs of words: their hashes and the indexes of their first words."""
    hashes, first = words.grams(GRAM)
    if not len(hashes):
        return hashes, first
    # Runs of a text are neighbours in ``first``. A window has as many runs as ``span``; all must be of one text.
    span = WINDOW - GRAM + 1
    best, reach = np.arange(len(hashes)), 1
    while reach < span:
        step = min(reach, span - reach)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        reach += step
        if not len(best):
            return hashes[:0], first[:0]
    whole = first[span - 1 :] - first[: len(best)] == span - 1
    picked = np.zeros(len(hashes), bool)
    picked[best[whole]] = True
    return hashes[picked], first[picked]


def _word_at(words: Words, first: np.ndarray, step: int, outside: int) -> np.ndarray:
    """Hash of the word ``step`` behind each of ``first``; ``outside`` beyond their texts' ends."""
    place, text = first + step, words.text_of()[first]
    inside = (place >= words.bounds[text]) & (place < words.bounds[text + 1])
    return np.where(inside, words.hashes[np.where(inside, place, first)], np.uint64(outside))


class Index(NamedTuple):
    """A benchmark: words of its items, and where each fingerprint occurs, by hash."""

    names: list[str | None]
    words: Words
    item_of: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    #: Items of fewer words than a window: number of words -> (sorted hashes of the whole item, its number).
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, names: list[str | None], texts: list[str | None]) -> Index:
        data = pa.array(texts, pa.large_string())
        parts = [words_of(*part) for _, *part in blocks(data, limit=2**62)]
        words = parts[0] if parts else Words(np.zeros(0, np.uint64), np.zeros(1, np.int64))
        hashes, places = fingerprints(words)
        # Of places in an item that agree in all words a window can reach, one says as much as all.
        reached = words.text_of()[places].astype(np.uint64)
        for step in range(-REACH, WINDOW):
            reached = mix(reached + _word_at(words, places, step, outside=1))
        once = np.unique(reached, return_index=True)[1]
        hashes, places = hashes[once], places[once]
        order = np.argsort(hashes, kind="stable")
        short = {}
        for size in range(1, WINDOW):
            chosen = np.flatnonzero(words.counts == size)
            if len(chosen):
                whole, at = words.grams(size)
                whole = whole[np.searchsorted(at, words.bounds[chosen])]
                by_hash = np.argsort(whole, kind="stable")
                short[size] = whole[by_hash], chosen[by_hash]
        return cls(names, words, words.text_of(), hashes[order], places[order], short)


def _matches(wanted: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of indexes of equal values; ``known`` is sorted."""
    low = np.searchsorted(known, wanted, "left")
    some = np.flatnonzero(low < len(known))
    some = some[known[low[some]] == wanted[some]]
    low = low[some]
    count = np.searchsorted(known, wanted[some], "right") - low
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(some, count), np.repeat(low, count) + within


def shared_runs(words: Words, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of words that are windows of items: first word, word behind the last, and the item."""
    hashes, first = fingerprints(words)
    at, found = _matches(hashes, index.hashes)
    here, there = first[at], index.places[found]
    text = words.text_of()
    low = np.minimum(here - words.bounds[text[here]], there - index.words.bounds[index.item_of[there]])
    high = np.minimum(
        words.bounds[text[here] + 1] - here, index.words.bounds[index.item_of[there] + 1] - there
    )
    ends = []
    for step, room in ((-1, low), (1, high - 1)):
        # A window that holds the fingerprint reaches at most this far; longer spans show again in their other windows.
        length, going = np.zeros(len(here), np.int64), np.ones(len(here), bool)
        for k in range(1, WINDOW if step > 0 else WINDOW - GRAM + 1):
            going &= k <= room
            alive = np.flatnonzero(going)
            same = words.hashes[here[alive] + step * k] == index.words.hashes[there[alive] + step * k]
            going[alive[~same]] = False
            length[alive[same]] = k
        ends.append(length)
    starts, stops = here - ends[0], here + ends[1] + 1
    same = words.hashes[here] == index.words.hashes[there]
    whole = same & (stops - starts >= WINDOW)
    runs = [(starts[whole], stops[whole], index.item_of[there[whole]])]
    for size, (known, items) in index.short.items():
        hashes, first = words.grams(size)
        at, found = _matches(hashes, known)
        runs.append((first[at], first[at] + size, items[found]))
    return tuple(np.concatenate(parts) for parts in zip(*runs, strict=True))


def _union(starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` words lie in any run."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change[:-1]) > 0


def _search(index: Index) -> Scorer:
    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        words = words_of(data, offsets)
        starts, stops, items = shared_runs(words, index)
        hit = _union(starts, stops, len(words.hashes))
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[words.bounds[1:]] - total[words.bounds[:-1]]
        n_texts = len(offsets) - 1
        named: list[list[str]] = [[] for _ in range(n_texts)]
        text = words.text_of()
        pairs = np.unique(np.stack([text[starts], items]), axis=1) if len(starts) else np.zeros((2, 0), np.int64)
        for number, item in pairs.T:
            if index.names[item] is not None:
                named[number].append(index.names[item])
        return [
            pa.array(words.counts, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array(named, pa.list_(pa.string())),
        ]

    return score


class _Bloom(NamedTuple):
    """Two bits for each entry, in 64-bit words; their number is a power of two."""

    bits: np.ndarray

    def has(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        mixed = mix(hashes ^ np.uint64(kind))
        found = np.ones(len(hashes), bool)
        for half in (mixed & np.uint64(2**32 - 1), mixed >> np.uint64(32)):
            place = half & np.uint64(64 * len(self.bits) - 1)
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def _bloom_places(kinds: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    mixed = mix(hashes ^ kinds.astype(np.uint64))
    return np.concatenate([mixed & np.uint64(2**32 - 1), mixed >> np.uint64(32)]) & np.uint64(size - 1)


def _bloom(entries: DataFrame) -> _Bloom:
    """The filter of all entries; its words are combined before they are shuffled and are all the driver sees."""
    count = entries.count()
    size = 64
    while size < min(BLOOM_BITS * count, MOST_BLOOM_BITS):
        size *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, hashes = (np.asarray(column) for column in batch.columns)
            found = np.unique(_bloom_places(kinds, hashes.view(np.uint64), size)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["place"])

    found = entries.select("kind", "hash").mapInArrow(places, "place bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = found.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[np.asarray(words["word"])] = np.asarray(words["bits"]).view(np.uint64)
    return _Bloom(bits)


def _around(words: Words, first: np.ndarray, outside: int) -> pa.Array:
    """Hashes of the words that a window around each fingerprint can have, ``outside`` beyond the text's ends."""
    steps = [_word_at(words, first, step, outside) for step in range(-REACH, WINDOW)]
    hashes = np.stack(steps, axis=1).astype("<u8")
    offsets = np.arange(len(first) + 1, dtype=np.int32) * (8 * (REACH + WINDOW))
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(hashes.tobytes())])


def _entries(*, sizes: list[int] | None, bloom: Callable[[], _Bloom] | None = None) -> Scorer:
    """What each text is joined by. An item (``sizes`` None) gives itself if it is shorter than a window; a document all
    its runs of words of these sizes, and of all it has only what passes the filter."""
    known = bloom() if bloom else None
    outside = 1 if sizes is None else 0

    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        words = words_of(data, offsets)
        picked = []
        for size in range(1, WINDOW) if sizes is None else sizes:
            hashes, first = words.grams(size)
            if sizes is None:
                whole = words.counts[words.text_of()[first]] == size
                hashes, first = hashes[whole], first[whole]
            picked.append((size, hashes, first))
        _, prints = fingerprints(words)
        hashes, first = words.grams(GRAM + REACH // 2)
        wide, exists = np.zeros(len(words.hashes), np.uint64), np.zeros(len(words.hashes), bool)
        wide[first], exists[first] = hashes, True
        for kind, shift in ((BEFORE, REACH // 2), (BEHIND, 0)):
            fine = prints[prints >= shift]
            fine = fine[exists[fine - shift]]
            picked.append((kind, wide[fine - shift], fine))
        if known is not None:
            passed = [known.has(hashes, kind) for kind, hashes, _ in picked]
            picked = [(kind, hashes[some], at[some]) for (kind, hashes, at), some in zip(picked, passed, strict=True)]
        kinds = np.concatenate([np.full(len(at), kind, np.int32) for kind, _, at in picked])
        hashes = np.concatenate([hashes for _, hashes, _ in picked])
        first = np.concatenate([at for _, _, at in picked])
        text = words.text_of()[first]
        order = np.argsort(text, kind="stable")
        kinds, hashes, first, text = kinds[order], hashes[order], first[order], text[order]
        # Short items need no words around them.
        long = kinds >= WINDOW
        around = _around(words, first[long], outside).take(pa.array(np.cumsum(long) - 1, mask=~long))
        columns = [pa.array(kinds), pa.array(hashes.view(np.int64)), pa.array(first - words.bounds[text]), around]
        entries = pa.StructArray.from_arrays(columns, names=_ENTRY.names)
        starts = np.searchsorted(text, np.arange(len(offsets))).astype(np.int32)
        return [pa.array(words.counts, pa.int64()), pa.ListArray.from_arrays(pa.array(starts), entries)]

    return score


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, name, at, words around in the document, in the item) that reach a window: (text, name, start, stop)."""
    for batch in batches:
        here, there = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u8").reshape(-1, REACH + WINDOW) for k in (3, 4)
        )
        same = here == there
        before = np.cumprod(same[:, :REACH][:, ::-1], axis=1).sum(axis=1)
        behind = np.cumprod(same[:, REACH:], axis=1).sum(axis=1)
        hit = np.flatnonzero((behind >= GRAM) & (before + behind >= WINDOW))
        at = np.asarray(batch.column(2))[hit]
        rows = batch.take(pa.array(hit))
        runs = [pa.array(at - before[hit]), pa.array(at + behind[hit])]
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *runs], names=["text", "name", "start", "stop"])


def _joined(docs: DataFrame, items: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with n_words, n_hit and the ids of items (``__items``), by a join of fingerprints."""
    spark = docs.sparkSession
    made = add_text_columns(items, _ENTRIES, lambda: _entries(sizes=None), keep=["name"])
    known = pin(made.select("name", F.inline("__entries")).drop("at").distinct(), "benchmark")
    sizes = sorted(row["kind"] for row in known.filter(F.col("kind") < WINDOW).select("kind").distinct().collect())
    shared = spark.sparkContext.broadcast(_bloom(known))
    # What is found depends on a text alone, so equal texts are one.
    kept = F.struct(F.lit(0).alias("__one"), *[F.col(f"`{name}`") for name in columns])
    keyed = docs.select(kept.alias("__kept"), "__text", F.sha2("__text", 256).alias("__key"))
    search = lambda: _entries(sizes=sizes, bloom=lambda: shared.value)
    marked = pin(add_text_columns(keyed, _ENTRIES, search, text="__text", keep=["__kept", "__key"]), "marked")
    some = marked.filter(F.size("__entries") > 0)
    asked = some.select("__key", F.inline("__entries")).dropDuplicates(["__key", "kind", "hash", "at"])
    asked = asked.select(F.col("__key").alias("text"), "kind", "hash", "at", F.col("around").alias("here"))
    pairs = asked.join(known.withColumnRenamed("around", "there"), ["kind", "hash"])
    whole = pairs.filter(F.col("kind") < WINDOW)
    short = whole.select("text", "name", F.col("at").alias("start"), (F.col("at") + F.col("kind")).alias("stop"))
    long = pairs.filter(F.col("kind") >= WINDOW).select("text", "name", "at", "here", "there")
    hits = long.mapInArrow(_extended, "text string, name string, start bigint, stop bigint")
    runs = pin(hits.union(short).distinct(), "runs")
    places = runs.select("text", F.explode(F.sequence("start", F.col("stop") - 1)).alias("place")).distinct()
    sums = places.groupBy("text").agg(F.count(F.lit(1)).alias("n_hit"))
    names = runs.select("text", "name").distinct().groupBy("text").agg(F.collect_list("name").alias("__items"))
    found = sums.join(names, "text").withColumnRenamed("text", "__found")
    none = F.array().cast("array<string>")
    quoted = [F.col(f"__kept.`{name}`") for name in columns]
    judged = some.join(found, F.col("__key") == F.col("__found"), "left").select(
        *quoted, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("__items", none).alias("__items")
    )
    free = marked.filter(F.size("__entries") == 0)
    return judged.union(free.select(*quoted, "n_words", F.lit(0).cast("bigint").alias("n_hit"), none.alias("__items")))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    one_in: int = 20,
    index_bytes: int = INDEX_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Words of each document that lie in a window of a benchmark item.

    Adds ``n_words``, ``n_hit`` (words in any shared window), ``n_items`` (different ids of the items they come from),
    ``items_sha256`` (of those ids, sorted as strings and joined by commas) and ``contaminated`` (any hit, and at least
    one of ``one_in`` words). Input columns of these names are replaced. A window is ``WINDOW`` consecutive words of
    an item; an item of fewer words is one window; a null or wordless text has no words and no windows. Repeated items
    count once; an item without an id marks words but is not counted. With an empty benchmark nothing is hit.

    A benchmark of at most ``index_bytes`` of text is broadcast as an index; documents are then not shuffled, so common
    passages and hot sources cost nothing extra. Of a larger one the fingerprints are joined: those of documents that
    pass a Bloom filter of the benchmark's, by a hash of nine words, with the words around them. Only documents with such
    fingerprints move, equal texts once; the kept columns are written to the shared folder.
    """
    spark = docs.sparkSession
    ship_package(spark)
    columns = list(docs.columns if keep is None else keep)
    found = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated"}
    columns = [name for name in columns if name.lower() not in found]
    quoted = [F.col(f"`{name}`") for name in columns]
    texts = docs.withColumn("__text", F.coalesce(F.col(text), F.lit(""))).select(*quoted, "__text")
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.lit(100))).first()[0] or 0
    if size <= index_bytes:
        rows = items.collect()
        shared = spark.sparkContext.broadcast(Index.of([row["name"] for row in rows], [row["text"] for row in rows]))
        judged = add_text_columns(texts, _FOUND, lambda: _search(shared.value), text="__text", keep=columns)
    else:
        judged = _joined(texts, items, columns)
    ids = F.array_sort(F.array_distinct("__items"))
    out = judged.select(*quoted, "n_words", "n_hit", ids.alias("__ids"))
    share = F.col("n_hit") * one_in >= F.col("n_words")
    return out.select(
        *quoted,
        "n_words",
        "n_hit",
        F.size("__ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "__ids"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & share).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns as they are."""
    aliased = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__doc"), "text")
    judged = find_contamination(aliased, benchmark, keep=["__doc"], **options)
    return judged.filter(~F.col("contaminated")).select("__doc.*")

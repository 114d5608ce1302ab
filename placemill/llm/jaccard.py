"""N-gram Jaccard join: MinHash bands propose pairs, Bayesian pruning drops most, the rest are verified exactly.

A document stands for its set of five-word shingles. Documents with the same words are one node. Pairs of nodes are
compared inside buckets (equal band of the signature), a bounded block of members against another, so that no task holds
a large bucket. Pairs are never written: pruning returns the members of a block that are in any pair that survives, one
row for each; verification prunes them once more, compares the sets of what survives, and returns one row for each member,
with the number of its links and the least member it is connected with. As links are counted, n different near copies
still take n(n-1)/2 comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.sets import Classes, least_matches, minima, pairs_in, runs, sequence_keys, shared, shingles, whole_groups
from placemill.llm.shipping import ship_package
from placemill.llm.texts import Scorer, add_text_columns
from placemill.llm.words import mix, words_of
from placemill.staging import pin

SHINGLE = 5
THRESHOLD = 0.8
#: A pair of exactly 0.8 shares no band with probability (1 - 0.8 ** ROWS) ** BANDS = 3e-6.
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: Hashes that are compared before a pair's posterior is looked at again.
STEP = 16
#: A pair is dropped when the posterior probability that it reaches the threshold falls below this.
TOLERANCE = 1e-6
#: Members of a bucket that are compared with each other by one task at a time.
BLOCK = 512
#: Pairs of members that a task holds at a time.
PAIRS = 500_000

_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))

_SIGNED = T.StructType(
    [
        T.StructField("__key", T.BinaryType()),
        T.StructField("__size", T.LongType()),
        T.StructField("__signature", T.BinaryType()),
    ]
)
_SET = T.StructType([T.StructField("__key", T.BinaryType()), T.StructField("__set", T.BinaryType())])


def _keys(words, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Those of ``sequence_keys``; texts without words have keys that agree for equal texts."""
    found = sequence_keys(words)
    return [key or b"-" + data[offsets[k] : offsets[k + 1]].tobytes() for k, key in enumerate(found)]


def _sign() -> Scorer:
    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        words = words_of(data, offsets)
        hashes, bounds = shingles(words, SHINGLE)
        sizes = np.diff(bounds)
        rows = iter(minima(hashes, bounds, _SEEDS))
        signatures = [next(rows).tobytes() if size else None for size in sizes]
        keys = pa.array(_keys(words, data, offsets), pa.binary())
        return [keys, pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())]

    return score


def _sets() -> Scorer:
    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        words = words_of(data, offsets)
        hashes, bounds = shingles(words, SHINGLE)
        sets = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return [pa.array(_keys(words, data, offsets), pa.binary()), pa.array(sets, pa.binary())]

    return score


def _bands(signature: Column) -> Column:
    """The bands of a signature as an array of (band, its 64-bit hash)."""
    width = 4 * ROWS
    cut = [F.xxhash64(F.substring(signature, band * width + 1, width)) for band in range(BANDS)]
    return F.array(*[F.struct(F.lit(band).alias("band"), hashed.alias("bucket")) for band, hashed in enumerate(cut)])


def _blocks_of(buckets: DataFrame, block: int) -> DataFrame:
    """Members of each bucket dealt to pairs of blocks: rows (group, side, within, band, __key)."""
    sizes = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    dealt = buckets.join(sizes, ["band", "bucket"]).withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("__key"), F.col("blocks")).cast("int")
    # A member meets its own block once, and every other block as one of two sides.
    low, high = F.least("own", "other"), F.greatest("own", "other")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        dealt.withColumn("own", own)
        .withColumn("other", others)
        .select(
            F.xxhash64("band", "bucket", low, high).alias("group"),
            (F.col("own") > F.col("other")).alias("side"),
            (F.col("own") == F.col("other")).alias("within"),
            "band",
            "__key",
        )
    )


_MEMBERS = "group bigint, side boolean, within boolean, band int, __key binary, __signature binary"


def _survivors(table: pa.Table, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of each group that pruning keeps; a pair belongs to the first of the buckets that it shares."""
    signatures = np.frombuffer(b"".join(table.column("__signature").to_pylist()), np.uint32).reshape(-1, HASHES)
    band = table.column("band").to_numpy()
    side = table.column("side").combine_chunks().to_numpy(zero_copy_only=False)
    within = table.column("within").combine_chunks().to_numpy(zero_copy_only=False)
    for left, right in pairs_in(*runs(table.column("group").to_numpy()), side, within, PAIRS):
        matches = np.zeros(len(left), np.int64)
        for first in range(0, HASHES, STEP):
            same = signatures[left, first : first + STEP] == signatures[right, first : first + STEP]
            matches += same.sum(1)
            bands = same.reshape(len(left), STEP // ROWS, ROWS).all(2)
            earlier = np.arange(first // ROWS, (first + STEP) // ROWS)[None, :] < band[left][:, None]
            kept = (matches >= least[first + STEP]) & ~(bands & earlier).any(1)
            left, right, matches = left[kept], right[kept], matches[kept]
        yield left, right


def _prune(threshold: float, tolerance: float):
    """The members of each group that are in any pair that survives."""
    least = least_matches(threshold, tolerance, HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "group", 4096):
            chosen = np.zeros(table.num_rows, bool)
            for left, right in _survivors(table, least):
                chosen[left] = chosen[right] = True
            yield from table.filter(pa.array(chosen)).to_batches()

    return run


_LINKS = "__key binary, root binary, links bigint"


def _verify(threshold: float, tolerance: float):
    """Exact similarity of the surviving pairs of each group; for each member its links and the least key it is linked
    with."""
    least = least_matches(threshold, tolerance, HASHES)

    def similar(a: np.ndarray, b: np.ndarray) -> bool:
        if min(len(a), len(b)) < threshold * max(len(a), len(b)) - 1:
            return False
        both = shared(a, b)
        return both / (len(a) + len(b) - both) >= threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "group", 256):
            # Within a group rows are in the order of their keys, so the least number is the least key.
            keys = table.column("__key").to_pylist()
            copies = table.column("copies").to_pylist()
            sets = [np.frombuffer(raw, np.uint64) for raw in table.column("__set").to_pylist()]
            links = [0] * len(keys)
            classes = Classes(len(keys))
            for left, right in _survivors(table, least):
                for a, b in zip(left.tolist(), right.tolist(), strict=True):
                    if similar(sets[a], sets[b]):
                        links[a] += copies[b]
                        links[b] += copies[a]
                        classes.join(a, b)
            linked = [k for k in range(len(keys)) if links[k]]
            columns = [
                pa.array([keys[k] for k in linked], pa.binary()),
                pa.array([keys[classes.root(k)] for k in linked], pa.binary()),
                pa.array([links[k] for k in linked], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["__key", "root", "links"])

    return run


def components(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Rows (node, label): the least node that each node of the edges is connected with.

    Each round gives every node the least label among its neighbours, then the label of its label, which shortens paths
    at least by half; labels are written to the shared folder between rounds.
    """
    ways = edges.select(F.col(node).alias("node"), F.col(other).alias("next")).filter("node != next")
    ways = pin(ways.unionByName(ways.select(F.col("next").alias("node"), F.col("node").alias("next"))).distinct(), "edges")
    nearest = ways.groupBy("node").agg(F.min("next").alias("least"))
    labels = pin(nearest.select("node", F.least("node", "least").alias("label"), F.lit(True).alias("changed")), "labels")
    while not labels.filter("changed").isEmpty():
        told = ways.join(labels.select("node", "label"), "node").groupBy(F.col("next").alias("node"))
        offers = told.agg(F.min("label").alias("offer"))
        lower = labels.join(offers, "node").select("node", "label", F.least("label", "offer").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("further"))
        labels = pin(
            lower.join(jump, "lower", "left")
            .withColumn("lowest", F.coalesce(F.least("lower", "further"), "lower"))
            .select("node", F.col("lowest").alias("label"), (F.col("lowest") != F.col("label")).alias("changed")),
            "labels",
        )
    return labels.select("node", "label")


def similar_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Classes of documents that are linked, directly or through others, by a Jaccard similarity of ``threshold``.

    Returns for each row of ``docs``: its ``doc_id``, ``text_hash`` (xxhash64 of the text, which tells rows with the same
    id apart), ``class_key`` (which tells classes apart even if ids repeat), ``class_id`` (the least doc_id of its class;
    null if all are null), ``n_links`` (other rows with at least the threshold of similarity, copies included) and
    ``n_shingles``. Similarity is that of the sets of five-word
    shingles; a text of one to four words has all of them as its only shingle. Texts without words are linked with equal
    texts alone (null is empty). Other columns of ``docs`` are not read.

    Large groups: rows with equal words are one node from the first shuffle on; a bucket of more than ``block`` nodes is
    compared block by block in several tasks. Only nodes that share a bucket move their signature, and only members of a
    pair that pruning kept move their shingles.
    """
    ship_package(docs.sparkSession)
    ids = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("__text")
    )
    signed = pin(add_text_columns(ids, _SIGNED, _sign, text="__text", keep=["doc_id", "text_hash"]), "signatures")
    nodes = signed.groupBy("__key").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct("doc_id", "text_hash")).alias("first"),
        F.count(F.lit(1)).alias("copies"),
        F.first("__signature").alias("__signature"),
    )
    nodes = pin(nodes, "nodes")
    buckets = nodes.filter("__signature IS NOT NULL").select("__key", F.inline(_bands(F.col("__signature"))))
    members = _blocks_of(buckets, block).join(nodes.select("__key", "__signature"), "__key")
    members = members.select("group", "side", "within", "band", "__key", "__signature")
    proposed = members.repartition("group").sortWithinPartitions("group", "__key")
    kept = pin(proposed.mapInArrow(_prune(threshold, tolerance), _MEMBERS), "members")

    wanted = nodes.join(kept.select("__key").distinct(), "__key").select("__key", "first")
    first = ids["doc_id"].eqNullSafe(wanted["first.doc_id"]) & (ids["text_hash"] == wanted["first.text_hash"])
    own = ids.join(wanted, first).select(F.col("__key").alias("__wanted"), "__text")
    sets = add_text_columns(own, _SET, _sets, text="__text", keep=["__wanted"])
    sets = sets.filter("__key = __wanted").groupBy("__key").agg(F.first("__set").alias("__set"))
    verified = (
        kept.join(sets, "__key")
        .join(nodes.select("__key", "copies"), "__key")
        .repartition("group")
        .sortWithinPartitions("group", "__key")
        .mapInArrow(_verify(threshold, tolerance), _LINKS)
    )
    links = pin(verified, "links")
    degrees = links.groupBy("__key").agg(F.sum("links").alias("links"))
    label = components(links, "__key", "root").withColumnRenamed("node", "__key")
    classed = nodes.join(label, "__key", "left").join(degrees, "__key", "left")
    classed = classed.select("__key", "first_id", "copies", "links", F.coalesce("label", "__key").alias("label"))
    least = classed.groupBy("label").agg(F.min("first_id").alias("class_id"))
    found = classed.join(least, "label").select(
        "__key", F.col("label").alias("class_key"), "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return signed.join(found, "__key").select(
        "doc_id", "text_hash", "class_key", "class_id", "n_links", F.col("__size").alias("n_shingles")
    )


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The row of the least doc_id of each class, with all columns as they are; a class without ids keeps a row too.

    Rows of the same id are told apart by their text; of rows that agree in both, one stays.
    """
    classes = similar_documents(docs, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash"))
    chosen = classes.groupBy("class_key").agg(first.alias("__kept"))
    chosen = chosen.select(F.col("__kept.doc_id").alias("__kept_id"), F.col("__kept.text_hash").alias("__kept_hash"))
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__row")
    rows = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"), row)
    same = F.col("__id").eqNullSafe(F.col("__kept_id")) & (F.col("__hash") == F.col("__kept_hash"))
    # Of rows that agree in both the one whose columns have the least hash stays, so that a task run again keeps it too.
    plain = [field.name for field in docs.schema if "map" not in field.dataType.simpleString()]
    rows = rows.withColumn("__rank", F.xxhash64(*[F.col(f"__row.`{name}`") for name in plain]))
    left = rows.join(chosen, same).groupBy("__id", "__hash").agg(F.min_by("__row", "__rank").alias("__row"))
    return left.select("__row.*")

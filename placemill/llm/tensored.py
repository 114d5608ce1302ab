"""MinHash near-duplicates by tensored banding.

Two small collections of half-keys are computed for each text, ``COLLECTION`` of ``PICK`` MinHashes each. Every pair of a
half-key of one collection and one of the other is the key of a table, so COLLECTION ** 2 tables of 2 * PICK hashes come
from 2 * COLLECTION * PICK hashes, about the square root of what as many independent tables would take. Rows are
shuffled by the first collection's half-keys alone, COLLECTION for each text, and carry the other's; the second half of
a table's key is compared where they meet.

Candidates are verified in two phases, so that a group of near copies costs about its size: first every text against one
leader that it shares most half-keys with; then, where texts of different classes still meet in a table, block against
block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.jaccard import components
from placemill.llm.sets import Classes, least_matches, minima, pairs_in, runs, sequence_keys, shared, shingles, whole_groups
from placemill.llm.shipping import ship_package
from placemill.llm.texts import Scorer, add_text_columns
from placemill.llm.words import UNSPACED, blocks, mix, words_of
from placemill.staging import pin

SHINGLE = 3
#: Texts are linked if 100 * intersection >= SHARE * union.
SHARE = 85
#: A pair of exactly 0.85 shares no table with a probability of 2 * (1 - 0.85 ** PICK) ** COLLECTION = 3e-6.
PICK, COLLECTION = 3, 14
HASHES = 2 * PICK * COLLECTION
#: A pair is verified unless the posterior probability that it is linked, from all its MinHashes, falls below this.
TOLERANCE = 1e-6
#: Texts that are compared with each other by one task at a time.
BLOCK = 256
#: Pairs that a task holds at a time.
PAIRS = 200_000

_SEEDS = mix(np.arange(10_001, 10_001 + 2 * HASHES, dtype=np.uint64))
_SIGNED = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("signature", T.BinaryType()),
    ]
)


def _sign() -> Scorer:
    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        words = words_of(data, offsets, UNSPACED)
        hashes, bounds = shingles(words, SHINGLE)
        sizes = np.diff(bounds)
        rows = iter(minima(hashes, bounds, _SEEDS))
        signatures = [next(rows).tobytes() if size else None for size in sizes]
        return [pa.array(sequence_keys(words), pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())]

    return score


def _half_keys(collection: int) -> Column:
    """The half-keys of a collection as an array of (half, hash of its PICK MinHashes)."""
    width = 4 * PICK
    cut = [F.substring("signature", (collection * COLLECTION + k) * width + 1, width) for k in range(COLLECTION)]
    return F.array(*[F.struct(F.lit(k).alias("half"), F.xxhash64(part).alias("bucket")) for k, part in enumerate(cut)])


def _met(nodes: DataFrame, collection: int) -> DataFrame:
    """Half-keys that several nodes have: rows (key, half, bucket, leader), the leader being the least of these nodes."""
    halves = nodes.select("key", F.inline(_half_keys(collection)))
    buckets = halves.groupBy("half", "bucket").agg(F.min("key").alias("leader"), F.max("key").alias("__last"))
    return halves.join(buckets.filter("leader != __last").drop("__last"), ["half", "bucket"])


def _signatures(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (key, leader) whose MinHashes do not rule a link out."""
    least = least_matches(SHARE / 100, TOLERANCE, HASHES)[HASHES]
    for batch in batches:
        if batch.num_rows:
            same = _signatures(batch.column("signature")) == _signatures(batch.column("other"))
            yield batch.select(["key", "leader"]).filter(pa.array(same.sum(1) >= least))


def _set_of(text: str) -> np.ndarray:
    (_, data, offsets), *_ = blocks(pa.array([text], pa.large_string()))
    return shingles(words_of(data, offsets, UNSPACED), SHINGLE)[0]


def _linked(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    if 100 * min(len(a), len(b)) < share * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return 100 * both >= share * (len(a) + len(b) - both)


def _verify_leaders(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, held = None, None
        for batch in batches:
            kept = []
            # Rows of a leader mostly follow one another.
            for name, text, other in zip(*(batch.column(k).to_pylist() for k in ("leader", "text", "leader_text")), strict=True):
                if name != leader:
                    leader, held = name, _set_of(other)
                kept.append(_linked(_set_of(text), held, share))
            if kept:
                yield batch.select(["key", "leader"]).filter(pa.array(kept, pa.bool_()))

    return run


def _blocks(met: DataFrame, block: int) -> DataFrame:
    """Members of half-keys at which several classes meet, dealt to pairs of blocks.

    The largest class of a half-key has blocks of its own, which are not compared with each other; all others share the
    rest. So a class of near copies moves once for each block of others it meets, however large it is.
    """
    counts = met.groupBy("half", "bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("half", "bucket").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("labels")
    )
    sizes = sizes.filter("labels > 1").select(
        "half",
        "bucket",
        F.col("top.label").alias("top_label"),
        F.ceil(F.col("top.n") / block).cast("int").alias("tops"),
        F.ceil((F.col("members") - F.col("top.n")) / block).cast("int").alias("rests"),
    )
    dealt = met.join(sizes, ["half", "bucket"]).withColumn("is_top", F.col("label") == F.col("top_label"))
    own = F.when(F.col("is_top"), F.pmod(F.xxhash64("key"), F.col("tops"))).otherwise(
        F.col("tops") + F.pmod(F.xxhash64("key"), F.col("rests"))
    )
    first = F.when(F.col("is_top"), F.col("tops")).otherwise(0)
    others = F.explode(F.sequence(first, F.col("tops") + F.col("rests") - 1))
    placed = dealt.withColumn("own", own.cast("int")).withColumn("other", others)
    return placed.select(
        F.xxhash64("half", "bucket", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
        (F.col("own") > F.col("other")).alias("side"),
        (F.col("own") == F.col("other")).alias("within"),
        "half",
        "key",
        "label",
    )


def _survivors(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of different classes that share a table, first of all at this half-key, and are likely linked."""
    least = least_matches(SHARE / 100, TOLERANCE, HASHES)[HASHES]
    signatures = _signatures(table.column("signature"))
    half = table.column("half").to_numpy()
    side = table.column("side").combine_chunks().to_numpy(zero_copy_only=False)
    within = table.column("within").combine_chunks().to_numpy(zero_copy_only=False)
    _, label = np.unique(np.array(table.column("label").to_pylist(), dtype=object), return_inverse=True)
    earlier = np.arange(COLLECTION)[None, :]
    for left, right in pairs_in(*runs(table.column("group").to_numpy()), side, within, PAIRS):
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
        same = signatures[left] == signatures[right]
        halves = same.reshape(len(left), 2, COLLECTION, PICK).all(3)
        kept = (same.sum(1) >= least) & halves[:, 1].any(1) & ~(halves[:, 0] & (earlier < half[left][:, None])).any(1)
        yield left[kept], right[kept]


_MEMBERS = "group bigint, side boolean, within boolean, half int, key binary, label binary, signature binary"


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each group that are in any pair to verify: a row for each, not for each pair."""
    for table in whole_groups(batches, "group", 4096):
        chosen = np.zeros(table.num_rows, bool)
        for left, right in _survivors(table):
            chosen[left] = chosen[right] = True
        yield from table.filter(pa.array(chosen)).to_batches()


def _verify_blocks(share: int):
    """Edges between classes that are linked in a group: enough to connect them, not one for each linked pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "group", 256):
            texts = table.column("text").to_pylist()
            names = table.column("label").to_pylist()
            number: dict[bytes, int] = {}
            label = [number.setdefault(name, len(number)) for name in names]
            known = list(number)
            classes = Classes(len(known))
            sets: dict[int, np.ndarray] = {}
            found = []
            for left, right in _survivors(table):
                for a, b in zip(left.tolist(), right.tolist(), strict=True):
                    if classes.root(label[a]) == classes.root(label[b]):
                        continue
                    for k in (a, b):
                        if k not in sets:
                            sets[k] = _set_of(texts[k])
                    if _linked(sets[a], sets[b], share):
                        classes.join(label[a], label[b])
                        found.append((known[label[a]], known[label[b]]))
            if found:
                one, two = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.binary()), pa.array(two, pa.binary())], names=["one", "two"])

    return run


def _texts_of(ids: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (key, text) of the wanted nodes, rows (key, digest). Of equal texts one leaves each task."""
    one = Window.partitionBy("digest").orderBy("digest")
    different = ids.filter("digest IS NOT NULL").withColumn("rank", F.row_number().over(one)).filter("rank = 1").select("digest", "text")
    return different.join(wanted, "digest").select("key", "text")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, block: int = BLOCK
) -> DataFrame:
    """Classes of texts that are linked, directly or through others, by 100 * intersection >= ``share`` * union of their
    sets of three-word shingles.

    Words are runs without ASCII white space, A-Z lowered; a text of one or two words has them as its only shingle.
    Returns for each row of ``docs`` its ``doc_id``, ``n_shingles``, ``component_id`` (the least doc_id of its class; null
    if all are null) and ``kept`` (whether that is its own; rows without an id are kept if their class has none). A text
    without words has no shingles and is linked with nothing, not even its like. ``share`` must be ``SHARE`` or more, for
    which the tables are made. Other columns are not read; rows of equal ids each have a result.

    Texts of equal words are one node from the first shuffle on. Pairs are never written: the first phase writes one
    leader for each node; the second one row for each member of a block that has anything to verify.
    """
    if share < SHARE:
        raise ValueError(f"the tables are made for shares of at least {SHARE}")
    ship_package(docs.sparkSession)
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    digest = F.unhex(F.md5("text"))
    signed = ids.select("doc_id", "text", digest.alias("digest"))
    signed = pin(add_text_columns(signed, _SIGNED, _sign, keep=["doc_id", "digest"]), "signatures")
    nodes = signed.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.min("digest").alias("digest"), F.min("signature").alias("signature")
    )
    nodes = pin(nodes, "nodes")

    # First phase: each node and the leader it shares most half-keys with.
    met = pin(_met(nodes, 0), "half-keys")
    votes = met.filter("key != leader").groupBy("key", "leader").agg(F.count(F.lit(1)).alias("n"))
    led = votes.groupBy("key").agg(F.max(F.struct("n", "leader"))["leader"].alias("leader"))
    signature = nodes.select("key", "signature")
    others = signature.select(F.col("key").alias("leader"), F.col("signature").alias("other"))
    likely = led.join(signature, "key").join(others, "leader").select("key", "leader", "signature", "other")
    likely = pin(likely.mapInArrow(_likely, "key binary, leader binary"), "leaders")
    # Only nodes that share half-keys of both collections can share a table.
    wanted = met.select("key").distinct().join(_met(nodes, 1).select("key").distinct(), "key")
    texts = pin(_texts_of(ids.withColumn("digest", digest), nodes.select("key", "digest").join(wanted, "key")), "texts")
    leaders = texts.select(F.col("key").alias("leader"), F.col("text").alias("leader_text"))
    pairs = likely.join(texts, "key").join(leaders, "leader").select("key", "leader", "text", "leader_text")
    links = pin(pairs.mapInArrow(_verify_leaders(share), "key binary, leader binary"), "links")
    first = components(links, "key", "leader")

    # Second phase: what meets in a table and is not yet in one class.
    labelled = met.select("key", "half", "bucket").join(first.withColumnRenamed("node", "key"), "key", "left")
    labelled = pin(labelled.withColumn("label", F.coalesce("label", "key")), "labelled")
    members = _blocks(labelled, block).join(signature, "key").select("group", "side", "within", "half", "key", "label", "signature")
    proposed = members.repartition("group").sortWithinPartitions("group", "key")
    kept = pin(proposed.mapInArrow(_prune, _MEMBERS), "members")
    judged = kept.join(texts, "key").repartition("group").sortWithinPartitions("group", "key")
    edges = pin(judged.mapInArrow(_verify_blocks(share), "one binary, two binary"), "edges")
    second = components(edges, "one", "two").select(F.col("node").alias("label"), F.col("label").alias("final"))

    classed = nodes.select("key", "first_id").join(first.withColumnRenamed("node", "key"), "key", "left")
    classed = classed.withColumn("label", F.coalesce("label", "key")).join(second, "label", "left")
    classed = classed.select("key", "first_id", F.coalesce("final", "label").alias("label"))
    least = classed.groupBy("label").agg(F.min("first_id").alias("component_id"))
    found = classed.join(least, "label").select("key", "component_id")
    worded = signed.filter("key IS NOT NULL").join(found, "key").select("doc_id", "n_shingles", "component_id")
    wordless = signed.filter("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept_too = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return worded.unionByName(wordless).withColumn("kept", kept_too)

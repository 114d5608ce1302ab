"""Prefix trie of conversations by ROLLUP over positional columns.

Turns lie in columns by position, each holding the turn's id. GROUP BY ROLLUP over them aggregates every prefix at once,
and ``grouping_id`` tells how deep a row's prefix is. Long conversations go on in further blocks of columns, whose rows
are keyed by the node at which the block before ended. Going back from the last block to the first, a second ROLLUP
over the nodes sums up subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm.shipping import ship_package
from placemill.staging import pin, scratch_path

#: Positions of the first block, and of each block of longer conversations.
FIRST_BLOCK, NEXT_BLOCK = 8, 16
#: Conversations whose ids agree but for the remainder by this are joined into one text before a node's digest is made.
IDS_EACH = 65_536
#: Conversations of a family share their first one's start.
FAMILY, HEAD = 100, 6


def turn_id(role: Column, text: Column) -> Column:
    """20 bytes: an MD5 digest of role and text, and the text's length in code points."""
    size = F.length(text)
    whole = F.concat_ws(":", F.length(role).cast("string"), role, text)
    return F.concat(F.unhex(F.md5(whole)), F.unhex(F.lpad(F.hex(size.cast("bigint")), 8, "0")))


def turn_length(turn: Column) -> Column:
    """Code points of the text of a turn, from its id."""
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("bigint")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, place, turn): turns from place 0 in the order of ``turn`` (null first), of equal ones in that of
    their ids. Null role or text is empty. Rows without a conv_id belong to no conversation and are left out."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("__at"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("__role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"),
    )
    short = rows.select("conv_id", "__at", turn_id(F.col("__role"), F.col("__text")).alias("turn"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("__at"), "turn")
    return short.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "turn")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the start of their family's first one: rows (conv_id, place, turn); and their lengths.

    A conversation c takes the first h turns of conversation c - c % 100, with h = crc32(c) % 6, and then its own after
    its first h. Lengths (conv_id, length) have a row for every conversation, without turns too.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    head = F.crc32(F.col("conv_id").cast("string")) % HEAD
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.select("conv_id", "own", base.alias("base"), head.cast("int").alias("head"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    known = sizes.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    known = pin(known.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "families")
    own = turns.join(known.select("conv_id", "head", "taken"), "conv_id").filter("place >= head")
    own = own.select("conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "turn")
    starts = turns.filter(F.col("place") < HEAD - 1).withColumnRenamed("conv_id", "base")
    heads = known.filter("taken > 0").select("conv_id", "base", "taken").join(starts, "base").filter("place < taken")
    lengths = known.select("conv_id", F.col("length").cast("bigint").alias("length"))
    return own.unionByName(heads.select("conv_id", "place", "turn")), lengths


def _columns(width: int) -> list[str]:
    return [f"t{k}" for k in range(width)]


def _blocks_of(turns: DataFrame, first: int, further: int) -> DataFrame:
    """The turns with the block they lie in and their column there, stored by block: each round reads its own alone."""
    later = F.col("place") - first
    block = F.when(later < 0, 0).otherwise(F.floor(later / further) + 1).cast("int")
    cell = F.when(later < 0, F.col("place")).otherwise(later % further).cast("int")
    path = scratch_path(turns.sparkSession, "turns")
    cut = turns.select("conv_id", cell.alias("cell"), "turn", block.alias("block"))
    cut.hint("rebalance", "block").write.partitionBy("block").parquet(path)
    return turns.sparkSession.read.schema(cut.schema).parquet(path)


def _stored(frame: DataFrame, root: str, block: int) -> DataFrame:
    """The rows of a block, written below ``root``; all blocks are later read as one table."""
    frame.write.parquet(f"{root}/block={block}")
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{root}/block={block}")


def _wide(cut: DataFrame, block: int, width: int) -> DataFrame:
    """Rows (conv_id, t0 ..): the turns of a block by position, null behind the last."""
    cells = [F.expr(f"max(CASE WHEN cell = {k} THEN turn END) AS t{k}") for k in range(width)]
    return cut.filter(F.col("block") == block).groupBy("conv_id").agg(*cells)


def _prefixes(rows: DataFrame, width: int, measures: list[Column]) -> DataFrame:
    """ROLLUP over the columns below each ``prior``: a row for each prefix, with its ``level`` (0: none of the columns)
    and the ``last`` turn of it.

    Rows behind the end of a conversation, where the prefix's last column is null without being rolled up, are left out.
    """
    rolled = rows.rollup("prior", *_columns(width)).agg(F.expr("grouping_id() AS __mask"), *measures)
    # The mask has a bit for each column that is rolled up: 0 with all columns, 2**k - 1 with the last k rolled up.
    inside = rolled.filter(f"__mask < {2**width}").withColumn("level", F.expr(f"{width} - bit_count(__mask)"))
    cases = " ".join(f"WHEN {k + 1} THEN t{k}" for k in range(width))
    return inside.withColumn("last", F.expr(f"CASE level WHEN 0 THEN X'' {cases} END")).filter("last IS NOT NULL").drop("__mask")


def _key(block: int, depth: str, width: int) -> str:
    """A node's key from its block, the node the block continues, and the path from there, as a SQL expression."""
    path = ", ".join(f"CASE WHEN {depth} > {k} THEN hex(t{k}) END" for k in range(width))
    return f"unhex(md5(concat_ws('/', '{block}', CAST(prior AS STRING), CAST({depth} AS STRING), {path})))"


def _ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the joined ids of each node's conversations that end there, from rows (depth, node, conv_id).

    Ids are joined in bounded parts first; a node's parts then pass through one digest in order, a part at a time, so
    that memory does not depend on how many conversations end at a node.
    """
    parts = (
        ends.groupBy("depth", "node", F.floor(F.col("conv_id") / IDS_EACH).alias("part"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda k: k.cast("string")), ",").alias("ids"))
        .repartition("depth", "node")
        .sortWithinPartitions("depth", "node", "part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        done: list[tuple[int, int, str]] = []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("depth", "node", "ids")]
            for depth, node, ids in zip(*columns, strict=True):
                if (depth, node) == at:
                    digest.update(b",")
                else:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (depth, node), hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield _digests(done)
                done = []
        if at is not None:
            yield _digests([(*at, digest.hexdigest())])

    return parts.mapInArrow(run, "depth bigint, node bigint, ends_sha256 string")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    depth, node, digest = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(depth, pa.int64()), pa.array(node, pa.int64()), pa.array(digest, pa.string())],
        names=["depth", "node", "ends_sha256"],
    )


def prefix_trie(
    turns: DataFrame, lengths: DataFrame, *, first_block: int = FIRST_BLOCK, next_block: int = NEXT_BLOCK
) -> DataFrame:
    """The trie of all conversations: a row for each different sequence of first turns.

    ``turns`` has rows (conv_id, place, turn) with a 20-byte :func:`turn_id`, places from 0 without gaps; ``lengths``
    (conv_id, length) a row for every conversation, once; both are bigint. Returns ``conv_id`` (the least conversation that starts so),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (nodes without children
    in the subtree), ``saved_tokens`` (over the subtree, all but one of each node's conversations times the code points
    of its last turn) and ``ends_sha256`` (of the ids of conversations that end there, ascending, joined by commas).
    A subtree includes its top. Without conversations there is no node.

    Nodes of one depth hold different conversations, so depth and least conversation name a node. There are as many
    rounds as the longest conversation has blocks; those after the first see only the conversations that go on. Copies
    are combined before each shuffle, so a conversation or a start that a third of all share is no larger than others.
    """
    ship_package(turns.sparkSession)
    longest = lengths.agg(F.max("length")).first()[0]
    if longest is None:
        return _nothing(turns)
    cut = _blocks_of(turns, first_block, next_block)
    blocks = 1 + max(0, -(-(longest - first_block) // next_block))
    alive = lengths.select("conv_id", "length", F.lit(0).cast("bigint").alias("prior"))
    measures = [F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")]
    nodes, offset = [], 0
    roots = [scratch_path(turns.sparkSession, name) for name in ("nodes", "placed", "subtrees")]
    for block in range(blocks):
        width = next_block if block else first_block
        names = _columns(width)
        rows = pin(alive.join(_wide(cut, block, width), "conv_id", "inner" if block else "left"), "block")
        # The top of a later block is a node of the one before.
        rolled = _prefixes(rows, width, measures).filter(f"level >= {min(block, 1)}")
        parent = f"CASE WHEN level > 1 THEN {_key(block, '(level - 1)', width)} WHEN level = 1 AND {block} = 0 THEN X'' END"
        found = rolled.select(
            *names,
            "prior",
            "level",
            "conv_id",
            "n_convs",
            F.when(F.col("level") > 0, (F.col("n_convs") - 1) * turn_length(F.col("last"))).otherwise(0).alias("own"),
            F.expr(f"CASE WHEN level = 0 THEN X'' ELSE {_key(block, 'level', width)} END AS key"),
            F.expr(parent).alias("parent"),
            (F.col("level") + F.lit(offset)).cast("bigint").alias("depth"),
        )
        found = _stored(found, roots[0], block)
        nodes.append(found)
        # Each conversation meets the node of the path that it has in this block: there it ends, or goes on below it.
        size = F.least(F.col("length") - offset, F.lit(width)).alias("size")
        keyed = rows.select("conv_id", "length", "prior", *names, size).withColumn(
            "__key", F.expr(f"CASE WHEN size = 0 THEN X'' ELSE {_key(block, 'size', width)} END")
        )
        of = found.select(F.col("key").alias("__key"), F.col("conv_id").alias("node"))
        offset += width
        placed = keyed.join(of, "__key").select("conv_id", "length", "node", (F.col("length") <= offset).alias("ends"))
        placed = _stored(placed, roots[1], block)
        alive = placed.filter("NOT ends").select("conv_id", "length", F.col("node").alias("prior"))
    return _measured(nodes, roots, first_block, next_block)


def _measured(nodes: list[DataFrame], roots: list[str], first: int, further: int) -> DataFrame:
    reader = nodes[0].sparkSession.read
    slim = "key binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, prior bigint"
    every = reader.schema(slim).parquet(roots[0])
    # The first level of a later block hangs on the node that the block continues.
    above = every.select(F.col("key").alias("__above"), F.col("conv_id").alias("parent_conv_id"))
    inside = every.filter("parent IS NOT NULL").join(above, F.col("parent") == F.col("__above")).drop("__above")
    across = every.filter("parent IS NULL AND depth > 0").withColumn("parent_conv_id", F.col("prior"))
    root = every.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    columns = ["key", "depth", "conv_id", "n_convs", "parent_conv_id"]
    hung = pin(reduce(DataFrame.unionByName, [part.select(*columns) for part in (inside, across, root)]), "hung")
    children = hung.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    children = pin(children, "children")
    sums = _subtrees(nodes, children, roots[2], first, further)
    placed = reader.schema("conv_id bigint, length bigint, node bigint, ends boolean").parquet(roots[1]).filter("ends")
    digests = _ends_digest(placed.select(F.col("length").alias("depth"), "node", "conv_id")).withColumnRenamed("node", "conv_id")
    names = ["depth", "conv_id"]
    return (
        hung.join(children, names, "left")
        .join(sums, names)
        .join(digests, names, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def _subtrees(nodes: list[DataFrame], children: DataFrame, root: str, first: int, further: int) -> DataFrame:
    """Rows (depth, conv_id, n_leaves, saved_tokens): sums over each node's subtree, from the last block to the first."""
    below = None
    for block in reversed(range(len(nodes))):
        width = further if block else first
        names = _columns(width)
        own = nodes[block].join(children, ["depth", "conv_id"], "left").select(
            "prior", *names, "level", "depth", "conv_id", "own", F.col("n_children").isNull().cast("bigint").alias("leaf")
        )
        if below is not None:
            # What hangs on this block's deepest nodes; a later block's top stands for all of it.
            hangs = below.select(F.col("prior").alias("__on"), F.col("n_leaves").alias("__l"), F.col("saved_tokens").alias("__s"))
            deepest = (F.col("level") == width) & (F.col("conv_id") == F.col("__on"))
            own = own.join(hangs, deepest, "left").withColumns(
                {
                    "own": F.col("own") + F.coalesce("__s", F.lit(0)),
                    "leaf": F.col("leaf") + F.coalesce("__l", F.lit(0)),
                }
            )
        summed = _prefixes(
            own.select("prior", *names, "depth", "conv_id", "own", "leaf", F.col("level").alias("own_level")),
            width,
            [
                F.sum("leaf").alias("n_leaves"),
                F.sum("own").alias("saved_tokens"),
                F.min(F.struct("depth", "conv_id")).alias("top"),
            ],
        )
        summed = summed.select("prior", "level", "n_leaves", "saved_tokens", "top.depth", "top.conv_id")
        summed = _stored(summed, root, block)
        below = summed.filter("level = 0")
    schema = "level int, n_leaves bigint, saved_tokens bigint, depth bigint, conv_id bigint, block int"
    stored = nodes[0].sparkSession.read.schema(schema).parquet(root)
    # The top of a later block is a node of the one before, which has its sums.
    return stored.filter("level > 0 OR block = 0").select("depth", "conv_id", "n_leaves", "saved_tokens")


def _nothing(turns: DataFrame) -> DataFrame:
    schema = (
        "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string"
    )
    return turns.sparkSession.createDataFrame([], schema)


def conversation_trie(conversations: DataFrame, **options) -> DataFrame:
    """:func:`prefix_trie` of the conversations as :func:`rebuilt_turns` makes them. Columns beyond ``conv_id``,
    ``turn``, ``role`` and ``text`` are not read; repeated rows are turns of their own."""
    turns, lengths = rebuilt_turns(pin(ordered_turns(conversations), "ordered"))
    return prefix_trie(turns, lengths, **options)

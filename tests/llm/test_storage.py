"""Sharding, rollups and training order."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from placemill.llm import bpe
from placemill.llm import materialise as M
from placemill.llm import queries as Q
from placemill.llm import sharding as S
from placemill.llm.rollups import Rollup, deleted, inserted, revised

from ..conftest import TESTDATA


def test_sharding(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet")
    rows = S.shard_records(docs, root=f"{tmp_path}/map").collect()
    texts = dict(docs.select("doc_id", "text").collect())
    assert {row["doc_id"] for row in rows} == set(texts) and len(rows) == len(texts)
    held, places, virtual = defaultdict(int), defaultdict(list), defaultdict(set)
    for row in rows:
        raw = (texts[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"], row["law"]) == (len(raw) + 16, zlib.crc32(raw), "bytes")
        assert row["grown_shard"] is None
        held[row["shard"]] += row["size"]
        places[row["shard"]].append(row["slot"])
        virtual[row["virtual_slot"]].add(row["shard"])
    assert set(held) == set(range(40))
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    assert all(len(shards) == 1 for shards in virtual.values())
    assert max(held.values()) < 1.01 * sum(held.values()) / 40 and min(held.values()) > 0.99 * sum(held.values()) / 40
    current, first = S.load_map(spark, f"{tmp_path}/map"), S.load_map(spark, f"{tmp_path}/map", 0)
    assert current.version == 1 and first == S.SlotMap.even(S.SLOTS, S.SHARDS)
    assert all(current.shard_of[slot] == shard for slot, (shard,) in virtual.items())


@pytest.mark.parametrize("text", ["'copy ' || repeat('x', 3000)", "null"])
def test_sharding_of_equal_rows(spark, text):
    """A third of all rows agree in id and text: they do not stay in one slot, and run twice, all rows lie as before."""
    docs = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, null, id) AS doc_id", f"if(id % 3 = 0, {text}, repeat('y', cast(id % 2000 AS int))) AS text"
    )
    out = S.shard_records(docs).cache()
    held = out.groupBy("shard").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("slot").alias("low"),
        F.max("slot").alias("high"), F.countDistinct("slot").alias("slots"),
    ).collect()
    mean = sum(row["bytes"] for row in held) / 40
    assert len(held) == 40 and all(abs(row["bytes"] - mean) < 0.01 * mean for row in held)
    assert all((row["low"], row["high"], row["slots"]) == (0, row["rows"] - 1, row["rows"]) for row in held)
    fullest = out.groupBy("virtual_slot").count().agg(F.max("count")).first()[0]
    assert sum(row["rows"] for row in held) == 60_000 and fullest < 60
    again = S.shard_records(docs)
    assert again.exceptAll(out).isEmpty()
    out.unpersist()


def test_growing_and_shrinking_a_map():
    rng = np.random.default_rng(1)
    sizes = [int(size) for size in rng.pareto(2, 2000) * 1000 + 50]
    even = S.SlotMap.even(2000, 10).rebalanced(sizes)
    grown = even.rebalanced(sizes, 11)
    load = np.bincount(grown.shard_of, sizes, 11)
    assert load.max() < 1.01 * load.mean() and (grown.version, grown.shards) == (2, 11)
    moved = [size for a, b, size in zip(even.shard_of, grown.shard_of, sizes, strict=True) if a != b]
    assert load.mean() * 0.99 < sum(moved) < load.mean() * 1.5 and len(moved) < 300
    shrunk = grown.rebalanced(sizes, 4)
    assert set(shrunk.shard_of) == {0, 1, 2, 3}
    assert S.SlotMap.even(4, 2).rebalanced([0, 0, 0, 0]).shard_of == (0, 1, 0, 1)


def _counts(spark, *rows):
    return spark.createDataFrame(rows, "source string, lang string, tokenizer string, old_tokens bigint, tokens bigint")


def _totals(rollup):
    return sorted((tuple(row) for row in rollup.totals().collect()), key=str)


def test_rollup(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "rollup"))
    assert _totals(rollup) == []
    a, b, none = ("s", "en", "t1", 0, 5), ("s", "en", "t1", 0, 7), (None, None, "t1", 0, 2)
    assert rollup.commit(0, inserted(_counts(spark, a, b, none)))
    assert not rollup.commit(0, inserted(_counts(spark, none, b, a)))
    with pytest.raises(ValueError):
        rollup.commit(0, inserted(_counts(spark, a)))
    with pytest.raises(ValueError):
        rollup.commit(2, inserted(_counts(spark, a)))
    assert rollup.commit(1, deleted(_counts(spark, none)))
    assert _totals(rollup) == [("s", "en", "t1", 2, 12)]
    # A writer that died left files without the mark of a finished write.
    inserted(_counts(spark, a)).write.parquet(f"{rollup.root}/batch=2")
    (tmp_path / "rollup" / "batch=2" / "_SUCCESS").unlink()
    assert _totals(rollup) == [("s", "en", "t1", 2, 12)]
    assert rollup.commit(2, revised(_counts(spark, ("s", "en", "t1", 7, 10))))
    before = _totals(rollup)
    assert before == [("s", "en", "t1", 2, 15)]
    for number in range(3, 6):
        rollup.commit(number, inserted(_counts(spark, ("s", "fr", "t2", 0, number))))
        rollup.fold()
        again = Rollup(spark, rollup.root)
        assert not again.commit(number, inserted(_counts(spark, ("s", "fr", "t2", 0, number))))
        with pytest.raises(ValueError):
            again.commit(0, inserted(_counts(spark, a)))
    assert not rollup.commit(1, deleted(_counts(spark, none)))
    left = {path.name for path in (tmp_path / "rollup").iterdir() if path.name.startswith("batch")}
    assert left == {"batch=4", "batch=5"}
    assert rollup._folded() == 4 and _totals(rollup) == [("s", "en", "t1", 2, 15), ("s", "fr", "t2", 3, 12)]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4096, 4097])
def test_permutation(size):
    numbers = np.arange(size)
    places = M.permute(numbers, size, key=11)
    assert sorted(places.tolist()) == numbers.tolist()
    assert (M.restore(places, size, key=11) == numbers).all()
    if size >= 1000:
        assert (places != M.permute(numbers, size, key=12)).mean() > 0.9
        assert abs(np.corrcoef(numbers, places)[0, 1]) < 0.1
    assert len(M.permute(numbers[:0], size, key=1)) == 0


def test_training_order(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    written = M.materialise(docs, key=5, root=f"{tmp_path}/shards", stride=256, per_shard=1000)
    rows = sorted(written.collect(), key=lambda row: row["place"])
    size = len(rows)
    assert [row["place"] for row in rows] == list(range(size)) and size > 5000
    assert all((row["shard"], row["offset"]) == (k // 1000, k % 1000 * 256) for k, row in enumerate(rows))
    assert all(len(row["tokens"]) == 256 and set(row["tokens"][row["n_tokens"] :]) <= {M.PAD} for row in rows)
    parts = defaultdict(dict)
    for row in rows:
        parts[row["doc_id"]][row["part"]] = bytes(row["tokens"][: row["n_tokens"]])
    for number, text in docs.select("doc_id", "text").collect():
        whole = b"".join(parts[number][k] for k in range(len(parts[number])))
        assert whole == (text or "").encode() + bytes([M.END])
    assert sum(b["doc_id"] - a["doc_id"] in (0, 1) for a, b in zip(rows, rows[1:], strict=False)) < size / 20
    rest = M.read_places(spark, f"{tmp_path}/shards", 1500, 2500, per_shard=1000)
    assert sorted(row["place"] for row in rest.collect()) == list(range(1500, 2500))
    assert "PartitionFilters: [isnotnull(shard" in rest._jdf.queryExecution().toString()
    again = M.materialise(docs.repartition(3), key=5, root=f"{tmp_path}/again", stride=256, per_shard=1000)
    assert again.count() == size


@pytest.mark.parametrize("width", [2, 4, None])
def test_training_order_of_token_ids(spark, tmp_path, width):
    """What bpe.encode gives comes back token by token, and decodes to the texts."""
    automaton = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    ids = bpe.encode(docs, automaton, keep=["doc_id"])
    written = M.materialise(ids, key=9, root=f"{tmp_path}/shards", text="ids", stride=512, per_shard=50, width=width)
    number = np.dtype(f"<u{width or 4}")
    end = np.iinfo(number).max - 1
    parts = defaultdict(dict)
    for row in written.collect():
        tokens = np.frombuffer(bytes(row["tokens"]), number)
        assert len(row["tokens"]) == 512 and row["n_tokens"] <= len(tokens)
        assert (tokens[row["n_tokens"] :] == end + 1).all() and row["offset"] == row["place"] % 50 * 512
        parts[row["doc_id"]][row["part"]] = tokens[: row["n_tokens"]]
    wanted = dict(ids.select("doc_id", "ids").collect())
    joined = {key: np.concatenate([found[k] for k in range(len(found))]).tolist() for key, found in parts.items()}
    assert joined == {key: [*(found or []), end] for key, found in wanted.items()}


def test_training_order_of_awkward_ids(spark):
    rows = [(1, [1, None, 3]), (1, [1, None, 3]), (None, []), (2, None), (3, [None]), (4, list(range(9000))), (5, [65533])]
    ids = spark.createDataFrame(rows, "`a.b` bigint, place array<int>").coalesce(1)
    got = [tuple(row) for row in M.records(ids, doc_id="a.b", text="place", stride=8, width=2).collect()]
    tokens = [(key, part, np.frombuffer(bytes(raw), "<u2")[:n].tolist()) for key, part, n, raw in got]
    end = 65534
    assert tokens[:5] == [(1, 0, [1, 3, end]), (1, 0, [1, 3, end]), (None, 0, [end]), (2, 0, [end]), (3, 0, [end])]
    assert [token for key, _, part in tokens if key == 4 for token in part] == [*range(9000), end]
    assert tokens[-1] == (5, 0, [65533, end])
    for wrong in (-1, 65534):
        with pytest.raises(Exception, match="do not fit"):
            M.records(spark.createDataFrame([(1, [wrong])], "doc_id int, text array<int>"), width=2).collect()
    for options in ({"width": 1}, {"width": 4, "stride": 10}, {"width": 3}):
        with pytest.raises(ValueError):
            M.records(ids, doc_id="a.b", text="place", **options)
    with pytest.raises(ValueError):
        M.records(ids.select(F.col("`a.b`").alias("doc_id"), F.lit("x").alias("text")), width=2)


def test_training_order_of_awkward_texts(spark, tmp_path):
    """Nulls, repeated ids, a long text, and columns that have the names of the result's."""
    rows = [(None, None), (None, "a"), (1, ""), (1, "b"), (1, "b"), (2, "\u00e9" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "'x' AS place", "'x' AS Shard", "1 AS offset", "0 AS part", "0 AS n_tokens", "'x' AS tokens", "0 AS number"
    )
    written = M.materialise(docs, key=3, root=f"{tmp_path}/shards", stride=1000, per_shard=7)
    found = sorted(written.collect(), key=lambda row: row["place"])
    assert [row["place"] for row in found] == list(range(206)) and {row["shard"] for row in found} == set(range(30))
    whole = defaultdict(list)
    for row in sorted(found, key=lambda row: row["part"]):
        whole[row["doc_id"]].append(bytes(row["tokens"][: row["n_tokens"]]))
    assert b"".join(whole.pop(2)) == ("\u00e9" * 100_000).encode() + bytes([M.END])
    one, none = bytes([M.END]), b"a" + bytes([M.END])
    assert {key: sorted(parts) for key, parts in whole.items()} == {None: [none, one], 1: [b"b" + one, b"b" + one, one]}


def test_shards_are_written_in_order_and_without_sampling(spark, tmp_path):
    """Each folder is one file whose rows follow one another, though a task writes several."""
    docs = spark.range(500).selectExpr("id AS doc_id", "'text ' || id AS text")
    written = M.materialise(docs, key=4, root=f"{tmp_path}/shards", stride=64, per_shard=20)
    located = written.select("place", "shard", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    rows = located.collect()
    assert len({row["file"] for row in rows}) == len({row["shard"] for row in rows}) == 25
    assert all(row["at"] == row["place"] % 20 for row in rows)


def test_order_query(spark):
    out = Q.op9_training_order(spark, f"{TESTDATA}/sf0.001")
    assert out.agg(F.max("place") + 1 == F.count("place"), F.countDistinct("place") == F.count("place")).first() == (True, True)

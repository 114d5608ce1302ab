import math
import random

import numpy as np
import pytest

from placemill.llm import jaccard as J

from ..conftest import TESTDATA


def _brute(texts, words_of):
    """Class (least id) and links of each id, by comparing all pairs."""
    sets = {}
    for number, text in texts.items():
        words = words_of(text)
        shingles = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)}
        sets[number] = shingles if words else {("", text or "")}
    least = {number: number for number in texts}
    links = dict.fromkeys(texts, 0)

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    numbers = sorted(texts)
    for k, a in enumerate(numbers):
        for b in numbers[:k]:
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                one, two = sorted((root(a), root(b)))
                least[two] = one
    return {number: (root(number), links[number]) for number in texts}


def _found(frame):
    return {row["doc_id"]: (row["class_id"], row["n_links"]) for row in frame.collect()}


def test_whole_documents(spark, words_of):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    assert _found(J.similar_documents(docs)) == _brute(texts, words_of)


@pytest.mark.parametrize("block", [J.BLOCK, 4])
def test_large_groups(spark, words_of, block):
    """Copies, and near copies of one text in buckets that are far larger than a block."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = {k: " ".join(base) for k in range(40)}
    for k in range(40, 160):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(words)
    for k in range(160, 200):
        texts[k] = " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(9)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    assert _found(J.similar_documents(docs, block=block)) == _brute(texts, words_of)
    kept = J.keep_one_of_each(docs).collect()
    assert sorted(row["doc_id"] for row in kept) == sorted({label for label, _ in _brute(texts, words_of).values()})


def test_pruning_bound():
    least = J.least_matches(0.8, 1e-6, J.HASHES)
    for n in (16, 48, 96):
        # The posterior by numerical integration, on both sides of the bound.
        s = np.linspace(0, 1, 200_001)
        for m in (least[n] - 1, least[n]):
            density = s**m * (1 - s) ** (n - m)
            reached = density[s >= 0.8].sum() / density.sum()
            assert (reached >= 1e-6) == (m >= least[n])
    assert (1 - 0.8**J.ROWS) ** J.BANDS < 1e-5 and math.isclose(J.HASHES, 96)


def test_components(spark):
    edges = [(f"{k:03}", f"{k + 1:03}") for k in range(40)] + [("x", "y"), ("y", "x"), ("z", "z"), ("900", "901")]
    frame = spark.createDataFrame(edges, "a string, b string").selectExpr("cast(a as binary) a", "cast(b as binary) b")
    found = {bytes(row["node"]).decode(): bytes(row["label"]).decode() for row in J.components(frame, "a", "b").collect()}
    assert found == {f"{k:03}": "000" for k in range(41)} | {"x": "x", "y": "x", "900": "900", "901": "900"}


def test_what_is_written_of_near_copies(spark, words_of, monkeypatch):
    """Rows in proportion to the members of a group, not to its pairs."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = {}
    for k in range(1200):
        words = list(base)
        for _ in range(rng.randrange(1, 3)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(words)
    written = {}
    plain = J.pin

    def pin(frame, label):
        copy = plain(frame, label)
        written[label] = copy.count()
        return copy

    monkeypatch.setattr(J, "pin", pin)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(8)
    found = _found(J.similar_documents(docs))
    assert {label for label, _ in found.values()} == {0}
    assert sum(links for _, links in found.values()) > 1_000_000
    assert written["members"] + written["links"] < 40_000


def test_words_that_differ_in_the_order_of_their_pieces(spark, words_of):
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    texts = dict(enumerate([one, two, f"{one} {two}", f"{two} {one}", one]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert _found(J.similar_documents(docs)) == _brute(texts, words_of)

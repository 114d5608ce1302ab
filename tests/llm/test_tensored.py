import random
import re

import pytest

from placemill.llm import tensored as D

_WORD = re.compile("[^\x20\x09-\x0d]+")


def _brute(rows):
    """(n_shingles, component_id, kept) of each row by comparing all pairs."""
    sets = []
    for _, text, *_ in rows:
        words = _WORD.findall(re.sub("[A-Z]", lambda match: match[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 3]) for k in range(max(len(words) - 2, 1))} if words else set())
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and sets[a]:
                label[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[root(k)] = min(row[0], least.get(root(k), row[0]))
    found = [(row[0], len(sets[k]), least.get(root(k))) for k, row in enumerate(rows)]
    return sorted(((number, size, own, number == own) for number, size, own in found), key=str)


def _found(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def _near(rng, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [D.BLOCK, 3])
def test_groups(spark, block):
    """Exact copies, a chain of ever further copies, near copies of two texts that share half of their words, and others."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    one, two = words[:120], words[60:180]
    rows = [(k, " ".join(one)) for k in range(20)]
    rows += [(k, _near(rng, one, rng.randrange(1, 5))) for k in range(20, 90)]
    rows += [(k, _near(rng, two, rng.randrange(1, 5))) for k in range(90, 150)]
    chain = list(words[200:300])
    for k in range(150, 190):
        chain[rng.randrange(100)] = f"c{k}"
        rows.append((k, " ".join(chain)))
    rows += [(k, " ".join(words[:8] + [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(60))])) for k in range(190, 260)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert _found(D.near_duplicates(docs, block=block)) == _brute(rows)


def test_awkward(spark, awkward):
    rows = [tuple(row) for row in awkward.collect()] + [(20, "A b"), (21, "a\tB"), (22, "b a"), (None, "a b"), (23, "x\x00y"), (24, "\x0b \n")]
    docs = spark.createDataFrame([(row[0], row[1], "k", 1) for row in rows], "doc_id bigint, text string, key string, label int")
    assert _found(D.near_duplicates(docs)) == _brute(rows)
    assert D.near_duplicates(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        D.near_duplicates(docs, share=80)


def test_keys_of_words(spark):
    """Texts whose words differ only in the order of long pieces are not confused."""
    one, two = "ab", "ba"
    for _ in range(9):
        one, two = one + two, two + one
    rows = [(1, one), (2, two), (3, f"{one} {two} a"), (4, f"{two} {one} a"), (5, one)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _found(D.near_duplicates(docs)) == _brute(rows)


def test_miss_rate():
    assert 2 * (1 - 0.85**D.PICK) ** D.COLLECTION < 1e-5

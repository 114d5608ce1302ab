import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from placemill.llm import fmindex as X
from placemill.llm import variants as V


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


@pytest.mark.parametrize("letters, longest", [("a", 20), ("ab", 9), ("abc", 10), ("abéÿ", 8), ("ab日🎉", 8)])
def test_every_near_word_once(letters, longest):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(6, longest))) for _ in range(300)})
    alphabet = np.unique([ord(letter) for letter in letters]).astype(np.uint32)
    asked = X.numbered(words, alphabet)
    indexed = words[::2]
    found = X.near_words(X.numbered(indexed, alphabet), len(alphabet) + 1, asked, asked)
    pairs = [(words[a], indexed[b]) for by, hits in found for a, b in zip(by, hits, strict=True)]
    assert sorted(pairs) == sorted((a, b) for a in words for b in indexed if _near(a, b))


def test_both_ends_of_a_pattern_agree():
    words = sorted({"banana", "ananas", "bananas", "nabana"})
    alphabet = np.unique([ord(letter) for letter in "abns"]).astype(np.uint32)
    index = X.Index(X.numbered(words, alphabet), 5)
    number = {letter: k + 1 for k, letter in enumerate("abns")}
    at = index.empty(1)
    for letter, way in (("a", index.left), ("n", index.left), ("a", index.right), ("a", index.left)):
        at = way(at, np.array([number[letter]], np.int32))
    assert at.size[0] == sum(word.startswith("anaa", k) for word in words for k in range(6))
    at = index.empty(1)
    for letter, way in (("n", index.left), ("a", index.right), ("a", index.left)):
        at = way(at, np.array([number[letter]], np.int32))
    assert at.size[0] == sum(word.startswith("ana", k) for word in words for k in range(7))


def _brute(rows):
    counts = Counter()
    for number, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda match: match[0].lower(), run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}
    near = {word: [other for other in counts if _near(word, other)] for word in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        if best is not None and counts[best] >= 5 * counts[word]:
            form[word] = best
    out = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, len(near[word]), counts.get(form.get(word))))
    return sorted(out, key=str)


def _found(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("indexed", [V.INDEXED, 3])
def test_words_of_documents(spark, indexed):
    """Chains of forms, ties, words that all begin alike, and single runs of many occurrences."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(40)] + ["abaÉxyz", "ababab", "bababa"]
    words += ["chain" + "s" * k for k in range(1, 6)]
    weights = [3 ** rng.randrange(5) for _ in words[:-5]] + [1, 6, 36, 216, 1296]
    rows = [(k if k % 9 else None, " ".join(rng.choices(words, weights, k=60)).title(), "n") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string").repartition(4)
    assert _found(V.spelling_variants(docs, indexed=indexed)) == _brute(rows)


def test_awkward(spark, awkward):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()] * 5 + [(1, "x" * 30_000), (2, "x" * 29_999)] * 6
    docs = spark.createDataFrame([(*row, 1, "f") for row in rows], "doc_id bigint, text string, n int, form string")
    assert _found(V.spelling_variants(docs)) == _brute(rows)
    assert V.spelling_variants(docs.limit(0)).collect() == []

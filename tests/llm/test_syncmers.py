import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from placemill.llm import syncmers as S

from ..conftest import TESTDATA

_MASK = 2**32 - 1


def _signed(value, bits=64):
    return value - (1 << bits) if value >> (bits - 1) else value


def _murmur_step(h, k):
    k = k * 0xCC9E2D51 & _MASK
    k = (k << 15 | k >> 17) & _MASK
    h ^= k * 0x1B873593 & _MASK
    return ((h << 13 | h >> 19) & _MASK) * 5 + 0xE6546B64 & _MASK


def _murmur_end(h, size):
    h ^= size
    h = (h ^ h >> 16) * 0x85EBCA6B & _MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & _MASK
    return h ^ h >> 16


def _hash_longs(values):
    seed = 42
    for value in values:
        value &= 2**64 - 1
        seed = _murmur_end(_murmur_step(_murmur_step(seed, value & _MASK), value >> 32), 8)
    return seed


_PIECE = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), S._PIECE).replace(r"\s", " \t\n\x0b\f\r"))


def _pieces(text):
    return _PIECE.findall("".join(char.lower() if char != "Σ" else "σ" for char in text or ""))


def _plain(text):
    """Closed syncmers by their definition."""
    hashes = [_signed(xxhash.xxh64_intdigest(piece.encode(), seed=42)) for piece in _pieces(text)]
    if len(hashes) < S.K:
        return [_hash_longs(hashes)] if hashes else []
    windows = [hashes[k : k + S.K] for k in range(len(hashes) - S.K + 1)]
    return [_hash_longs(window) for window in windows if min(window) in (window[0], window[-1])]


def _likeness(one, two):
    return len(set(one) & set(two)) / len(set(one) | set(two)) if one or two else 1.0


@pytest.mark.parametrize("ranges", [None, 1, 300])
def test_fingerprints(spark, ranges):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    rows = {row["doc_id"]: row for row in S.fingerprint_documents(docs, ranges=ranges).collect()}
    texts = sorted(docs.select("doc_id", "text").collect(), reverse=True)
    assert len(rows) == len(texts)
    for (number, text), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True):
        row, half = rows[number], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = _plain(text), _plain(edited)
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == "".join(f"{mark:08x}" for mark in own)
        assert row["edited_fingerprint"] == "".join(f"{mark:08x}" for mark in changed)
        assert row["near_edited"] == pytest.approx(_likeness(own, changed))
        assert row["near_next"] == pytest.approx(_likeness(own, _plain(after)))


def test_pieces():
    assert _pieces("Un texte, 日本 strngths x2") == ["u", "n", "te", "xte", ",", "日", "本", "strn", "gths", "x2"]


def test_awkward_texts(spark):
    odd = ["", None, "a", "ab", "abcde", "ΟΔΟΣ ΣΑ", "x\U0001f389y\U0001f389\U0001f389zz\nİstanbul", "De.", "Avec ceci.",
           "aaaaaaaaaaaaaaaa", "日本語テキスト日本語", "กขคงจฉ", "One TWO three", "ab" * 50, "x" * 60, "\u3000 \x00"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string")
    rows = {row["doc_id"]: row for row in S.fingerprint_documents(docs, ranges=3).collect()}
    for number, text in enumerate(odd):
        text, after = text or "", odd[number - 1] or ""
        half = len(text) // 2
        own, changed, following = (_plain(t) for t in (text, text[: len(text) - half] + after[:half], after))
        assert rows[number]["fingerprint"] == "".join(f"{mark:08x}" for mark in own)
        assert rows[number]["edited_fingerprint"] == "".join(f"{mark:08x}" for mark in changed)
        assert rows[number]["near_next"] == pytest.approx(_likeness(own, following))


def test_anchors_do_not_depend_on_what_stands_before(spark):
    words = [f"t{k * k % 97}" for k in range(80)]
    rows = [(shift, " ".join(["i"] * shift + words)) for shift in range(9)]
    frame = spark.createDataFrame(rows, "shift int, text string").select("shift", S.anchors(F.col("text")).alias("marks"))
    found = {row["shift"]: {(mark["place"] - row["shift"], mark["hash"]) for mark in row["marks"]} for row in frame.collect()}
    inner = found[0]
    assert 15 < len(inner) and all({mark for mark in marks if mark[0] >= 1} == inner for marks in found.values())


def test_anchors_and_their_hashes(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    both = docs.select(S.anchors(F.col("text"))["hash"].alias("a"), S.anchor_hashes(F.col("text")).alias("b"))
    assert both.filter("a <> b").isEmpty()


def test_a_single_document_is_its_own_next(spark):
    row = S.fingerprint_documents(spark.createDataFrame([(7, "abcdef")], "doc_id bigint, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1.0


def test_plan_is_native(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    plan = S.fingerprint_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.split("Initial Plan")[-1].count("Exchange hash") == 1


def test_half_of_a_short_text_leaves_shared_anchors(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").filter("length(text) >= 16")
    share = F.avg((F.col("near_edited") > 0).cast("int"))
    assert S.fingerprint_documents(docs).agg(share).first()[0] > 0.99
    short = S.fingerprint_documents(docs.filter("length(text) < 60")).agg(share, F.count("*")).first()
    assert short[1] > 5 and short[0] > 0.9


@pytest.mark.parametrize("alphabet", ["กขคงจฉชซฌญ", "ཀཁགངཅཆཇཉཏཐ", "abcXYZ0189+/", "bcdfghjklmae"])
def test_an_unspaced_passage_keeps_its_anchors_at_any_offset(spark, alphabet):
    passage = "".join(alphabet[k * k * 7 % 101 % len(alphabet)] for k in range(150))
    texts = [passage, alphabet[:5] + passage, alphabet[3:] * 3 + passage + alphabet]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {row["doc_id"]: row["fingerprint"] for row in S.fingerprint_documents(docs).collect()}
    marks = {number: {digits[k : k + 8] for k in range(0, len(digits), 8)} for number, digits in found.items()}
    assert len(marks[0]) > 5
    # Only what lies at an end, before the first cut, may be cut otherwise.
    assert all(len(marks[0] - marks[k]) <= 4 for k in (1, 2))

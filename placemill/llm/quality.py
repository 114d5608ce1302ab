"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, of which labels say nothing by themselves. Every passage is encoded from its bytes; a
gated attention, learned from document labels alone, weighs the encodings; the score is read off their weighted mean.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.texts import Scorer, add_text_columns, segments

#: Bytes of a passage.
PASSAGE = 256
#: Buckets of hashed byte trigrams; and the size of a passage's encoding and of the attention's inner layer.
BUCKETS = 512
ENCODING, ATTENTION = 16, 8
#: Training sample: so many documents of each label at most, and of each a stretch of so many bytes.
SAMPLE_DOCS = 3000
SAMPLE_BYTES = 2048
#: Words of a short excerpt, one of which is added for each document of the sample.
EXCERPT_WORDS = 15
EPOCHS = 12
BATCH = 32
#: A document with at least this score counts as good.
CUTOFF = 0.3

_KINDS = np.zeros(256, np.int64)
for _byte in range(256):
    _char = chr(_byte)
    _KINDS[_byte] = (
        6 if _byte >= 128 else 0 if _char.islower() else 1 if _char.isupper() else 2 if _char.isdigit() else 3
        if _char == " " else 4 if _char.isspace() else 5
    )
#: Buckets, shares of the kinds of bytes, share of buckets in use, fullness of the passage.
FEATURES = BUCKETS + 9

_SCORED = T.StructType([T.StructField("score", T.DoubleType())])


class Model(NamedTuple):
    """Weights of encoder, attention (value, gate, direction) and output."""

    encoder: np.ndarray
    offset: np.ndarray
    value: np.ndarray
    gate: np.ndarray
    direction: np.ndarray
    output: np.ndarray
    bias: np.ndarray


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the numbers of their texts. An empty text is one empty passage."""
    starts, lengths, text = segments(offsets, PASSAGE, at_least=1)
    owner = np.repeat(np.arange(len(starts)), lengths)
    wide = data.astype(np.uint32)
    following = np.concatenate([wide[1:], np.zeros(min(1, len(wide)), np.uint32)])
    third = np.concatenate([following[1:], np.zeros(min(1, len(wide)), np.uint32)])
    # A trigram that reaches into the next passage counts here, but none reaches into the next text.
    place = np.arange(len(data))
    inside = place + 2 < np.repeat(offsets[1:], np.diff(offsets))
    codes = (wide * np.uint32(0x01000193) ^ following) * np.uint32(0x01000193) ^ third
    codes = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    cells = owner[inside] * BUCKETS + codes[inside]
    counts = np.bincount(cells, minlength=len(starts) * BUCKETS).reshape(-1, BUCKETS)
    kinds = np.bincount(owner * 7 + _KINDS[data], minlength=len(starts) * 7).reshape(-1, 7)
    size = np.maximum(lengths, 1)[:, None].astype(np.float32)
    features = np.empty((len(starts), FEATURES), np.float32)
    np.divide(counts, size, out=features[:, :BUCKETS], casting="same_kind")
    np.sqrt(features[:, :BUCKETS], out=features[:, :BUCKETS])
    features[:, BUCKETS : BUCKETS + 7] = kinds / size
    features[:, BUCKETS + 7] = (counts > 0).sum(1) / size[:, 0]
    features[:, BUCKETS + 8] = lengths / PASSAGE
    return features, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _forward(model: Model, features: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple:
    """Scores of the documents whose passages begin at ``first``, and the values in between."""
    encoded = np.tanh(features @ model.encoder + model.offset)
    value, gate = np.tanh(encoded @ model.value), _sigmoid(encoded @ model.gate)
    raw = (value * gate) @ model.direction
    weights = np.exp(raw - np.maximum.reduceat(raw, first)[text])
    weights /= np.add.reduceat(weights, first)[text]
    pooled = np.add.reduceat(encoded * weights[:, None], first)
    return _sigmoid(pooled @ model.output + model.bias), pooled, weights, encoded, value, gate


def score_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    features, text = passages(data, offsets)
    return _forward(model, features, np.searchsorted(text, np.arange(len(offsets) - 1)), text)[0]


def attention(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each passage in its text, and the number of the text."""
    features, text = passages(data, offsets)
    return _forward(model, features, np.searchsorted(text, np.arange(len(offsets) - 1)), text)[2], text


def train(texts: list[bytes], labels: list[int], *, epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Fit encoder, attention and output together to document labels (Adam, cross-entropy, both labels weigh the same).

    The result depends on the multiset of examples and ``seed`` alone.
    """
    examples = sorted(zip(texts, labels, strict=True))
    examples += _excerpts(examples, seed)
    bounds = np.cumsum([0, *(max(1, -(-len(text) // PASSAGE)) for text, _ in examples)])
    # Half precision, filled in parts: the features of all passages take about as much memory as four times the sample.
    features = np.empty((bounds[-1], FEATURES), np.float16)
    for begin in range(0, len(examples), 256):
        some = [text for text, _ in examples[begin : begin + 256]]
        found, _ = passages(np.frombuffer(b"".join(some), np.uint8), np.cumsum([0, *map(len, some)]))
        features[bounds[begin] : bounds[begin + len(some)]] = found
    known = np.array([label for _, label in examples], np.float32)
    share = np.array([max((known == k).mean(), 1e-9) for k in (0, 1)])
    rng = np.random.default_rng(seed)
    weights = [
        rng.normal(0, 0.5, (FEATURES, ENCODING)),
        np.zeros(ENCODING),
        rng.normal(0, 0.5, (ENCODING, ATTENTION)),
        rng.normal(0, 0.5, (ENCODING, ATTENTION)),
        rng.normal(0, 0.5, ATTENTION),
        rng.normal(0, 0.5, ENCODING),
        np.zeros(()),
    ]
    weights = [w.astype(np.float32) for w in weights]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    taken, batches = 0, -(-len(examples) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            taken += 1
            rows = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in chosen])
            counts = (bounds[1:] - bounds[:-1])[chosen]
            first, owner = np.cumsum(counts) - counts, np.repeat(np.arange(len(chosen)), counts)
            balance = 0.5 / share[known[chosen].astype(int)]
            slopes = _slopes(Model(*weights), features[rows].astype(np.float32), first, owner, known[chosen], balance)
            rate = 0.01 * (1 - taken / (epochs * batches + 1))
            for k, (slope, (mean, square)) in enumerate(zip(slopes, moments, strict=True)):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                step = rate * (mean / (1 - 0.9**taken)) / (np.sqrt(square / (1 - 0.99**taken)) + 1e-8)
                weights[k] = (weights[k] * (1 - 1e-4) - step).astype(np.float32)
    return Model(*weights)


def _excerpts(examples: list[tuple[bytes, int]], seed: int) -> list[tuple[bytes, int]]:
    """Of each example a few words with its label, so that short documents are not rare among the examples."""
    rng = np.random.default_rng(seed)
    short = []
    for text, label in examples:
        words = text.split(b" ")
        size = int(rng.integers(1, EXCERPT_WORDS + 1))
        begin = int(rng.integers(0, max(1, len(words) - size + 1)))
        short.append((b" ".join(words[begin : begin + size]), label))
    return short


def _slopes(model: Model, features, first, owner, known, balance) -> list[np.ndarray]:
    """Derivatives of the mean loss by all weights."""
    score, pooled, weights, encoded, value, gate = _forward(model, features, first, owner)
    error = (score - known) * balance / len(known)
    into = error[:, None] * model.output
    by_weight = (into[owner] * encoded).sum(1)
    expected = np.add.reduceat(by_weight * weights, first)
    by_raw = weights * (by_weight - expected[owner])
    by_both = by_raw[:, None] * model.direction
    by_value, by_gate = by_both * gate * (1 - value**2), by_both * value * gate * (1 - gate)
    by_encoded = into[owner] * weights[:, None] + by_value @ model.value.T + by_gate @ model.gate.T
    by_inner = by_encoded * (1 - encoded**2)
    return [
        features.T @ by_inner,
        by_inner.sum(0),
        encoded.T @ by_value,
        encoded.T @ by_gate,
        (value * gate).T @ by_raw,
        pooled.T @ error,
        error.sum(),
    ]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model | None:
    """A model fitted to ``sample_docs`` labelled documents of each label at most; None if there are none.

    Which documents follows from a hash of their id; of each a stretch of ``sample_bytes``, placed by a hash of the text,
    is used. The sampled labels, a bounded number of rows, are broadcast; neither table is shuffled.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label")).filter(
        F.col("__id").isNotNull() & F.col("__label").isin(0, 1)
    )
    drawn = F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) / F.lit(1 << 30)
    counts = known.groupBy(F.col("__label").alias("__of")).agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = F.lit(False)
    for row in counts:
        wanted |= (F.col("__label") == row["__of"]) & (drawn < 2.0 * sample_docs / row["n"])
    ranked = Window.partitionBy("__label").orderBy("drawn", "__id")
    chosen = known.filter(wanted).withColumn("drawn", drawn).distinct()
    chosen = chosen.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= sample_docs)
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    place = F.pmod(F.xxhash64("text"), F.greatest(F.octet_length(raw) - sample_bytes, F.lit(0)) + 1)
    stretch = raw.substr((place + 1).cast("int"), F.lit(sample_bytes)).alias("part")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("__id", "__label")), F.col("doc_id") == F.col("__id"))
    # Ids can repeat in the documents; the sample stays bounded all the same.
    picked = rows.select(stretch, "__label").distinct().orderBy(F.xxhash64("part"), "__label").limit(4 * sample_docs).collect()
    return train([bytes(row["part"]) for row in picked], [row["__label"] for row in picked]) if picked else None


def _score(model: Model | None) -> Scorer:
    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        if model is None:
            return [pa.array(np.full(len(offsets) - 1, 0.5))]
        return [pa.array(score_texts(model, data, offsets).astype(np.float64))]

    return score


def assess(docs: DataFrame, model: Model | None, *, cutoff: float = CUTOFF, keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1, higher is better) and ``predicted`` (1 from ``cutoff`` on), read from the whole text alone.

    A null or empty text is one empty passage; without a model every score is 0.5. Input columns of these names are
    replaced. Nothing is shuffled; memory is bounded by a block of text, or by the longest text.
    """
    columns = [name for name in (docs.columns if keep is None else keep) if name.lower() not in ("score", "predicted")]
    weights = docs.sparkSession.sparkContext.broadcast(model)
    scored = add_text_columns(docs, _SCORED, lambda: _score(weights.value), keep=columns)
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, *, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that count as good, with all their columns as they are."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__doc")
    return assess(docs.select(row, "text"), model, cutoff=cutoff, keep=["__doc"]).filter("predicted = 1").select("__doc.*")

"""The two trained models: derivatives against differences, and accuracy on documents they have not seen."""

import unicodedata

import numpy as np
import pyarrow as pa

from placemill.llm import langid, quality
from placemill.llm import queries as Q
from placemill.llm.words import blocks

from ..conftest import TESTDATA


def _compare_slopes(weights, slopes, loss):
    rng = np.random.default_rng(3)
    for weight, slope in zip(weights, slopes, strict=True):
        flat, at = weight.reshape(-1), rng.integers(0, weight.size, 5)
        for k in [*at, int(np.abs(np.asarray(slope)).argmax())]:
            kept, step = flat[k], 1e-5
            flat[k] = kept + step
            above = loss()
            flat[k] = kept - step
            below = loss()
            flat[k] = kept
            assert np.isclose((above - below) / (2 * step), np.asarray(slope).reshape(-1)[k], rtol=2e-2, atol=2e-4)


def test_language_slopes(monkeypatch):
    monkeypatch.setattr(langid.np, "float32", np.float64)
    rng = np.random.default_rng(1)
    size, rows, steps = 3, 4, 6
    weights = [rng.normal(size=s) for s in [(9, 256), (9, 3), (9, 256), (9, 3), (2, 6), (2,)]]
    bytes_at, lengths = rng.integers(97, 100, (steps, rows)), np.array([6, 4, 5, 1])
    known, counted = np.array([0, 1, 1, 0]), 1.0 * (np.arange(steps)[:, None] < lengths)
    balance = np.array([0.7, 1.3])

    def loss():
        forwards, backwards = langid.Direction(*weights[:2]), langid.Direction(*weights[2:4])
        network = langid.Network(forwards, backwards, weights[4], weights[5], ("a", "b"))
        chosen = langid.position_probabilities(network, bytes_at, lengths)[:, known, np.arange(rows)]
        return -(np.log(chosen) * counted * balance[known]).sum() / counted.sum()

    assert size == 3
    _compare_slopes(weights, langid._slopes(weights, bytes_at, lengths, known, counted, balance), loss)


def test_quality_slopes():
    rng = np.random.default_rng(2)
    sizes = [(7, 4), (4,), (4, 3), (4, 3), (3,), (4,), ()]
    weights = [np.array(rng.normal(size=s)) for s in sizes]
    features, text = rng.normal(size=(6, 7)), np.array([0, 0, 0, 1, 2, 2])
    first, known, balance = np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0]), np.array([0.5, 2.0, 0.5])

    def loss():
        score = quality._forward(quality.Model(*weights), features, first, text)[0]
        return -(balance * (known * np.log(score) + (1 - known) * np.log(1 - score))).mean()

    model = quality.Model(*weights)
    _compare_slopes(weights, quality._slopes(model, features, first, text, known, balance), loss)


def test_segments_are_read_apart():
    network = langid.train([b"aba" * 30, b"xyx" * 30], ["a", "x"], epochs=5)
    texts = ["aba" * 100, "xyx" * 100, "", "a", "aba" * 43 + "xyx" * 400]
    (_, data, offsets), *_ = blocks(pa.array(texts))
    together = langid.pooled(network, data, offsets)
    for text, row in zip(texts, together, strict=True):
        (_, data, offsets), *_ = blocks(pa.array([text]))
        np.testing.assert_allclose(langid.pooled(network, data, offsets)[0], row, atol=1e-5)
    assert network.languages[together[0].argmax()] == "a" and network.languages[together[4].argmax()] == "x"


def test_training_depends_on_the_examples_alone():
    texts, labels = [b"abcabc", b"xyzxyz", b"abab"], ["a", "x", "a"]
    one, two = langid.train(texts, labels, epochs=2), langid.train(texts[::-1], labels[::-1], epochs=2)
    assert all((a == b).all() for a, b in zip(one.forwards, two.forwards, strict=True))
    one, two = quality.train(texts, [0, 1, 0], epochs=2), quality.train(texts[::-1], [0, 1, 0], epochs=2)
    assert all((a == b).all() for a, b in zip(one, two, strict=True))


def test_attention_sums_to_one():
    model = quality.train([b"good words here " * 60, b"%%% *** " * 90], [1, 0], epochs=3)
    (_, data, offsets), *_ = blocks(pa.array(["good words " * 100, "", "x"]))
    weights, text = quality.attention(model, data, offsets)
    np.testing.assert_allclose(np.bincount(text, weights), 1, atol=1e-5)


def _logistic(x):
    return 1 / (1 + np.exp(-x))


def _plain_states(unit, segment):
    """States of one gated recurrent unit, byte by byte."""
    table, recurrent = unit.table.astype(np.float64), unit.recurrent.astype(np.float64)
    size = recurrent.shape[1]
    state, states = np.zeros(size), []
    for byte in segment:
        given, recalled = table[:, byte], recurrent @ state
        update = _logistic(given[:size] + recalled[:size])
        reset = _logistic(given[size : 2 * size] + recalled[size : 2 * size])
        candidate = np.tanh(given[2 * size :] + reset * recalled[2 * size :])
        state = update * state + (1 - update) * candidate
        states.append(state)
    return states


def _plain_language(network, text):
    """Language and score of a text, read one byte at a time."""
    if not any(unicodedata.category(character).startswith("L") for character in text or ""):
        return "und", 0.0
    raw, found = text.encode(), []
    for begin in range(0, len(raw), langid.SEGMENT):
        segment = raw[begin : begin + langid.SEGMENT]
        ahead = _plain_states(network.forwards, segment)
        back = _plain_states(network.backwards, segment[::-1])[::-1]
        for byte, one, two in zip(segment, ahead, back, strict=True):
            if byte >= 128 or chr(byte).isalpha():
                scores = np.exp(network.output @ np.concatenate([one, two]) + network.offset)
                found.append(scores / scores.sum())
    shares = np.mean(found, 0)
    return network.languages[shares.argmax()], shares.max()


def _plain_quality(model, text):
    """Score of a text, passage by passage and trigram by trigram."""
    raw, model = (text or "").encode(), quality.Model(*(np.asarray(weight, np.float64) for weight in model))
    encodings, raised = [], []
    for begin in range(0, max(len(raw), 1), quality.PASSAGE):
        passage = raw[begin : begin + quality.PASSAGE]
        counts, kinds, size = np.zeros(quality.BUCKETS), np.zeros(7), max(len(passage), 1)
        for k, byte in enumerate(passage, begin):
            character = chr(byte)
            kinds[
                6 if byte > 127 else 0 if character.islower() else 1 if character.isupper() else 2 if character.isdigit()
                else 3 if character == " " else 4 if character.isspace() else 5
            ] += 1
            if k + 2 < len(raw):
                code = ((byte * 0x01000193 ^ raw[k + 1]) * 0x01000193 ^ raw[k + 2]) * 0x9E3779B1 % 2**32
                counts[code * quality.BUCKETS >> 32] += 1
        shares = [*np.sqrt(counts / size), *(kinds / size), (counts > 0).sum() / size, len(passage) / quality.PASSAGE]
        encoding = np.tanh(np.array(shares) @ model.encoder + model.offset)
        encodings.append(encoding)
        raised.append(np.exp((np.tanh(encoding @ model.value) * _logistic(encoding @ model.gate)) @ model.direction))
    return _logistic(np.average(encodings, 0, raised) @ model.output + model.bias)


def test_language_equals_reading_byte_by_byte(spark, awkward):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    network = langid.fit(docs, docs=20)
    both = docs.select("text").union(awkward.filter("length(text) < 50000 OR text IS NULL").select("text"))
    rows = langid.identify(both, network, keep=["text"]).collect()
    assert len(rows) == both.count() and len({row["lang_pred"] for row in rows}) > 3
    for row in rows:
        language, score = _plain_language(network, row["text"])
        assert row["lang_pred"] == language and abs(row["score"] - score) < 1e-4


def test_quality_equals_scoring_passage_by_passage(spark, awkward):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{TESTDATA}/sf0.001/labels.parquet"))
    both = docs.select("text").union(awkward.select("text"))
    rows = quality.assess(both, model, keep=["text"]).collect()
    assert len(rows) == both.count() and np.ptp([row["score"] for row in rows]) > 0.3
    for row in rows:
        score = _plain_quality(model, row["text"])
        assert abs(row["score"] - score) < 1e-3
        assert row["predicted"] == (score >= quality.CUTOFF) or abs(score - quality.CUTOFF) < 1e-3


def test_held_out_language(spark):
    rows = Q.op1_language_id(spark, f"{TESTDATA}/sf0.01").collect()
    langs = dict(spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "lang").collect())
    held = [row for row in rows if row["held_out"]]
    assert len(rows) == 1000 and 200 < len(held) < 300
    assert np.mean([row["lang_pred"] == langs[row["doc_id"]] for row in held]) > 0.98


def test_held_out_quality(spark):
    rows = Q.op5_quality_classifier(spark, f"{TESTDATA}/sf0.1").collect()
    known = dict(spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet").select("doc_id", "quality").collect())
    held = [(row["score"], known[row["doc_id"]], row["predicted"]) for row in rows if row["held_out"] and row["doc_id"] in known]
    good, bad = ([score for score, label, _ in held if label == k] for k in (1, 0))
    above = np.mean([a > b for a in good for b in bad])
    assert above > 0.98 and np.mean([label == predicted for _, label, predicted in held]) > 0.97

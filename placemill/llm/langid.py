"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read each segment of a text, one forwards and one backwards; at every byte their states give a
probability for each language. A text's probabilities are the mean over all its bytes that are no white space or ASCII
punctuation. The network is trained here, by backpropagation through time.
"""

from __future__ import annotations

import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.texts import Scorer, add_text_columns, segments

#: Units of each direction.
HIDDEN = 8
#: Bytes that are read without a break. A longer text is read in segments of this length, each from a fresh state.
SEGMENT = 128
#: Segments that are read side by side.
WIDTH = 1024
#: Training sample: so many documents of each language at most, and of each a stretch of so many bytes.
SAMPLE_DOCS = 400
SAMPLE_BYTES = 256
#: Languages that are learned: those with the most documents.
LANGUAGES = 500
EPOCHS = 14
BATCH = 64
UNKNOWN = "und"
#: Label of text in no learned language, for networks that learn it. A noncharacter, which names no language.
OUTSIDE = "\uffff"
#: So many bytes of letters a text needs in no learned language, beyond those in one, to be taken for such. With 32, short
#: clean documents went whose letters are mostly those of keys and addresses.
EVIDENCE = 128

_PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def _pooled_bytes() -> np.ndarray:
    counted = np.ones(256, np.float32)
    for byte in range(128):
        if not chr(byte).isalpha():
            counted[byte] = 0
    return counted


_COUNTED = _pooled_bytes()


class Direction(NamedTuple):
    """One gated recurrent unit: ``table[:, byte]`` is the byte's input to update gate, reset gate and candidate."""

    table: np.ndarray
    recurrent: np.ndarray


class Network(NamedTuple):
    forwards: Direction
    backwards: Direction
    output: np.ndarray
    offset: np.ndarray
    languages: tuple[str, ...]


# Arrays over time are (step, unit, row): rows of a unit lie together.


def _states(unit: Direction, bytes_at: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """States after each step, and what backpropagation needs. ``bytes_at`` is (step, row)."""
    size = unit.recurrent.shape[1]
    state = np.zeros((size, bytes_at.shape[1]), np.float32)
    states, tape = [], []
    for row in bytes_at:
        given = unit.table[:, row]
        recalled = unit.recurrent @ state
        gates = 0.5 * np.tanh(0.5 * (given[: 2 * size] + recalled[: 2 * size])) + np.float32(0.5)
        memory = recalled[2 * size :]
        candidate = np.tanh(given[2 * size :] + gates[size:] * memory)
        tape.append((state, gates, memory, candidate))
        state = candidate + gates[:size] * (state - candidate)
        states.append(state)
    return np.stack(states), tape


def _run(unit: Direction, bytes_at: np.ndarray, states: np.ndarray) -> None:
    """As ``_states``, without the tape and with buffers that are used again at every step."""
    size = unit.recurrent.shape[1]
    table, recurrent = unit.table.copy(), unit.recurrent.copy()
    table[: 2 * size] *= 0.5
    recurrent[: 2 * size] *= 0.5
    rows = bytes_at.shape[1]
    given, recalled = np.empty((3 * size, rows), np.float32), np.empty((3 * size, rows), np.float32)
    gates, candidate = np.empty((2 * size, rows), np.float32), np.empty((size, rows), np.float32)
    before = np.zeros((size, rows), np.float32)
    for step, row in enumerate(bytes_at):
        np.take(table, row, axis=1, out=given, mode="clip")
        np.matmul(recurrent, before, out=recalled)
        np.add(given[: 2 * size], recalled[: 2 * size], out=gates)
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(gates[size:], recalled[2 * size :], out=candidate)
        candidate += given[2 * size :]
        np.tanh(candidate, out=candidate)
        state = states[step]
        np.subtract(before, candidate, out=state)
        state *= gates[:size]
        state += candidate
        before = state


def _probabilities(scores: np.ndarray) -> np.ndarray:
    """Of the languages, which are the second axis; in place."""
    scores -= scores.max(1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(1, keepdims=True)
    return scores


def _reversed(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Index of the byte that a backward reading of each segment has at each step; (step, row)."""
    step = np.arange(rows.shape[0])[:, None]
    return np.where(step < lengths, lengths - 1 - step, step)


def position_probabilities(network: Network, bytes_at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities of the languages at every byte (step, language, row); behind a segment's end they mean nothing."""
    size = network.forwards.recurrent.shape[1]
    states = np.empty((bytes_at.shape[0], size, bytes_at.shape[1]), np.float32)
    _run(network.forwards, bytes_at, states)
    scores = network.output[:, :size] @ states
    back = _reversed(bytes_at, lengths)
    _run(network.backwards, np.take_along_axis(bytes_at, back, 0), states)
    scores += np.take_along_axis(network.output[:, size:] @ states, back[:, None, :], 0)
    scores += network.offset[:, None]
    return _probabilities(scores)


def summed(network: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sums of the languages' probabilities over the bytes that count, and how many these are."""
    totals = np.zeros((len(offsets) - 1, len(network.languages)))
    weight = np.zeros(len(offsets) - 1)
    starts, lengths, text = segments(offsets, SEGMENT)
    # Segments of like length side by side, so that little padding is read.
    order = np.argsort(-lengths, kind="stable")
    for first in range(0, len(order), WIDTH):
        chosen = order[first : first + WIDTH]
        steps, size = int(lengths[chosen[0]]), lengths[chosen]
        step = np.arange(steps)[:, None]
        inside = step < size
        bytes_at = np.where(inside, data[np.minimum(starts[chosen] + step, len(data) - 1)], 0)
        probabilities = position_probabilities(network, bytes_at, size)
        counted = _COUNTED[bytes_at] * inside
        sums = np.einsum("slr,sr->rl", probabilities, counted)
        np.add.at(totals, text[chosen], sums)
        np.add.at(weight, text[chosen], counted.sum(0))
    return totals, weight


def pooled(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probabilities of the languages for each text; zero where no byte counts."""
    totals, weight = summed(network, data, offsets)
    return totals / np.maximum(weight, 1)[:, None]


def train(texts: list[bytes], labels: list[str], *, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Fit the network to stretches of text by backpropagation through time (Adam, cross-entropy at every byte).

    Every language weighs the same. The result depends on the multiset of examples and ``seed`` alone.
    """
    examples = sorted(zip(texts, labels, strict=True))
    languages = tuple(sorted(set(labels)))
    rng = np.random.default_rng(seed)

    def unit() -> list[np.ndarray]:
        recurrent = np.concatenate([np.linalg.qr(rng.normal(size=(hidden, hidden)))[0] for _ in range(3)])
        return [rng.normal(0, 0.3, (3 * hidden, 256)), recurrent]

    weights = [*unit(), *unit(), rng.normal(0, 0.3, (len(languages), 2 * hidden)), np.zeros(len(languages))]
    weights = [w.astype(np.float32) for w in weights]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    data = np.frombuffer(b"".join(text for text, _ in examples), np.uint8)
    starts, lengths, owner = segments(np.cumsum([0, *(len(text) for text, _ in examples)]), SEGMENT)
    known = np.array([languages.index(label) for _, label in examples], np.int64)[owner]
    share = np.bincount(known, weights=lengths, minlength=len(languages))
    balance = (share.sum() / len(languages) / np.maximum(share, 1)).astype(np.float32)
    taken, batches = 0, -(-len(starts) // BATCH)
    for _ in range(epochs):
        shuffled = rng.permutation(len(starts))
        for first in range(0, len(shuffled), BATCH):
            chosen = shuffled[first : first + BATCH]
            taken += 1
            size, steps = lengths[chosen], int(lengths[chosen].max())
            step = np.arange(steps)[:, None]
            inside = step < size
            bytes_at = np.where(inside, data[np.minimum(starts[chosen] + step, len(data) - 1)], 0)
            slopes = _slopes(weights, bytes_at, size, known[chosen], _COUNTED[bytes_at] * inside, balance)
            norm = np.sqrt(sum(float((slope**2).sum()) for slope in slopes))
            rate = 0.012 * (1 - taken / (epochs * batches + 1))
            for w, slope, (mean, square) in zip(weights, slopes, moments, strict=True):
                slope = slope * min(1.0, 1.0 / max(norm, 1e-9))
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                w -= rate * (mean / (1 - 0.9**taken)) / (np.sqrt(square / (1 - 0.99**taken)) + 1e-8)
    return Network(Direction(*weights[:2]), Direction(*weights[2:4]), weights[4], weights[5], languages)


def _slopes(
    weights: list[np.ndarray],
    bytes_at: np.ndarray,
    lengths: np.ndarray,
    known: np.ndarray,
    counted: np.ndarray,
    balance: np.ndarray,
) -> list[np.ndarray]:
    """Derivatives of the mean loss by all weights."""
    forwards, backwards, (output, offset) = Direction(*weights[:2]), Direction(*weights[2:4]), weights[4:]
    hidden = forwards.recurrent.shape[1]
    back = _reversed(bytes_at, lengths)
    turned = np.take_along_axis(bytes_at, back, 0)
    ahead, ahead_tape = _states(forwards, bytes_at)
    behind, behind_tape = _states(backwards, turned)
    # The turned order is its own inverse.
    both = np.concatenate([ahead, np.take_along_axis(behind, back[:, None, :], 0)], 1)
    error = _probabilities(output @ both + offset[:, None])
    error[:, known, np.arange(len(known))] -= 1
    error *= (counted * balance[known] / max(counted.sum(), 1))[:, None, :]
    into = output.T @ error
    return [
        *_backwards(forwards, bytes_at, ahead_tape, into[:, :hidden]),
        *_backwards(backwards, turned, behind_tape, np.take_along_axis(into[:, hidden:], back[:, None, :], 0)),
        np.tensordot(error, both, ((0, 2), (0, 2))),
        error.sum((0, 2)),
    ]


def _backwards(unit: Direction, bytes_at: np.ndarray, tape: list[tuple], into: np.ndarray) -> list[np.ndarray]:
    """Derivatives by a unit's table and recurrent weights, from those by its states."""
    size = unit.recurrent.shape[1]
    recurrent = np.zeros_like(unit.recurrent)
    given = np.empty((len(tape), 3 * size, bytes_at.shape[1]), np.float32)
    carried = np.zeros_like(into[0])
    for step in range(len(tape) - 1, -1, -1):
        state, gates, memory, candidate = tape[step]
        update, reset = gates[:size], gates[size:]
        slope = into[step] + carried
        inner = slope * (1 - update) * (1 - candidate**2)
        given[step, :size] = slope * (state - candidate) * update * (1 - update)
        given[step, size : 2 * size] = inner * memory * reset * (1 - reset)
        given[step, 2 * size :] = inner
        recalled = given[step].copy()
        recalled[2 * size :] *= reset
        recurrent += recalled @ state.T
        carried = slope * update + unit.recurrent.T @ recalled
    places = bytes_at.ravel()
    table = [np.bincount(places, given[:, k].ravel(), 256) for k in range(3 * size)]
    return [np.array(table, np.float32), recurrent]


def sample(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", docs: int = SAMPLE_DOCS, size: int = SAMPLE_BYTES
) -> DataFrame:
    """At most ``docs`` documents of each language and of each a stretch of ``size`` bytes: rows (part, lang).

    Which documents and where in them the stretch lies follow from hashes of the text, so a rerun takes the same. Rare
    languages are taken whole, but only the LANGUAGES most frequent ones. Only stretches of about twice as many documents as
    are taken are shuffled.
    """
    drawn = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / F.lit(1 << 30)
    known = labelled.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = known.groupBy(F.col(lang).alias("__lang")).agg(F.count(F.lit(1)).alias("__docs"))
    top = counts.orderBy(F.desc("__docs"), "__lang").limit(LANGUAGES)
    raw = F.encode(F.col(text), "utf-8")
    place = F.pmod(F.xxhash64(F.col(text), F.lit(1)), F.greatest(F.octet_length(raw) - size, F.lit(0)) + 1)
    likely = known.join(F.broadcast(top), F.col(lang) == F.col("__lang")).filter(drawn * F.col("__docs") < 2 * docs)
    stretches = likely.select(
        raw.substr((place + 1).cast("int"), F.lit(size)).alias("part"), F.col(lang).alias("lang"), drawn.alias("drawn")
    ).distinct()  # copies of a text count once
    ranked = Window.partitionBy("lang").orderBy("drawn", "part")
    return stretches.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= docs).select("part", "lang")


def outside_texts(count: int, size: int = SAMPLE_BYTES, *, seed: int = 1) -> list[bytes]:
    """Text in no language: words of letters that are drawn evenly, half from ASCII, half from one of Unicode's scripts each."""
    scripts: dict[str, list[str]] = {}
    for char in map(chr, range(128, 1 << 16)):
        if unicodedata.category(char)[0] == "L":
            scripts.setdefault(unicodedata.name(char, "").split(" ")[0], []).append(char)
    rng = np.random.default_rng(seed)
    ascii_letters = [chr(byte) for byte in range(128) if chr(byte).isalpha()]
    plain = [ascii_letters[26:], ascii_letters, [*ascii_letters, *"0123456789+/"], list("0123456789abcdef")]
    others = [scripts[name] for name in sorted(scripts)]
    texts = []
    for number in range(count):
        kinds = (plain, others)[number % 2]
        letters = kinds[rng.integers(len(kinds))]
        # Some texts have short words, some hardly any space.
        spaced = rng.random(size) < 1 / rng.integers(3, 80)
        drawn = rng.integers(len(letters), size=size)
        texts.append("".join(" " if gap else letters[k] for gap, k in zip(spaced, drawn, strict=True)).encode()[:size])
    return texts


def fit(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", outside: bool = False, **options
) -> Network | None:
    """A network fitted to a bounded sample of the labelled documents; None if there are none.

    If ``outside``, it also learns to tell text in no language, from as many examples as a language has at most.
    """
    rows = sample(labelled, text=text, lang=lang, **options).collect()
    parts, labels = [bytes(row["part"]) for row in rows], [row["lang"] for row in rows]
    if rows and outside:
        strange = outside_texts(max(map(labels.count, set(labels))))
        parts, labels = [*parts, *strange], [*labels, *[OUTSIDE] * len(strange)]
    return train(parts, labels) if rows else None


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predict(network: Network | None) -> Scorer:
    def score(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        if network is None:
            nothing = len(offsets) - 1
            return [pa.array([UNKNOWN] * nothing, pa.string()), pa.array([0.0] * nothing, pa.float64())]
        totals, weight = summed(network, data, offsets)
        strange = np.zeros(len(weight), bool)
        if OUTSIDE in network.languages:
            place = network.languages.index(OUTSIDE)
            strange = 2 * totals[:, place] > weight + EVIDENCE
            totals[:, place] = -1
        shares = totals / np.maximum(weight, 1)[:, None]
        best = shares.argmax(1)
        names = [UNKNOWN if far else network.languages[k] for k, far in zip(best, strange, strict=True)]
        scores = np.where(strange, 0, np.clip(shares[np.arange(len(best)), best], 0, 1))
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return score


def identify(docs: DataFrame, network: Network | None, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (its probability) to each row, read from the whole text and nothing else.

    A text that is null or has no letter gets ``und`` and 0.0, as do all texts without a network, and those that a network
    fitted with ``outside`` finds to be mostly in no learned language, by EVIDENCE bytes at least: one in several learned
    languages is in some all along, and a few letters prove nothing. Input columns of these names are replaced. Nothing is
    shuffled; memory is bounded by a block of text, or by the longest text.
    """
    columns = [name for name in (docs.columns if keep is None else keep) if name.lower() not in ("lang_pred", "score")]
    marked = docs.withColumn("__lettered", has_letter(F.col(text)))
    weights = docs.sparkSession.sparkContext.broadcast(network)
    read = add_text_columns(
        marked, _PREDICTED, lambda: _predict(weights.value), text=text, keep=[*columns, "__lettered"]
    )
    return read.select(
        *[F.col(f"`{name}`") for name in columns],
        F.when(F.col("__lettered"), F.col("lang_pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("__lettered"), F.col("score")).otherwise(F.lit(0.0)).alias("score"),
    )


def keep_identified(docs: DataFrame, network: Network | None, *, min_score: float = 0.0) -> DataFrame:
    """The documents whose language is known with at least ``min_score``, with all their columns as they are.

    Only a network fitted with ``outside`` tells documents with letters in no learned language, which go as well.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("__doc")
    judged = identify(docs.select(row, "text"), network, keep=["__doc"])
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
    return judged.filter(kept).select("__doc.*")

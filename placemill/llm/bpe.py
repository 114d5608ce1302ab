"""Byte-level BPE through a tokenization automaton.

Merges are compiled one after another into a deterministic automaton over tokens that accepts just the tokenizations BPE
makes. It starts as one state with an arc for every byte. The merge gadget of rule i, (u, v) -> w, takes the state that
arcs labelled u lead to, and

* lets these arcs lead to a copy of that state without its arc v, and
* gives every state that has an arc u an arc w, which leads to where v led.

So all arcs of a token lead to one state, and a state is the state before it less one arc: the automaton is kept as one
table of removed arcs, (u, v) -> i. A token t may follow x unless a removal (a, b) with a at the right edge of x and b at
the left edge of t happened while a was the last of the tokens at that edge and b the first: see ``Automaton.follows``.
A word has one path; encoding finds it by table lookups, decoding writes out the bytes of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.llm.shipping import ship_package

#: Pieces into which text is cut before encoding (fixed value of byte-level tokenizers); ``newer`` are code points to
#: be taken for neither letters nor numbers.
PIECES = (
    r"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}{newer}]+| ?[\p{{N}}{newer}]+|"
    r" ?[^\s[\p{{L}}\p{{N}}{newer}]]+|\s+(?!\S)|\s+"
)
#: Code points not assigned up to Unicode 16, the version of the tokenizers library, that newer versions
#: of the regex module take for letters or numbers.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
#: Words and answers that a task remembers at a time.
REMEMBERED = 500_000


class Automaton(NamedTuple):
    """Token bytes by id; ids by bytes; and for ids: the rule that made them (-1: none), their left and right parts."""

    labels: dict[int, bytes]
    tokens: dict[bytes, int]
    born: dict[int, int]
    parts: dict[int, tuple[int, int]]
    removed: dict[tuple[int, int], int]
    longest: int
    special: dict[str, int]

    def follows(self, x: int, t: int) -> bool:
        """Whether the state behind token ``x`` has an arc ``t``."""
        until, a = math.inf, x
        while True:
            # Arcs of b are copied from its left part's; before b was made, removals concern that part.
            above, b = math.inf, t
            while True:
                rule = self.removed.get((a, b))
                if rule is not None and rule < until and self.born[b] < rule <= above:
                    return False
                if b not in self.parts:
                    break
                above, b = self.born[b], self.parts[b][0]
            if a not in self.parts:
                return True
            # The state behind a is, up to a's making, the state behind its right part.
            until, a = self.born[a], self.parts[a][1]


def compile_merges(vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]) -> Automaton:
    """The automaton of a list of merges, by one merge gadget after another."""
    labels = {number: token for token, number in vocabulary.items()}
    tokens = {bytes([byte]): vocabulary[bytes([byte])] for byte in range(256)}
    automaton = Automaton(labels, tokens, dict.fromkeys(tokens.values(), -1), {}, {}, max(map(len, labels.values())), special)
    for rule, (left, right) in enumerate(merges):
        u, v, w = tokens.get(left), tokens.get(right), vocabulary[left + right]
        # A part that is never made, or an arc that is already gone: the merge never happens.
        if u is None or v is None or left + right in tokens or not automaton.follows(u, v):
            continue
        automaton.removed[u, v] = rule
        automaton.born[w], automaton.parts[w] = rule, (u, v)
        tokens[left + right] = w
    return automaton


def _ranges() -> str:
    """``NEWER`` in a pattern's notation."""
    bounds = ([int(code, 16) for code in part.split("-")] for part in NEWER.split())
    return "".join("-".join(f"\\U{code:08X}" for code in sorted({part[0], part[-1]})) for part in bounds)


def _byte_characters() -> dict[str, int]:
    """Characters that stand for bytes in vocabulary files: themselves where printable, else 256 and following."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + k): byte for k, byte in enumerate(rest)}


@lru_cache(maxsize=2)
def load(path: str) -> Automaton:
    """The automaton of a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    to_byte = _byte_characters()
    as_bytes = lambda token: bytes(to_byte[char] for char in token)
    special = {added["content"]: added["id"] for added in stored["added_tokens"]}
    vocabulary = {as_bytes(token): number for token, number in stored["model"]["vocab"].items() if token not in special}
    pairs = (pair.split(" ") if isinstance(pair, str) else pair for pair in stored["model"]["merges"])
    return compile_merges(vocabulary, [(as_bytes(left), as_bytes(right)) for left, right in pairs], special)


class Coder:
    """Encodes and decodes with an automaton; remembers words and transitions it has seen."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.find_latin = regex.compile(PIECES.format(newer="")).findall
        self.find_any = regex.compile(PIECES.format(newer=f"--[{_ranges()}]")).findall
        self.words: dict[str, str] = {}
        self.sizes: dict[str, int] = {}
        self.table: dict[tuple[int, int], bool] = {}
        self.labels = {str(number): token for number, token in automaton.labels.items()}
        self.labels |= {str(number): content.encode() for content, number in automaton.special.items()}
        contents = sorted(automaton.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, contents)) + ")") if contents else None

    def path(self, word: bytes) -> list[int]:
        """The one path of the automaton that spells ``word``: the longest arc first, back from dead ends."""
        tokens, table, longest = self.automaton.tokens, self.table, self.automaton.longest
        if (whole := tokens.get(word)) is not None:
            return [whole]
        size, place, length = len(word), 0, min(longest, len(word))
        taken: list[int] = []
        dead: set[int] = set()
        while place < size:
            last = taken[-1] if taken else None
            while length:
                token = tokens.get(word[place : place + length])
                if token is not None and place + length not in dead:
                    if last is None:
                        break
                    follows = table.get((last, token))
                    if follows is None:
                        follows = table[last, token] = self.automaton.follows(last, token)
                    if follows:
                        break
                length -= 1
            if length:
                taken.append(token)
                place += length
                length = min(longest, size - place)
            else:
                # The prefix up to here has just this path, so no other way through this place remains.
                dead.add(place)
                length = len(self.automaton.labels[taken.pop()])
                place -= length
                length -= 1
        return taken

    def _new_word(self, word: str) -> str:
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        if len(self.table) >= REMEMBERED:
            self.table.clear()
        known = ",".join(map(str, self.path(word.encode())))
        if len(word) <= 64:
            self.words[word] = known
        return known

    def find(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find_any(text)
        return self.find_latin(text)

    def encode(self, text: str) -> str:
        """Decimal ids joined by commas."""
        known, new = self.words.get, self._new_word
        if not self.cut or not self.cut.search(text):
            return ",".join([known(word) or new(word) for word in self.find(text)])
        ids = []
        for piece in self.cut.split(text):
            if piece in self.automaton.special:
                ids.append(str(self.automaton.special[piece]))
            elif piece:
                ids += [known(word) or new(word) for word in self.find(piece)]
        return ",".join(ids)

    def count(self, text: str) -> int:
        """Number of ids, without writing them down."""
        if not self.cut or not self.cut.search(text):
            return self._count_words(text)
        pieces = [piece for piece in self.cut.split(text) if piece]
        return sum(1 if piece in self.automaton.special else self._count_words(piece) for piece in pieces)

    def _count_words(self, text: str) -> int:
        sizes, total = self.sizes, 0
        for word, often in Counter(self.find(text)).items():
            if (size := sizes.get(word)) is None:
                if len(sizes) >= REMEMBERED:
                    sizes.clear()
                if len(self.table) >= REMEMBERED:
                    self.table.clear()
                size = len(self.path(word.encode()))
                if len(word) <= 64:
                    sizes[word] = size
            total += often * size
        return total

    def decode(self, ids: str) -> str:
        return b"".join(map(self.labels.__getitem__, ids.split(",") if ids else ())).decode("utf-8", "replace")


def _map_rows(df: DataFrame, columns: list[str], source: str, automaton: Automaton, outputs: T.StructType, work) -> DataFrame:
    """``columns`` of ``df`` and what ``work(coder, value)`` gives for each value of ``source``, a row of ``outputs``."""
    ship_package(df.sparkSession)
    row = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("__row")
    chosen = df.select(row, F.col(source).alias("__source"))
    shared = df.sparkSession.sparkContext.broadcast(automaton)
    names = ["__row", *(field.name for field in outputs)]
    kinds = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() if isinstance(f.dataType, T.LongType)
             else pa.list_(pa.int32()) for f in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or _coder(shared.value)
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                made = [work(coder, value.as_py()) for value in part.column(1)]
                arrays = [pa.array(values, kind) for values, kind in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=names)

    schema = T.StructType([T.StructField("__row", chosen.schema["__row"].dataType), *outputs])
    return chosen.mapInArrow(run, schema).select("__row.*", *names[1:])


_coders: dict[int, Coder] = {}


def _coder(automaton: Automaton) -> Coder:
    """One for each automaton and Python worker, which serves several tasks."""
    if id(automaton) not in _coders:
        _coders.clear()
        _coders[id(automaton)] = Coder(automaton)
    return _coders[id(automaton)]


_IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
_DECODED = T.StructType([T.StructField("decoded", T.StringType())])
_DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _others(df: DataFrame, outputs: T.StructType, keep: list[str] | None) -> list[str]:
    made = {field.name.lower() for field in outputs}
    return [name for name in (df.columns if keep is None else keep) if name.lower() not in made]


def encode(docs: DataFrame, automaton: Automaton, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids``, the token ids of the whole text. Null is empty, with no ids. A column ``ids`` is replaced."""

    def work(coder: Coder, value: str | None) -> tuple:
        ids = coder.encode(value or "")
        return ([int(number) for number in ids.split(",")] if ids else [],)

    return _map_rows(docs, _others(docs, _IDS, keep), text, automaton, _IDS, work)


def decode(docs: DataFrame, automaton: Automaton, *, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded``, the text that the ids spell. Null ids are none; bytes that are no UTF-8 become U+FFFD."""

    def work(coder: Coder, value: list[int] | None) -> tuple:
        return (coder.decode(",".join(map(str, value or []))),)

    return _map_rows(docs, _others(docs, _DECODED, keep), ids, automaton, _DECODED, work)


def _digests(coder: Coder, ids: str) -> tuple:
    """``ids`` go through the decoder, so the digest of a faulty path differs from the text's."""
    decoded = coder.decode(ids)
    count = ids.count(",") + 1 if ids else 0
    return count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def token_digests(docs: DataFrame, automaton: Automaton, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256`` (of the decoded text).

    Encodes and decodes the whole text in one pass, without writing the ids out. Null is empty. Input columns of these
    names are replaced. Nothing is shuffled; a task remembers a bounded number of words.
    """

    def work(coder: Coder, value: str | None) -> tuple:
        return _digests(coder, coder.encode(value or ""))

    return _map_rows(docs, _others(docs, _DIGESTS, keep), text, automaton, _DIGESTS, work)


def count_tokens(docs: DataFrame, automaton: Automaton, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_tokens``, the number of ids of the whole text, and 0 for null. A column ``n_tokens`` is replaced."""
    outputs = T.StructType([T.StructField("n_tokens", T.LongType())])

    def work(coder: Coder, value: str | None) -> tuple:
        return (coder.count(value) if value else 0,)

    return _map_rows(docs, _others(docs, outputs, keep), text, automaton, outputs, work)


def encode_with_digests(docs: DataFrame, automaton: Automaton, *, text: str = "text", keep: list[str]) -> DataFrame:
    """``token_digests`` and the ids themselves."""
    outputs = T.StructType([*_DIGESTS, *_IDS])

    def work(coder: Coder, value: str | None) -> tuple:
        ids = coder.encode(value or "")
        return (*_digests(coder, ids), [int(number) for number in ids.split(",")] if ids else [])

    return _map_rows(docs, _others(docs, outputs, keep), text, automaton, outputs, work)

import itertools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from placemill.llm import bpe

from ..conftest import TESTDATA


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def coder(path):
    return bpe.Coder(bpe.load(path))


def _plain(word, merges):
    """BPE by its definition: the first merge that applies, at its leftmost places, until none does."""
    parts = [bytes([byte]) for byte in word]
    while True:
        pairs = list(itertools.pairwise(parts))
        rule = next((merge for merge in merges if merge in pairs), None)
        if rule is None:
            return parts
        out, k = [], 0
        while k < len(parts):
            if tuple(parts[k : k + 2]) == rule:
                out.append(parts[k] + parts[k + 1])
                k += 2
            else:
                out.append(parts[k])
                k += 1
        parts = out


@pytest.mark.parametrize("seed", range(25))
def test_small_automata_accept_just_what_bpe_makes(seed):
    rng = random.Random(seed)
    known, merges = [b"a", b"b", b"c"], []
    while len(merges) < 9:
        pair = (rng.choice(known), rng.choice(known))
        if pair not in merges and pair[0] + pair[1] not in known:
            merges.append(pair)
            known.append(pair[0] + pair[1])
    vocabulary = {bytes([byte]): byte for byte in range(256)} | {b"".join(p): 256 + k for k, p in enumerate(merges)}
    automaton = bpe.compile_merges(vocabulary, merges, {})
    coder = bpe.Coder(automaton)
    for size in range(1, 8):
        for letters in itertools.product(b"abc", repeat=size):
            word = bytes(letters)
            path = coder.path(word)
            assert [automaton.labels[token] for token in path] == _plain(word, merges)


def test_pieces_agree_for_every_code_point(tokenizer, coder):
    for code in itertools.chain(range(0xD800), range(0xE000, 0x110000, 7), range(0x10000, 0x20000)):
        text = f"x{chr(code)}x1{chr(code)}1 {chr(code)} "
        assert len(tokenizer.pre_tokenizer.pre_tokenize_str(text)) == len(coder.find(text)), hex(code)


def test_random_texts(tokenizer, coder):
    rng = random.Random(7)
    pool = ["the", " ", "  ", "\n", "'s", "'ll", "<|endoftext|>", "é", "日本", "🎉", "\t", "a" * 90, "123", "...", "\xa0", "²"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) if rng.random() < 0.6 else chr(rng.randrange(0x20, 0x800)) for _ in range(rng.randrange(14)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ",".join(map(str, ids))
        assert coder.decode(coder.encode(text)) == tokenizer.decode(ids, skip_special_tokens=False)


def test_whole_documents(spark, tokenizer, path):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text", "source")
    encoded = bpe.encode(docs, bpe.load(path))
    rows = bpe.decode(encoded, bpe.load(path)).collect()
    assert encoded.columns == ["doc_id", "text", "source", "ids"] and len(rows) == docs.count()
    for row in rows:
        assert row["ids"] == tokenizer.encode(row["text"], add_special_tokens=False).ids
        assert row["decoded"] == row["text"]


def test_decoding_bytes_that_are_no_text(tokenizer, coder):
    for ids in ([], [94, 95], [50256, 220], [11, 188]):
        assert coder.decode(",".join(map(str, ids))) == tokenizer.decode(ids, skip_special_tokens=False)


def test_a_full_memory_is_emptied(path, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    coder, fresh = bpe.Coder(bpe.load(path)), bpe.Coder(bpe.load(path))
    text = " ".join(f"unusualword{k} thing{k}" for k in range(40))
    monkeypatch.setattr(bpe, "REMEMBERED", 500_000)
    assert coder.encode(text) == fresh.encode(text)

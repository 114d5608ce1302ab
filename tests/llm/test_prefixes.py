import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from placemill.llm import prefixes as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, level string, prior string, t0 string"


def _brute(rows):
    """The trie by walking every rebuilt conversation turn by turn."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    # Turns of equal number lie in any order; the tests give such only to equal turns.
    said = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv in said:
        h = zlib.crc32(str(conv).encode()) % 6
        turns = said.get(conv - conv % 100, [])[:h] + said[conv][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, inside in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(inside) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (min(inside), len(path), min(members[path[:-1]]) if path else -1, len(inside), children[path], leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
        for path, inside in members.items()
    )


def _found(frame):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(tuple(-1 if row[name] is None else row[name] for name in names) for row in frame.select(*names).collect())


def _rows():
    rng = random.Random(3)
    rows = [(0, 1, "a", "x"), (0, 2, None, None), (0, 2, None, None), (0, None, "", "Ünï🎉"), (None, 1, "a", "lost"), (103, 5, "a", "only")]
    rows += [(7, k, "user", str(k)) for k in range(23)]
    for conv in (200, 201, 202, 299, 305, 400, 401):
        rows += [(conv, k, rng.choice("ab"), rng.choice(["", "one", "two"])) for k in range(rng.randrange(1, 12))]
    # Copies of one conversation, which end at one node; their family's first is missing.
    rows += [(conv, k, "user", f"same {k}" * 50) for conv in range(501, 560) for k in range(7)]
    return [(*row, "d", "l", "p", "t") for row in rows]


@pytest.mark.parametrize("widths", [{}, {"first_block": 2, "next_block": 3}])
def test_matches_a_walk(spark, widths):
    rows = _rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _found(P.conversation_trie(frame, **widths)) == _brute(rows)


def test_parts_of_a_digest(spark, monkeypatch):
    monkeypatch.setattr(P, "IDS_EACH", 10)
    rows = _rows()
    assert _found(P.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == _brute(rows)


def test_no_conversations(spark):
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert P.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", "", "", "", "")], SCHEMA)).collect() == []

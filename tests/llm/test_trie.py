"""Operator 13 against a plain trie, and its parentheses against a stack."""

import hashlib
import zlib

import numpy as np
import pytest

from sluice.llm import conversation_trie as trie
from sluice.llm.conversation_trie import ExcessBlocks, conversation_trie, subtree_minima

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows, group=100, turns=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % turns
        path = tuple(own.get(c - c % group, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, d == len(path)))
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        parents = {n[:-1] for n in nodes if n}
        ends = ",".join(map(str, sorted(c for c, e in members if e)))
        out.append((
            min(members)[0], len(node), min(nodes[node[:-1]])[0] if node else None, len(members),
            sum(len(n) == len(node) + 1 for n in below), sum(n not in parents for n in below),
            sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def some_rows(rng):
    """Few texts, so that paths meet; long, short, equal and turnless ones."""
    rows = []
    for c in list(range(0, 260)) + [1000, 5003, 9_000_000_123]:
        for turn in range(int(rng.integers(1, 9))):
            rows.append((c, turn, "user" if turn % 2 else "system", "xyé"[int(rng.integers(0, 2)) :] * int(rng.integers(0, 3))))
    rows += [(700, t, "user", f"t{t % 3}") for t in range(300)] + [(701, t, "user", f"t{t % 3}") for t in range(280)]
    rows += [(c, t, "user", "same") for c in range(20_000, 20_040) for t in (0, 1)]
    rows += [(5, None, None, None), (5, None, "a", "b"), (6, 0, "user", None), (None, 1, "user", "of none"), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("turns, bits", [(1 << 18, 12), (40, 2), (3, 0)])
def test_equals_plain_trie(spark, monkeypatch, turns, bits):
    monkeypatch.setattr(trie, "BLOCK_TURNS", turns)
    monkeypatch.setattr(trie, "ID_BITS", bits)
    rows = some_rows(np.random.default_rng(turns))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr(
        "*", "1 AS k1", "'x' AS a", "'h' AS h", "2 AS depth", "3 AS t", "4 AS `odd.name`").repartition(4)
    # In several tasks and blocks, with one row per worker batch.
    if turns == 40:
        monkeypatch.setattr(trie, "EXCESS_BLOCK", 8)
    assert result(conversation_trie(df)) == plain(rows)


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_find_close_equals_a_stack():
    rng = np.random.default_rng(2)
    for n, block in ((1, 4), (2, 2), (50, 4), (700, 8), (5000, 64), (3000, 2)):
        depth, bits = 0, []
        left = n
        while left or depth:
            if left and (not depth or rng.random() < 0.6):
                bits.append(1)
                left, depth = left - 1, depth + 1
            elif depth > (1 if left else 0) or not left:
                bits.append(0)
                depth -= 1
        bits = np.array(bits, dtype=np.int8)
        stack, want = [], {}
        for i, bit in enumerate(bits):
            if bit:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert ExcessBlocks(bits, block).find_close(opens).tolist() == [want[o] for o in opens]


def test_deep_path_and_minima():
    deep = np.append(np.ones(60_000, dtype=np.int8), np.zeros(60_000, dtype=np.int8))
    assert (ExcessBlocks(deep).find_close(np.arange(60_000)) == 119_999 - np.arange(60_000)).all()
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1000, 300)
    size = np.array([rng.integers(1, 301 - i) for i in range(300)])
    assert subtree_minima(values, size).tolist() == [values[i : i + s].min() for i, s in enumerate(size)]

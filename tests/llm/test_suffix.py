"""Operator 11 against brute force over all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import suffix_dedup
from sluice.llm.queries import LLM_QUERIES
from sluice.llm.suffix_dedup import insert_columns, remove_repeats


def brute(texts, n):
    """(removed bytes, runs, kept) of each text."""
    raws = [(t or "").encode() for t in texts]
    count = Counter(raw[i : i + n] for raw in raws for i in range(len(raw) - n + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 2, dtype=np.int64)
        for i in range(len(raw) - n + 1):
            if count[raw[i : i + n]] > 1:
                gone[i + 1 : i + n + 1] = 1
        runs = int((np.diff(gone) == 1).sum())
        gone = gone[1:-1].astype(bool)
        out.append((int(gone.sum()), runs, bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])))
    return out


def test_columns_order_all_suffixes():
    rng = np.random.default_rng(5)
    for trial in range(60):
        m, width = int(rng.integers(1, 12)), int(rng.integers(1, 25))
        docs = [tuple(rng.integers(1, 4, rng.integers(0, width + 1))) for _ in range(m)]
        docs[0] = tuple(rng.integers(1, 4, width))
        symbols = np.zeros((m, width), dtype=np.uint16)
        for i, d in enumerate(docs):
            symbols[i, width - len(d) :] = d
        document, length, common = insert_columns(symbols, np.array([len(d) for d in docs]))
        suffixes = [docs[d][len(docs[d]) - k :] for d, k in zip(document, length)]
        assert suffixes == sorted(suffixes) and len(suffixes) == sum(len(d) + 1 for d in docs)
        assert len(set(zip(document.tolist(), length.tolist()))) == len(suffixes)
        for (a, b), c in zip(zip(suffixes, suffixes[1:]), common[1:]):
            same = 0
            while same < min(len(a), len(b)) and a[same] == b[same]:
                same += 1
            assert same == c


def texts_with_repeats(rng, n):
    """Shared passages at odd places, near and exact copies, periods, long runs."""
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(k) for k in (n // 4, n // 3, n)]
    texts = [prose(int(rng.integers(0, n))) for _ in range(12)]
    for i in range(40):
        parts = [prose(int(rng.integers(0, 12))), passages[i % 3], prose(int(rng.integers(0, 12)))]
        texts.append("".join(parts) if i % 2 else parts[0] + parts[1][i : i + 2 * n])
    base = prose(n)
    for _ in range(8):
        at = int(rng.integers(0, len(base)))
        texts.append(base[:at] + "X" + base[at + 1 :])
    texts += [base, base, "ab" * (2 * n), "a" * (n + 3), "a" * n, "b" * n, "c" * (n - 1), "c" * (n - 1), "", None, None, "abc " * n]
    return texts


@pytest.mark.parametrize("n, large", [(400, 512), (60, 512), (60, 6), (24, 3), (8, 2), (33, 4)])
def test_equals_brute_force(spark, monkeypatch, n, large):
    monkeypatch.setattr(suffix_dedup, "LARGE_KEY", large)
    texts = texts_with_repeats(np.random.default_rng(n + large), n)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in remove_repeats(docs, n).collect()}
    assert got == dict(enumerate(brute(texts, n)))


def test_anchors_of_slabs(monkeypatch):
    """Windows are covered once each, by anchors that their bytes alone name."""
    raw = np.frombuffer(("a line " * 90 + "x" * 500 + "".join(map(str, range(900)))).encode(), dtype=np.uint8)
    monkeypatch.setattr(suffix_dedup, "SLAB", 200)
    parts = [p for key, *p in suffix_dedup.occurrences(raw, 100)]
    first, number = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    covered = np.concatenate([np.arange(f, f + c) for f, c in zip(first, number)])
    assert sorted(covered.tolist()) == list(range(len(raw) - 99))
    key = {}
    for k, f, c, d in suffix_dedup.occurrences(raw, 100):
        for i in range(len(f)):
            for j in range(c[i]):
                name = (int(k[i]), int(d[i]) - j)
                assert key.setdefault(bytes(raw[f[i] + j : f[i] + j + 100]), name) == name


def test_awkward_rows(spark):
    long = "".join(f"{i:07d}" for i in range(60_000))
    rows = [(1, long), (1, long[:1000]), (None, "zz" + long[500:950]), (2, None), (2, ""), (3, "short"), (3, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'k' AS kept", "'h' AS h1", "'r' AS row", "'s' AS spans", "1 AS key", "2 AS at", "3 AS class", "4 AS `odd.name`")
    out = remove_repeats(docs)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 420_000, 1000, [(0, 1000)]), (1, 1000, 1000, [(0, 1000)]), (None, 452, 450, [(2, 452)]),
        (2, 0, 0, []), (2, 0, 0, []), (3, 5, 0, []), (3, 5, 0, [])], key=repr)
    assert {"odd.name", "h1", "row", "key"} <= set(out.columns) and out.columns.count("kept") == 1
    assert remove_repeats(docs.where("false")).count() == 0


def test_query(spark, sf_small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    want = {i: (len((t or "").encode()), *b[:2], hashlib.sha256(b[2]).hexdigest())
            for (i, t), b in zip(docs.items(), brute(docs.values(), 400))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in LLM_QUERIES["op11_suffix_dedup"](spark, sf_small).collect()}
    assert got == want and any(w[1] for w in want.values())

"""Operators 1, 3 and 10 against brute force and SQL."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import components, embedding_dedup, minhash_dedup
from sluice.llm.embedding_dedup import near_duplicate_vectors
from sluice.llm.minhash_dedup import near_duplicates
from sluice.llm.oracle import LLM_ORACLE
from sluice.llm.queries import LLM_QUERIES

TABLES = ("documents", "embeddings", "conversations")


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    ours, theirs = LLM_QUERIES[name](spark, sf_small).toPandas(), con.sql(LLM_ORACLE[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    ours, theirs = (x[columns].sort_values(columns).reset_index(drop=True) for x in (ours, theirs))
    assert ours.equals(theirs.astype(ours.dtypes))


def brute_components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_near_duplicates_equal_all_pairs(spark):
    """A large near-copy family with members on both sides of the threshold,
    exact copies, chains and unrelated texts."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for base, copies, edits in ((80, 120, 8), (40, 20, 4), (300, 10, 20), (6, 6, 1)):
        words = list(rng.choice(vocabulary, base))
        for _ in range(copies):
            copy = list(words)
            for at in rng.choice(base, rng.integers(0, edits + 1), replace=False):
                copy[at] = str(rng.choice(vocabulary))
            texts.append(" ".join(copy))
    chain = list(rng.choice(vocabulary, 60))
    for i in range(15):
        texts.append(" ".join(chain[i : i + 45]).upper())
    texts += texts[:40] + [" ".join(rng.choice(vocabulary, 50)) for _ in range(60)] + ["", "one", "One"]
    ids = [int(i) for i in rng.permutation(len(texts))]
    sets = {}
    for i, text in zip(ids, texts):
        words = text.lower().split()
        width = min(4, len(words))
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()
    linked = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = brute_components(ids, linked)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
    got = near_duplicates(docs, n_words=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31), max_size=minhash_dedup.GUARANTEED_DISTANCE), st.integers(0, 1 << 32))
def test_keys_meet_up_to_the_guaranteed_distance(changed, seed):
    rng = np.random.default_rng(seed)
    one = rng.integers(0, 1 << 16, 32, dtype=np.uint64)
    other = one.copy()
    other[list(set(changed))] ^= np.uint64(1)
    assert set(minhash_dedup.chunk_keys(one)) & set(minhash_dedup.chunk_keys(other))


def test_connected_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (500, 300), (300, 500)]
    links += [(None, 3), (4, None)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 500: 300}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_embeddings_equal_all_pairs(spark):
    """Many small blocks, families around the threshold, copies and scaled copies."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    vectors = np.concatenate([c + rng.normal(scale=0.27, size=(25, 24)) for c in centres] + [rng.normal(size=(60, 24))])
    vectors = np.concatenate([vectors, vectors[:20], 3 * vectors[20:40]]).astype(np.float32)
    ids, labels = rng.permutation(len(vectors)), rng.integers(0, 3, len(vectors))
    data = [(int(i), v.tolist(), int(k)) for i, v, k in zip(ids, vectors, labels)]
    exact = vectors.astype(np.float64)
    norm = np.linalg.norm(exact, axis=1)
    near = (exact @ exact.T / norm[:, None] / norm >= 0.93) & (labels[:, None] == labels) & ~np.eye(len(ids), dtype=bool)
    linked = [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near)) if ids[a] < ids[b]]
    want = brute_components([int(i) for i in ids], linked)
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = near_duplicate_vectors(frame, block=30).collect()
    assert {r["vec_id"]: r["component_id"] for r in got} == want
    assert {r["vec_id"]: r["n_links"] for r in got} == {int(i): int(n) for i, n in zip(ids, near.sum(axis=1))}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 32), st.sampled_from([2, 16, 64, 1100]), st.floats(0.1, 0.99))
def test_quantised_products_miss_no_pair(seed, dim, threshold):
    rng = np.random.default_rng(seed)
    x = embedding_dedup.unit_rows(rng.normal(size=(40, dim)) ** 3 + 0.01)
    y = embedding_dedup.unit_rows(x + rng.normal(scale=0.3 / dim**0.5, size=x.shape))
    i, j = embedding_dedup.possible_pairs(x, y, threshold)
    assert set(zip(*np.nonzero(x @ y.T >= threshold))) <= set(zip(i, j))

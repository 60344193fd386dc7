"""Operator 3: near-duplicate documents by a multi-index Hamming join.

A document's shingle set gets a signature of 32 min-hashes of 16 bits. By
pigeonhole, two signatures that differ in at most 15 of the 32 positions
differ in at most one position of at least one of the 8 chunks of four. The
one allowed error of a chunk is enumerated by leaving out each position in
turn, so such a pair shares at least one of 8 x 4 exact keys and can't be
missed. At a similarity of 0.8 each chunk has at most one error with
probability 0.82, so a pair escapes all of them once in a million. Candidate
pairs are confirmed on their full sets.

Documents of equal sets meet once, as a class. Within a group that shares a
key, pairs are not emitted: members are first compared with the smallest one,
and only what is then still apart is compared in full, large groups in tiles
of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import connected_components, local_components
from sluice.llm.store import col, free, stage

CHUNKS, CHUNK = 8, 4
HASHES = CHUNKS * CHUNK
#: Pairs that differ in at most so many positions are always compared.
GUARANTEED_DISTANCE = CHUNKS * 2 - 1
#: Members from which on a group's remaining comparisons are tiles, not pairs.
LARGE_GROUP = 16
#: Shingles in a block of such a group, about, and what a set counts as at least,
#: so that a block has at most a thousand sets.
TILE_SHINGLES, LEAST_WEIGHT = 200_000, 200
#: Distinct words a task remembers the hashes of.
REMEMBERED_WORDS = 1 << 17

_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, n_words: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n_words``-word shingles.

    A-Z is lower-cased and words are what ASCII white space separates, as
    ``bytes.lower`` and ``bytes.split`` define both. Fewer words make one
    shingle of all of them; no words make none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    if not len(h):
        return h
    width = min(n_words, len(h))
    count = len(h) - width + 1
    rolled = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        rolled = (rolled + h[i : i + count]) * _WORD_STEP
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Lowest 16 bits of the minimum of each of the 32 hash functions."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        np.minimum(least, ((part[:, None] * _MULTIPLIERS) >> np.uint64(24)).min(axis=0), out=least)
    return least & np.uint64(0xFFFF)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """The 32 keys of a signature: each chunk without each of its positions."""
    chunks = sig.reshape(CHUNKS, CHUNK)
    keys = np.empty((CHUNKS, CHUNK), dtype=np.uint64)
    for out in range(CHUNK):
        a, b, c = (chunks[:, i] for i in range(CHUNK) if i != out)
        label = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(out)
        keys[:, out] = label << np.uint64(48) | a << np.uint64(32) | b << np.uint64(16) | c
    return keys.ravel().astype(np.int64)


def _signed(docs: DataFrame, n_words: int, kind: str) -> DataFrame:
    """id, n_shingles, set_1, set_2 (128-bit identity of the set), keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            n, one, two, keys = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), n_words, hashes)
                n.append(len(shingles))
                digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
                one.append((digest >> 64) - (1 << 63))
                two.append((digest & (1 << 64) - 1) - (1 << 63))
                keys.append(chunk_keys(signature(shingles)) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "set_1", "set_2", "keys"],
            )

    return docs.mapInArrow(sign, f"id {kind}, n_shingles long, set_1 long, set_2 long, keys array<long>")


def _sets(docs: DataFrame, n_words: int, kind: str) -> DataFrame:
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), n_words, hashes).astype(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"]
            )

    return docs.mapInArrow(shingle, f"id {kind}, shingles array<long>")


def _tile_links(members: DataFrame, sets: DataFrame, percent: int, kind: str) -> DataFrame:
    """(a, b) in one component by links between members outside and all
    members of large groups.

    ``members`` says by how many blocks of bounded total size the members
    outside (``rows``) and all members (``columns``) of its key are dealt
    out; every pair of such blocks is a tile: the sizes of all intersections are one product
    of 0/1 matrices. A tile returns one edge per linked member, not its pairs.
    """
    dealt = members.join(sets.toDF("node", "shingles"), "node").withColumn("h", F.xxhash64("node"))
    every = dealt.selectExpr(
        "key", "explode(sequence(0, rows - 1)) AS i", "int(pmod(h, columns)) AS j", "false AS outside", "node", "shingles"
    )
    some = dealt.where("component <> largest").selectExpr(
        "key", "int(pmod(h, rows)) AS i", "explode(sequence(0, columns - 1)) AS j", "true AS outside", "node", "shingles"
    )

    def link(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        outside = tile["outside"].to_numpy()
        shingles = tile["shingles"].combine_chunks()
        size = shingles.value_lengths().to_numpy().astype(np.int64)
        ids, column, count = np.unique(shingles.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row, shared = np.repeat(np.arange(len(size)), size), count[column] > 1
        row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        some, every = np.flatnonzero(outside), np.flatnonzero(~outside)
        common = np.zeros((len(some), len(every)), dtype=np.float32)
        for first in range(0, int((count > 1).sum()), 2048):
            part = slice(*np.searchsorted(column, (first, first + 2048)))
            held = np.zeros((len(size), 2048), dtype=np.float32)
            held[row[part], column[part] - first] = 1
            common += held[some] @ held[every].T
        union = size[some][:, None] + size[every][None, :] - common
        i, j = np.nonzero(100 * common.astype(np.float64) >= percent * union)
        nodes = tile["node"].combine_chunks()
        first, second = nodes.take(pa.array(some[i])), nodes.take(pa.array(every[j]))
        names, place = np.unique(np.concatenate([first.to_numpy(False), second.to_numpy(False)]), return_inverse=True)
        label = local_components(len(names), place[: len(i)], place[len(i) :])
        linked = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"a": pa.array(names[linked], nodes.type), "b": pa.array(names[label[linked]], nodes.type)})

    return some.union(every).groupBy("key", "i", "j").applyInArrow(link, f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame,
    n_words: int = 5,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links of Jaccard similarity >= ``similarity``)
    and ``kept`` (id = component_id).

    Null, empty and blank texts have no shingles and link with nothing. A null
    id is linked with nothing either, has a null component and is kept. Rows
    that repeat an id each give a row; if their texts differ, links of either
    text count for the id. Signatures and the sets of candidates are staged.
    """
    percent = round(similarity * 100)
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    signed = stage(_signed(docs, n_words, kind), "signed")

    classes = stage(
        signed.where("id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_1", "set_2")
        .agg(F.min("id").alias("node"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")),
        "classes",
    )
    rows = classes.select("node", "n", F.explode("keys").alias("key"))
    # What is joined by a key that very many rows have is staged first: only
    # between plain exchanges can AQE split such a key's partition.
    alike = stage(
        rows.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1"),
        "shared-keys",
    )
    groups = stage(rows.join(alike, "key"), "groups")

    wanted = groups.select(F.col("node").alias("id")).distinct()
    sets = stage(_sets(docs.join(wanted, "id", "left_semi"), n_words, kind), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, on their full sets."""
        shared = F.size(F.array_intersect("s", "t"))
        union = F.size("s") + F.size("t") - shared
        return (
            pairs.join(sets.toDF("a", "s"), "a").join(sets.toDF("b", "t"), "b")
            .where(shared * 100 >= union * percent)
            .select("a", "b")
        )

    sizes = groups.select("node", "n").distinct()
    against_hub = (
        groups.where("node <> hub").select("hub", "node", "n").distinct()
        .join(sizes.toDF("hub", "hub_n"), "hub").where(f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)")
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
    )
    links = stage(confirm(against_hub), "confirmed")
    labels = connected_components(links)

    # What is still apart within a group: members outside of the group's
    # largest component, against all members of other components.
    members = groups.select("key", "node", "n", "members").join(labels, "node", "left")
    members = stage(members.withColumn("component", F.coalesce("component", "node")), "members")
    free(groups, alike, links)
    weight = F.greatest("n", F.lit(LEAST_WEIGHT))
    of_key = stage(
        members.groupBy("key", "component").agg(F.struct(F.count("*").alias("c"), "component").alias("size"), F.sum(weight).alias("w"))
        .groupBy("key").agg(
            F.max_by("component", "size").alias("largest"),
            F.ceil(F.sum("w") / TILE_SHINGLES).cast("int").alias("columns"),
            F.ceil((F.sum("w") - F.max_by("w", "size")) / TILE_SHINGLES).cast("int").alias("rows"),
            F.count("*").alias("parts"),
        ).where("parts > 1").drop("parts"),
        "split-keys",
    )
    split = stage(members.join(of_key, "key"), "split")
    small, large = split.where(f"members < {LARGE_GROUP}"), split.where(f"members >= {LARGE_GROUP}")
    few = small.where("component <> largest").selectExpr("key", "node AS a", "n AS m", "component AS x")
    pairs = (
        few.join(small.selectExpr("key", "node AS b", "n", "component AS y", "largest"), "key")
        .where("x <> y AND (y = largest OR a < b)")
        .where(f"100 * least(m, n) >= {percent} * greatest(m, n)")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    more = confirm(pairs).union(_tile_links(large, sets, percent, kind))
    labels = connected_components(more, labels)
    free(members, of_key, split, sets)

    named = (
        classes.select("set_1", "set_2", "node").join(labels, "node", "left")
        .select("set_1", "set_2", F.coalesce("component", "node").alias("component_id"))
    )
    named = stage(named, "classes")
    free(classes)
    out = signed.drop("keys").join(named, ["set_1", "set_2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )

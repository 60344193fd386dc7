"""Operator 10: near-duplicate embeddings by quantised tile products.

Vectors of a label are dealt into blocks, and every pair of blocks is a tile
of bounded size. In a tile, vectors are quantised to int8 with a scale of
their own, and the product of the codes plus a rigorous bound of the error
tells which pairs may reach the threshold; only those are computed again in
double precision. A tile returns sums of links per vector and one edge per
vector of a local component, never its pairs. Equal vectors meet as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import connected_components, local_components
from sluice.llm.store import col, stage

#: Vectors in a block, about; a tile compares two blocks.
BLOCK = 2048
#: Pairs whose vectors are multiplied again at once.
RECOMPUTED = 1 << 16


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scales, error norms) of rows of unit length."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def possible_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of x and j of y whose product may reach ``threshold``.

    With x = x' + d and y = y' + e, |xy - x'y'| <= |d| |y'| + |x| |e|, which is
    at most |d| (1 + |e|) + |e| for unit vectors; 1e-9 covers rounding. The
    integer products are exact in the floats that hold them.
    """
    (q, s, d), (r, t, e) = quantise(x), quantise(y)
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q.astype(exact) @ r.astype(exact).T).astype(np.float64)
    product *= s[:, None]
    product *= t[None, :]
    product += (d[:, None] * (1 + e)[None, :] + e[None, :]) + 1e-9
    return np.nonzero(product >= threshold)


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) with a product of at least ``threshold`` in double precision."""
    i, j = possible_pairs(x, y, threshold)
    hit = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), RECOMPUTED):
        part = slice(at, at + RECOMPUTED)
        hit[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= threshold
    return i[hit], j[hit]


def unit_rows(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other rows of the same
    label with cosine >= ``threshold``), ``component_id`` (the smallest id
    reachable over links) and ``kept`` (id = component_id).

    Vectors that are null, empty, zero or hold a null, NaN or infinity, and
    rows with a null label, link with nothing, and neither do vectors of
    different lengths. Rows that repeat an id are vectors of their own for
    ``n_links``; links of all of them count for the id. A null id links with
    nothing, has a null component and is kept.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(
        col(id_col).alias("id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("v")
    )
    sound = F.expr(
        "id IS NOT NULL AND label IS NOT NULL AND size(v) > 0 "
        "AND forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(7), "v"))
    key = ["label", "h1", "h2"]
    # Negative zeros hash apart from zeros, which only makes two classes of one.
    classes = stage(
        rows.where("sound").groupBy(*key).agg(
            F.min("id").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v")
        ).withColumn("dim", F.size("v")),
        "vectors",
    )
    blocks = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = classes.join(stage(blocks, "blocks"), ["label", "dim"]).withColumn("own", F.expr("int(pmod(xxhash64(h1, h2), blocks))"))
    tiles = dealt.select(
        "label", "dim", "own", "node", "copies", "v", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    ).select("label", "dim", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
             "own", "node", "copies", "v")

    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by([("own", "ascending"), ("node", "ascending")]).combine_chunks()
        own, low = group["own"].to_numpy(), group["low"][0].as_py()
        values = group["v"].combine_chunks().flatten().to_numpy().reshape(len(own), -1)
        unit, copies = unit_rows(values), group["copies"].to_numpy()
        n_low = int((own == low).sum())
        if n_low == len(own) and group["high"][0].as_py() != low:
            i = j = np.zeros(0, dtype=np.int64)
        elif n_low == len(own):
            i, j = tile_links(unit, unit, threshold)
            i, j = i[i < j], j[i < j]
        else:
            i, j = tile_links(unit[:n_low], unit[n_low:], threshold)
            j = j + n_low
        n_links = np.bincount(i, copies[j], len(own)) + np.bincount(j, copies[i], len(own))
        label = local_components(len(own), i, j)
        linked = np.flatnonzero(n_links)
        nodes = group["node"].combine_chunks()
        return pa.table({
            "a": nodes.take(pa.array(linked)),
            "b": nodes.take(pa.array(label[linked])),
            "links": pa.array(n_links[linked].astype(np.int64)),
        })

    found = stage(
        tiles.groupBy("label", "dim", "low", "high").applyInArrow(link, f"a {id_type}, b {id_type}, links long"),
        "tiles",
    )
    n_links = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    labels = connected_components(found.select("a", "b"))
    named = (
        classes.select(*key, "node", "copies").join(n_links, "node", "left").join(labels, "node", "left")
        .select(*key, F.expr("coalesce(links, 0) + copies - 1").alias("links"),
                F.coalesce("component", "node").alias("component"))
    )
    # Staged, so that AQE can split the partition of a vector of very many copies.
    out = rows.drop("v").join(stage(named, "classes"), key, "left")
    component = F.when(F.col("sound"), F.col("component")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("sound"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )

"""Operator 12: hard negatives by an inverted multi-index.

Vectors are cut in two halves, each with a codebook of its own; a pair of
codewords is a cell. For an anchor every codeword of a half has a bound of the
half's score: its product with the codeword plus the anchor's length times the
codeword's radius, the largest distance of any vector from it. A heap merges
the two sorted lists of bounds and so visits cells by falling sums.

An anchor first visits the cells on top until they hold some rows. The scores
found certify how high a cell's bound must be to matter; the second round goes
on to exactly those cells and leaves out the rest, so results are exact. Small
cells share a block and large ones are dealt into several; anchors meet the
blocks they visit in tiles of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.store import col, stage

#: Codewords of a half, rows the codebooks are trained on (about), and passes.
CODEWORDS, TRAINED_ON, PASSES = 32, 8192, 12
#: Rows of a block and anchors of a tile, about.
BLOCK, ANCHORS = 4096, 1024
#: Rows in the cells that the first round visits, at least.
FIRST_ROWS = 512


class Index(NamedTuple):
    """Codebooks, radii and directory: of bounded size, whatever the table's."""

    half: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cell: np.ndarray  # by codewords: number of the cell, or -1
    rows: np.ndarray  # of a cell
    block: np.ndarray  # first block of a cell
    parts: np.ndarray  # blocks that a cell is dealt into

    def bounds(self, anchor: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Most and least that each codeword of each half can add to a score."""
        upper, lower = [], []
        dim = self.books[0].shape[1] + self.books[1].shape[1]
        whole = np.zeros(max(dim, len(anchor)))
        whole[: len(anchor)] = anchor
        for book, radius, (start, end) in zip(self.books, self.radii, ((0, self.half), (self.half, None))):
            part = whole[start:end]
            middle = book @ part[: book.shape[1]]
            slack = np.linalg.norm(part) * radius
            slack += 1e-9 * (np.abs(middle) + slack) + 1e-6
            upper.append(middle + slack)
            lower.append(middle - slack)
        return upper, lower

    def visits(self, upper: list[np.ndarray]) -> Iterator[tuple[float, int, int, int]]:
        """(bound, cell, codewords) of the cells that hold rows, by falling bound."""
        one, two = (np.argsort(-u, kind="stable") for u in upper)
        first, second = upper[0][one], upper[1][two]
        heap = [(-(first[0] + second[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(two):
                heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))
            cell = int(self.cell[one[i], two[j]])
            if cell >= 0:
                yield -bound, cell, int(one[i]), int(two[j])

    def blocks(self, cells: set[int]) -> set[int]:
        return {b for c in cells for b in range(int(self.block[c]), int(self.block[c] + self.parts[c]))}

    def first_cells(self, anchor: np.ndarray, highest: list[float]) -> set[int]:
        """Cells for the first round: from the top, ``FIRST_ROWS`` rows for each
        highest score of interest, but no cell whose rows all score higher."""
        upper, lower = self.bounds(anchor)
        chosen, missing = set(), {k: FIRST_ROWS for k in range(len(highest))}
        for _, cell, i, j in self.visits(upper):
            least = lower[0][i] + lower[1][j]
            useful = [k for k in missing if least <= highest[k]]
            if useful:
                chosen.add(cell)
            for k in useful:
                missing[k] -= int(self.rows[cell])
                if missing[k] <= 0:
                    del missing[k]
            if not missing:
                break
        return chosen

    def cells_left(self, anchor: np.ndarray, windows: list[tuple[float, float]]) -> set[int]:
        """Cells that may hold a score of one of the windows (least, highest)."""
        upper, lower = self.bounds(anchor)
        chosen, stop = set(), min((w[0] for w in windows), default=np.inf)
        for bound, cell, i, j in self.visits(upper):
            if bound < stop:
                break
            if any(bound >= least and lower[0][i] + lower[1][j] <= highest for least, highest in windows):
                chosen.add(cell)
        return chosen


def padded(vectors: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of equal length: shorter ones end in zeros, longer ones are cut."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    dim = int(lengths.max(initial=0)) if dim is None else dim
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    inside = column < dim
    out[row[inside], column[inside]] = vectors.flatten().to_numpy(zero_copy_only=False)[inside]
    return out


def train_codebook(x: np.ndarray, codewords: int = CODEWORDS, seed: int = 12) -> np.ndarray:
    """k-means; fewer codewords if there are fewer different rows."""
    different = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    book = different[rng.permutation(len(different))[:codewords]].astype(np.float64)
    if not len(book):
        return np.zeros((1, x.shape[1]))
    for _ in range(PASSES):
        nearest = _nearest(x, book)
        size = np.bincount(nearest, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, x)
        book = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], book)
    return book


def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1) - 2 * (x @ book.T)).argmin(axis=1)


def scores(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers whose lengths are below 2**31."""
    dim = min(one.shape[1], two.shape[1])
    one, two = one[:, :dim], two[:, :dim]
    longest = [np.linalg.norm(x.astype(np.float64), axis=1).max(initial=0) for x in (one, two)]
    if longest[0] * longest[1] < 1 << 52:
        return (one.astype(np.float64) @ two.astype(np.float64).T).astype(np.int64)
    return one @ two.T


def best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, of equal ones those of smaller ids."""
    if len(score) > count:
        least = np.partition(score, len(score) - count)[len(score) - count]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))][:count]


def _index(rows: DataFrame, half: int, books: tuple[np.ndarray, np.ndarray]) -> tuple[DataFrame, Index]:
    """Every row with its block, and the directory of the cells."""
    dims = tuple(b.shape[1] for b in books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = padded(batch.column(2)).astype(np.float64)
            wide = np.zeros((len(whole), max(whole.shape[1], sum(dims))))
            wide[:, : whole.shape[1]] = whole
            words, far = [], []
            for book, part in zip(books, (wide[:, :half], wide[:, half:])):
                inside = part[:, : book.shape[1]]
                word = _nearest(inside, book)
                rest = (part[:, book.shape[1] :] ** 2).sum(axis=1)
                words.append(word)
                far.append(np.sqrt(((inside - book[word]) ** 2).sum(axis=1) + rest))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(w.astype(np.int32)) for w in words), *(pa.array(f) for f in far)],
                names=["id", "label", "v", "one", "two", "far_one", "far_two"],
            )

    kind = rows.schema["label"].dataType.simpleString()
    placed = stage(
        rows.select("id", "label", "v").mapInArrow(
            assign, f"id long, label {kind}, v array<long>, one int, two int, far_one double, far_two double"
        ),
        "vectors-placed",
    )
    cells = placed.groupBy("one", "two").agg(
        F.count("*").alias("rows"), F.max("far_one").alias("far_one"), F.max("far_two").alias("far_two")
    ).orderBy("one", "two").collect()  # at most CODEWORDS squared rows
    cell = np.full(tuple(len(b) for b in books), -1)
    radii = tuple(np.zeros(len(b)) for b in books)
    block, parts, last, held = [], [], 0, 0
    for n, c in enumerate(cells):
        cell[c["one"], c["two"]] = n
        for radius, word in zip(radii, ("one", "two")):
            radius[c[word]] = max(radius[c[word]], c[f"far_{word}"])
        if held and held + c["rows"] > BLOCK:
            last, held = last + 1, 0
        block.append(last)
        parts.append(-(-c["rows"] // BLOCK))
        held += c["rows"]
        if parts[-1] > 1:
            last, held = last + parts[-1], 0
    index = Index(half, books, radii, cell, np.array([c["rows"] for c in cells]), np.array(block), np.array(parts))
    spark = rows.sparkSession
    directory = spark.createDataFrame(
        [(c["one"], c["two"], block[n], parts[n]) for n, c in enumerate(cells)], "one int, two int, block int, parts int"
    )
    dealt = placed.join(F.broadcast(directory), ["one", "two"]).select(
        "id", "label", "v", F.expr("block + int(pmod(xxhash64(id), parts))").alias("block")
    )
    return dealt, index


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition) chooses.

    A component x counts as floor(``scale`` * x); a score is the integer inner
    product with the anchor; higher scores come first, equal ones by id. An
    anchor's positives are its first ``n_positives`` other rows of its label.
    For each positive the result has the first ``n_negatives`` rows of other
    labels with ``low`` * positive <= 100 * negative <= ``high`` * positive:
    anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    Rows with a null id, label or vector, or with a null, NaN or infinite
    component take no part, and neither do vectors whose scaled length is 2**31
    or more: their scores need not fit 64 bits. Of rows that repeat an id the
    one of the smallest label, then vector, stands for it. A shorter vector
    counts as zero beyond its end, an empty one scores zero. Without anchors,
    positives or negatives there are no rows.

    The codebooks are trained on about ``TRAINED_ON`` rows chosen by a hash of
    their id; every row is indexed and every result exact, whatever they are.
    """
    kind = vectors.schema[label_col].dataType.simpleString()
    whole = F.expr(
        "label IS NOT NULL AND id IS NOT NULL AND v IS NOT NULL "
        "AND forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity')) "
        f"AND aggregate(v, 0D, (s, x) -> s + pow({scale} * x, 2)) < pow(2, 61)"
    )
    rows = stage(
        vectors.select(
            col(id_col).cast("long").alias("id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("v"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"),
        )
        .where(whole)
        .select("id", F.struct("label", F.expr(f"transform(v, x -> floor({scale} * x))").alias("v"), "anchor").alias("r"))
        .groupBy("id").agg(F.min("r").alias("r")).select("id", "r.*"),
        "vectors",
    )
    number, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    out_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], out_schema)

    chosen = rows.where(f"pmod(xxhash64(id), 1000000) < {-(-TRAINED_ON * 1_000_000 // number)}").select("v")
    sample = chosen.toArrow()["v"]
    lengths = sample.combine_chunks().value_lengths().to_numpy(zero_copy_only=False) if len(sample) else np.zeros(1)
    dim = int(np.median(lengths))
    half = dim // 2
    seen = padded(sample, dim).astype(np.float64) if len(sample) else np.zeros((0, dim))
    placed, index = _index(rows, half, (train_codebook(seen[:, :half]), train_codebook(seen[:, half:])))

    groups = -(-n_anchors // ANCHORS)
    asked = rows.where("anchor").select("id", "label", "v", F.expr(f"int(pmod(xxhash64(id), {groups}))").alias("team"))

    def visiting(asking: DataFrame, choose: Callable[[dict], set[int]], name: str) -> DataFrame:
        """``asking`` with a row per block that ``choose`` names."""
        names = asking.columns

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                plain = batch.select([c for c in names if c != "v"]).to_pylist()
                wanted = [sorted(choose(row | {"v": v.as_py()})) for row, v in zip(plain, batch.column("v"))]
                at = pa.array(np.repeat(np.arange(len(wanted)), [len(w) for w in wanted]))
                taken = batch.take(at)
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array([b for w in wanted for b in w], pa.int32())], names=[*names, "block"]
                )

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asking.schema.fields)
        return stage(asking.mapInArrow(visit, f"{schema}, block int"), name)

    def tiles(visits: DataFrame, pick: Callable[[dict, np.ndarray, np.ndarray, np.ndarray], list], schema: str) -> DataFrame:
        """What ``pick`` takes of each anchor's scores in each block it visits."""
        pairs = visits.select(F.col("block").alias("visited"), F.col("team").alias("by")).distinct()
        met = placed.join(pairs, F.col("block") == F.col("visited")).select("id", "label", "v", "visited", "by")
        names = [c for c in visits.columns if c not in ("v", "block", "team")]

        def tile(left: pa.Table, right: pa.Table) -> pa.Table:
            types = [(part.split()[0], pa.int64()) for part in schema.split(", ")]
            out: list[tuple] = []
            if len(left) and len(right):
                ids = right["id"].to_numpy()
                labels = right["label"].to_numpy()
                for at in range(0, len(left), 64):
                    some = left.slice(at, 64)
                    table = scores(padded(some["v"]), padded(right["v"]))
                    for anchor, score in zip(some.select(names).to_pylist(), table):
                        out += pick(anchor, ids, labels, score)
            columns = list(zip(*out)) or [()] * len(types)
            return pa.table({name: pa.array(c, t) for (name, t), c in zip(types, columns)})

        return visits.groupBy("block", "team").cogroup(met.groupBy("visited", "by")).applyInArrow(tile, schema)

    def top(found: DataFrame, keys: list[str], other: str, count: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), other)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)

    # Positives: the cells on top, then those that may hold a higher score.
    def same_label(anchor: dict, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> list:
        at = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["id"]))
        at = at[best(score[at], ids[at], n_positives)]
        return [(anchor["id"], int(i), int(s)) for i, s in zip(ids[at], score[at])]

    def start(row: dict) -> set[int]:
        return index.blocks(index.first_cells(np.array(row["v"], dtype=np.float64), [np.inf]))

    def go_on(row: dict) -> set[int]:
        least = -np.inf if row["least"] is None else row["least"]
        left = index.cells_left(np.array(row["v"], dtype=np.float64), [(least, np.inf)])
        return index.blocks(left) - start(row)

    schema = "anchor_id long, other long, score long"
    found = stage(top(tiles(visiting(asked, start, "visits"), same_label, schema), ["anchor_id"], "other", n_positives)
                  .drop("rank"), "positives")
    least = found.groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(f"n = {n_positives}")
    asking = asked.join(least.select(F.col("anchor_id").alias("id"), "least"), "id", "left")
    more = tiles(visiting(asking, go_on, "visits"), same_label, schema)
    positives = stage(top(found.union(more), ["anchor_id"], "other", n_positives), "positives")

    # Negatives: a window of scores per positive.
    def limits(row: dict) -> list[tuple[int, int]]:
        return [(-(-low * p // 100), high * p // 100) for p in row["marks"]]

    def other_labels(anchor: dict, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> list:
        out, other = [], labels != anchor["label"]
        for positive, (least, most) in zip(anchor["positives"], limits(anchor)):
            at = np.flatnonzero(other & (score >= least) & (score <= most))
            at = at[best(score[at], ids[at], n_negatives)]
            out += [(anchor["id"], positive, int(i), int(s)) for i, s in zip(ids[at], score[at])]
        return out

    def start_windows(row: dict) -> set[int]:
        highest = [float(most) for least, most in limits(row) if least <= most]
        return index.blocks(index.first_cells(np.array(row["v"], dtype=np.float64), highest)) if highest else set()

    def go_on_windows(row: dict) -> set[int]:
        seen = dict(zip(row["full"] or [], row["least"] or []))
        windows = [
            (float(max(least, seen.get(p, least))), float(most))
            for p, (least, most) in zip(row["positives"], limits(row)) if least <= most
        ]
        left = index.cells_left(np.array(row["v"], dtype=np.float64), windows)
        return index.blocks(left) - start_windows(row)

    marks = positives.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("p")
    ).select("id", F.col("p.other").alias("positives"), F.col("p.score").alias("marks"))
    asked = stage(asked.join(marks, "id"), "asked")
    schema = "anchor_id long, positive_id long, other long, score long"
    pair = ["anchor_id", "positive_id"]
    found = stage(top(tiles(visiting(asked, start_windows, "visits"), other_labels, schema), pair, "other", n_negatives)
                  .drop("rank"), "negatives")
    least = (
        found.groupBy(*pair).agg(F.count("*").alias("n"), F.min("score").alias("least")).where(f"n = {n_negatives}")
        .groupBy(F.col("anchor_id").alias("id"))
        .agg(F.collect_list(F.struct("positive_id", "least")).alias("s"))
        .select("id", F.col("s.positive_id").alias("full"), F.col("s.least").alias("least"))
    )
    more = tiles(visiting(asked.join(least, "id", "left"), go_on_windows, "visits"), other_labels, schema)
    negatives = top(found.union(more), pair, "other", n_negatives)
    scored = positives.select("anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(scored, pair).select(
        *pair, F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )

"""Operator 11: repeated passages by a column-wise multi-document suffix order.

Every window of ``n`` bytes names one place inside it, its anchor: the k-gram
of least hash (k is about n / 12). Equal windows have their anchor at the same
distance, so windows can only repeat within the occurrences of one anchor, and
within one range of distances: the bytes that all windows of such a range
share, the core, are the key under which occurrences meet. Keys met once hold
no repeat.

What meets with different surroundings goes through the column-wise
construction: the documents of a collection are the occurrences' bytes, the
core counting as one symbol; each round inserts one more symbol of every
document, from the last to the first, into the Burrows-Wheeler transform and
the array of common prefixes, both of which are read and written in sequence
once a round. Neighbours with a common prefix of a whole window repeat.

Occurrences alike in bytes are one document. A key with very many different
documents is dealt out again by narrower ranges with longer cores, down to
ranges of a single window, so no collection grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col, hash128, row_schema, stage

#: Ranges of distances per anchor; a key's core is the window without a range's width.
RANGES = 4
#: Different documents from which on a key is dealt out by narrower ranges.
LARGE_KEY = 512
#: Documents in a task of the construction, about, and in one collection at most.
TASK_DOCUMENTS, COLLECTION = 2048, 1024
#: Narrower ranges are so many times narrower.
NARROWER = 8
#: Windows looked at in one go.
SLAB = 1 << 18
#: Rows from which on a batch is handed on.
BATCH_ROWS = 1 << 15

_PLACES = np.uint64(0xFFFFF)
_FACTOR = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(1093).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base % (1 << 64), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """Hashes of any stretches of a slab of bytes from one sum over the slab."""

    _power = _inverse = np.zeros(0, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        if len(self._power) < len(data) + 1:
            _Hashes._power = _powers(_FACTOR, len(data) + 1)
            _Hashes._inverse = _powers(pow(_FACTOR, -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self._power[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self._inverse[: len(self.sums)][start]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    count = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    padded = padded.reshape(blocks, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:count], before[width - 1 : width - 1 + count])


def window_shape(n: int) -> tuple[int, int]:
    """(width of a range of distances, bytes of an anchor) for windows of ``n`` bytes."""
    if n < 8:
        raise ValueError("windows need 8 bytes or more")
    width = max(1, (n - n // 12) // RANGES)
    return width, n - RANGES * width + 1


def occurrences(data: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each anchor and range with windows in ``data``, by slabs: key, first
    window, number of windows, distance of the first window's start to the anchor."""
    width, k = window_shape(n)
    windows = len(data) - n + 1
    for at in range(0, windows, SLAB):
        count = min(SLAB, windows - at)
        slab = data[at : at + count + n - 1]
        hashes = _Hashes(slab)
        grams = hashes(slice(0, len(slab) - k + 1), slice(k, None))
        places = np.arange(len(grams), dtype=np.uint64)
        # The rightmost of equal k-grams: of a window's bytes alone, as it must be.
        least = _sliding_min(grams >> np.uint64(20) << np.uint64(20) | (_PLACES - places), RANGES * width)
        anchor = (_PLACES - (least & _PLACES)).astype(np.int64)
        start = np.arange(count)
        distance = anchor - start
        part = distance // width
        fresh = np.ones(count, dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(fresh)
        number = np.diff(np.append(first, count))
        low = part[first] * width
        key = hashes(anchor[first] - low, anchor[first] - low - width + 1 + n) ^ (part[first].astype(np.uint64) * _MIX)
        yield key.astype(np.int64), first + at, number, distance[first]


def _packed(first: np.ndarray, number: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 32 | distance << 16 | number


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, distance)"""
    return at >> 32, at & 0xFFFF, at >> 16 & 0xFFFF


def _rows(batch: pa.RecordBatch, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    key, kind, text, at = (np.concatenate(column) for column in zip(*parts))
    text = pa.array(text)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(kind), batch.column(0).take(text), batch.column(1).take(text), pa.array(at)],
        names=["key", "class", "h1", "h2", "at"],
    )


def _found(texts: DataFrame, n: int) -> DataFrame:
    """key, class, h1, h2, at: every occurrence of an anchor and range; ``class``
    hashes its bytes, ``at`` packs the first window, the distance from its start
    to the anchor and the number of windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for i, text in enumerate(batch.column(2)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if len(raw) < n:
                    continue
                for key, first, number, distance in occurrences(np.frombuffer(raw, dtype=np.uint8), n):
                    kind = np.fromiter(
                        (xxhash.xxh3_64_intdigest(raw[f : f + c + n - 1], d << 16 | c)
                         for f, c, d in zip(first.tolist(), number.tolist(), distance.tolist())),
                        dtype=np.uint64, count=len(first),
                    ).astype(np.int64)
                    parts.append((key, kind, np.full(len(key), i), _packed(first, number, distance)))
                    size += len(key)
                    if size >= BATCH_ROWS:
                        yield _rows(batch, parts)
                        parts, size = [], 0
            if parts:
                yield _rows(batch, parts)

    return texts.mapInArrow(scan, "key long, class long, h1 long, h2 long, at long")


def insert_columns(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of documents whose symbols (1 and up) end at the last column.

    Returns, in the order of all suffixes, the empty ones first: document,
    length of the suffix, and the prefix it shares with the one before it.
    Round j inserts the suffixes of length j: the symbol of the transform at a
    document's last suffix is the new suffix's first, and the rank of that
    symbol there its place.
    """
    m, width = symbols.shape
    document, length = np.arange(m, dtype=np.int32), np.zeros(m, dtype=np.int32)
    common = np.zeros(m, dtype=np.int32)
    transform = np.where(lengths > 0, symbols[:, -1] if width else 0, 0).astype(np.uint16)
    newest = np.ones(m, dtype=bool)
    for j in range(1, width + 1):
        order = np.argsort(transform, kind="stable")
        ended = int(np.count_nonzero(transform == 0))
        ranks = np.flatnonzero(newest[order])
        ranks = ranks[ranks >= ended]
        if not len(ranks):
            break
        here = order[ranks]
        place = ranks - ended + m
        size = len(order) + len(ranks)
        old = np.ones(size, dtype=bool)
        old[place] = False
        # Prefixes shared with the neighbours of the same first symbol.
        edge = np.unique(np.concatenate([ranks, ranks + 1]))
        edge = edge[(edge > ended) & (edge < len(order))]
        same = transform[order[edge]] == transform[order[edge - 1]]
        changed = edge - ended + m
        value = np.zeros(len(edge), dtype=np.int32)
        if same.any():
            low, high = order[edge[same] - 1] + 1, order[edge[same]] + 1
            by_start = np.argsort(low)
            bounds = np.stack([low[by_start], high[by_start]], axis=1).ravel()
            least = np.empty(len(by_start), dtype=np.int32)
            least[by_start] = np.minimum.reduceat(np.append(common, 0), bounds)[::2]
            value[same] = 1 + least
        doc = document[here]
        following = np.where(lengths[doc] > j, symbols[doc, max(width - 1 - j, 0)], 0).astype(np.uint16)

        def merged(column: np.ndarray, new: np.ndarray | int) -> np.ndarray:
            out = np.empty(size, dtype=column.dtype)
            out[old], out[place] = column, new
            return out

        document, length = merged(document, doc), merged(length, j)
        transform, common = merged(transform, following), merged(common, 0)
        common[changed] = value
        newest = ~old
    return document, length, common


def _collection_repeats(parts: list[tuple[int, int, bytes]], n: int, width: int) -> list[tuple[int, int, int]]:
    """(document, first, last): windows of ``parts`` (distance, windows, bytes)
    that another of them, or the same, holds as well."""
    cores: dict[bytes, int] = {}
    strings = []
    for distance, number, data in parts:
        before = distance % width
        after = width - 1 - (distance - number + 1) % width
        core = cores.setdefault(data[before : len(data) - after], 257 + len(cores))
        text = np.frombuffer(data, dtype=np.uint8).astype(np.uint16) + 1
        strings.append(np.concatenate([text[:before], [core], text[len(text) - after :] if after else text[:0]]).astype(np.uint16))
    lengths = np.array([len(s) for s in strings])
    symbols = np.zeros((len(strings), lengths.max()), dtype=np.uint16)
    for i, s in enumerate(strings):
        symbols[i, symbols.shape[1] - len(s) :] = s
    document, length, common = insert_columns(symbols, lengths)
    # A window of n bytes is `width` symbols, its core being one.
    alike = common >= width
    alike[:-1] |= alike[1:]
    doc, start = document[alike], (lengths[document] - length)[alike]
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    if not len(doc):
        return []
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(new[1:], len(doc)) - 1
    return list(zip(doc[new].tolist(), start[new].tolist(), start[last].tolist()))


RUNS = "key long, class long, low int, high int"


def _repeated(classes: DataFrame, n: int, width: int) -> DataFrame:
    """(key, class, low, high): runs of windows of a class, counted from its
    first, that occur elsewhere.

    ``classes`` (key, class, distance, windows, data, many) is staged and has
    at least two classes of each key.
    """
    sizes = stage(classes.groupBy("key").agg(F.count("*").alias("members")), "suffix-keys")
    sized = classes.join(sizes, "key")
    total = sizes.where(f"members <= {LARGE_KEY}").agg(F.sum("members")).first()[0] or 0
    tasks = max(1, -(-total // TASK_DOCUMENTS))

    def construct(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("key", "ascending"), ("class", "ascending")]).to_pydict()
        key, out, start = rows["key"], [], 0
        while start < len(key):
            end = min(start + COLLECTION, len(key))
            if end < len(key):  # whole keys only; each is smaller than a collection
                while key[end] == key[end - 1]:
                    end -= 1
            parts = list(zip(rows["distance"][start:end], rows["windows"][start:end], rows["data"][start:end]))
            out += [(key[start + d], rows["class"][start + d], low, high)
                    for d, low, high in _collection_repeats(parts, n, width)]
            start = end
        columns = list(zip(*out)) or [(), (), (), ()]
        return pa.table({
            "key": pa.array(columns[0], pa.int64()), "class": pa.array(columns[1], pa.int64()),
            "low": pa.array(columns[2], pa.int32()), "high": pa.array(columns[3], pa.int32()),
        })

    small = sized.where(f"members <= {LARGE_KEY}").drop("members", "many")
    runs = small.groupBy(F.expr(f"pmod(xxhash64(key), {tasks})").alias("task")).applyInArrow(construct, RUNS)
    if sizes.where(f"members > {LARGE_KEY}").isEmpty():
        return runs

    narrow = max(1, width // NARROWER)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "class", "shift", "many", "sub_key", "sub_class", "distance", "windows", "data"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                distance, left, shift = row["distance"], row["windows"], 0
                while left:
                    far = distance - shift
                    number = min(left, far % narrow + 1)
                    data = row["data"][shift : shift + number + n - 1]
                    core = data[far % narrow : far % narrow + n - narrow + 1]
                    sub_key = xxhash.xxh3_64_intdigest(core + (far // narrow).to_bytes(4, "little"), row["key"] & (1 << 64) - 1)
                    sub_class = xxhash.xxh3_64_intdigest(data, far << 16 | number)
                    out.append((row["key"], row["class"], shift, row["many"], sub_key - (1 << 63), sub_class - (1 << 63),
                                far, number, data))
                    shift, left = shift + number, left - number
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    parts = stage(
        sized.where(f"members > {LARGE_KEY}").drop("members").mapInArrow(
            split,
            "key long, class long, shift int, many boolean, sub_key long, sub_class long, distance int, windows int, data binary",
        ),
        "suffix-parts",
    )
    sub = stage(
        parts.groupBy(F.col("sub_key").alias("key"), F.col("sub_class").alias("class")).agg(
            F.first("distance").alias("distance"), F.first("windows").alias("windows"), F.first("data").alias("data"),
            (F.max("many") | (F.count("*") > 1)).alias("many"),
        ),
        "suffix-classes",
    )
    met = stage(sub.groupBy("key").count().where("count > 1").select("key"), "suffix-met")
    deeper = _repeated(stage(sub.join(met, "key", "left_semi"), "suffix-classes"), n, narrow)
    found = stage(deeper.union(sub.where("many").selectExpr("key", "class", "0", "windows - 1")), "suffix-runs")
    above = parts.select("key", "class", "shift", "sub_key", "sub_class").join(
        found.toDF("sub_key", "sub_class", "low", "high"), ["sub_key", "sub_class"]
    )
    return runs.union(above.selectExpr("key", "class", "low + shift", "high + shift")).select("key", "class", "low", "high")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, n: int = 400, text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a string of ``n`` bytes (of the text in
    UTF-8) that also starts anywhere else, in the same document or another.

    Returns every row of ``docs`` with its columns, plus ``n_bytes``,
    ``n_removed``, ``spans`` (the maximal removed runs, as byte offsets
    ``start`` and ``end``) and ``kept`` (binary: the other bytes, which may cut
    a character); input columns of these names are replaced.

    Each row is a document of its own, whatever its id, so rows alike in text
    lose it if it has ``n`` bytes. All places of a repeat go, the first too,
    and a run of one character repeats itself. Null, empty and shorter texts
    lose nothing. Texts are told apart by 128-bit hashes, occurrences of a key
    by 64-bit ones.
    """
    new = ("n_bytes", "n_removed", "spans", "kept")
    h1, h2 = hash128(F.coalesce(col(text_col), F.lit("")))
    packed = docs.select(
        F.struct(*[col(c) for c in docs.columns if c not in new]).alias("row"),
        col(text_col).alias("text"), h1.alias("h1"), h2.alias("h2"),
    )
    long_enough = packed.where(F.octet_length("text") >= n)
    found = _found(long_enough.select("h1", "h2", "text"), n)

    # A key of several occurrences: of different texts, or of one text.
    place = F.xxhash64("h1", "h2", "at")
    shared = stage(
        found.groupBy("key").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("key"),
        "suffix-shared",
    )
    members = stage(found.join(shared, "key").distinct(), "suffix-members")
    classes = stage(
        members.groupBy("key", "class").agg(
            F.min(F.struct("h1", "h2", "at")).alias("origin"), (F.count("*") > 1).alias("many")
        ),
        "suffix-classes",
    )
    met = stage(classes.groupBy("key").count().where("count > 1").select("key"), "suffix-met")
    wanted = stage(
        classes.join(met, "key", "left_semi")
        .groupBy("origin.h1", "origin.h2").agg(F.collect_list(F.struct("key", "class", "origin.at", "many")).alias("parts")),
        "suffix-wanted",
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, parts in zip(batch.column(0), batch.column(1)):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                parts = parts.values
                first, number, distance = _unpacked(parts.field("at").to_numpy())
                data = [raw[f : f + c + n - 1] for f, c in zip(first.tolist(), number.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [parts.field("key"), parts.field("class"), pa.array(distance.astype(np.int32)),
                     pa.array(number.astype(np.int32)), pa.array(data, pa.binary()), parts.field("many")],
                    names=["key", "class", "distance", "windows", "data", "many"],
                )

    fetched = (
        long_enough.join(wanted, ["h1", "h2"]).select("text", "parts")
        .mapInArrow(fetch, "key long, class long, distance int, windows int, data binary, many boolean")
        .groupBy("key", "class").agg(*[F.first(c).alias(c) for c in ("distance", "windows", "data", "many")])
    )
    runs = _repeated(stage(fetched, "suffix-data"), n, window_shape(n)[0])
    runs = stage(
        runs.union(classes.where("many").selectExpr("key", "class", "0", f"int(origin.at & {0xFFFF}) - 1")), "suffix-runs"
    )
    first = F.shiftright("at", 32)
    spans = members.join(runs, ["key", "class"]).select(
        "h1", "h2", (first + F.col("low")).alias("start"), (first + F.col("high") + n).alias("end")
    )
    whole = (
        long_enough.groupBy("h1", "h2", F.octet_length("text").cast("long").alias("end")).count().where("count > 1")
        .select("h1", "h2", F.lit(0).cast("long").alias("start"), "end")
    )
    removed = stage(
        spans.union(whole).groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "end")).alias("runs")), "suffix-spans"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                merged = _merged([(r["start"], r["end"]) for r in runs.as_py() or []])
                at, rest = 0, []
                for start, end in merged:
                    rest.append(raw[at:start])
                    at = end
                rest.append(raw[at:])
                sizes.append(len(raw))
                gone.append(sum(end - start for start, end in merged))
                spans.append([{"start": s, "end": e} for s, e in merged])
                kept.append(b"".join(rest))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span),
                 pa.array(kept, pa.binary())],
                names=["row", *new],
            )

    joined = packed.join(removed, ["h1", "h2"], "left").select("row", "text", "runs")
    out = joined.mapInArrow(
        cut, row_schema(joined, "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    )
    return out.select("row.*", *new)

"""Operator 6: packing documents into fixed-length token sequences.

The corpus meets in one small table only: the number of pieces of each length,
at most ``capacity`` rows. Patterns of lengths that fill a sequence are planned
on those counts, and every piece finds its place by its rank among the pieces
of its length, so no task sees more than its share of the pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col, stage

#: Pieces of one length that one ranking task orders, about.
RANKED_TOGETHER = 200_000

#: How the byte-level vocabulary's regular expression cuts a text (fixed value
#: of the public tokenizer).
PIECE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_encoder(tokenizer_path: str):
    """The byte-level BPE of a ``tokenizers`` JSON file, as a tiktoken encoder.

    Both libraries give the same ids from the same vocabulary (tested);
    tiktoken takes a quarter of the CPU time.
    """
    import tiktoken

    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = json.load(f)
    vocabulary = tokenizer["model"]["vocab"]
    added = {t["content"]: t["id"] for t in tokenizer["added_tokens"]}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    hidden = [b for b in range(256) if b not in set(printable)]
    byte_of |= {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in vocabulary.items()
        if all(c in byte_of for c in token) and token not in added
    }
    return tiktoken.Encoding("byte_bpe", pat_str=PIECE_PATTERN, mergeable_ranks=ranks, special_tokens=added)


#: White space as the pattern's ``\\s`` has it, in runs that its backtracking
#: ``\\s+(?!\\S)`` should not walk: about a million characters overflow its stack.
LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{1000,}")


def encode(encoder, text: str) -> list[int]:
    """The ids of ``text``; an added token's text gives its id, as in ``tokenizers``."""
    if not any(token in text for token in encoder.special_tokens_set):
        return encode_part(encoder, text)
    ids: list[int] = []
    longest_first = sorted(encoder.special_tokens_set, key=len, reverse=True)
    for n, part in enumerate(re.split(f"({'|'.join(map(re.escape, longest_first))})", text)):
        ids += [encoder.encode_single_token(part)] if n % 2 else encode_part(encoder, part)
    return ids


def encode_part(encoder, text: str) -> list[int]:
    """The ids of a text between added tokens, however long its white space is.

    A long run is one match of the pattern, but for its last character if
    text follows, which belongs to the next match; it is merged as such.
    """
    ids: list[int] = []
    at = 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += encoder.encode_ordinary(text[at : run.start()])
        ids += encoder._encode_single_piece(text[run.start() : end])
        at = end
    return ids + encoder.encode_ordinary(text[at:])


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``n`` ids: full ones, the rest first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, s + capacity) for s in range(first, n, capacity))]


def tokenize_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ``ids``).

    Every row of ``docs`` counts as a document of its own, repeated ids too;
    null text is empty and gives one piece holding ``end_id`` alone.
    """
    docs = docs.select(col(id_col).alias(id_col), col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(tokenizer_path)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            owners = batch.column(0)
            take = []
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*encode(encoder, text.as_py() or ""), end_id], dtype="<u4")
                for piece, (start, end) in enumerate(piece_bounds(len(ids), capacity)):
                    part = ids[start:end]
                    take.append(row)
                    for values, value in zip(out, (piece, start, end - start, zlib.crc32(part.tobytes()))):
                        values.append(value)
                    if with_ids:
                        out[5].append(part.astype(np.int32))
            arrays = [owners.take(pa.array(take, pa.int64()))]
            arrays += [pa.array(v, t) for v, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(out[5], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(tokenize, schema)


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of one sequence, how many such sequences)] using up ``counts``.

    From the longest length down, the gap beside it is closed exactly by one
    available length, by a pair or by a triple (looked up among the sums of
    the available lengths), as often as the counts allow. A gap nothing fills
    exactly takes the longest length that fits, and what then remains is
    looked up again.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    sums: dict[str, np.ndarray] = {}

    def pair(gap: int) -> tuple[int, ...] | None:
        a = np.flatnonzero(left[gap // 2 : gap]) + gap // 2
        a = a[(gap - a >= 1) & (left[gap - a] > 0)]
        a = a[(2 * a != gap) | (left[a] >= 2)]
        return (int(a[-1]), int(gap - a[-1])) if len(a) else None

    def filler(gap: int) -> tuple[int, ...] | None:
        if left[gap]:
            return (gap,)
        if found := pair(gap):
            return found
        if "pairs" not in sums:
            present = (left > 0).astype(np.float32)
            present[0] = 0
            sums["pairs"] = np.convolve(present, present)[: capacity + 1] > 0.5
        for c in np.flatnonzero(left[1:gap] > 0)[::-1] + 1:
            if sums["pairs"][gap - c]:
                left[c] -= 1
                found = pair(int(gap - c))
                left[c] += 1
                if found:
                    return (int(c), *found)
        return None

    def best_fit(gap: int) -> int | None:
        fits = np.flatnonzero(left[1 : gap + 1])
        return int(fits[-1]) + 1 if len(fits) else None

    plan: list[tuple[tuple[int, ...], int]] = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            left[longest] -= 1
            pattern, gap = [longest], capacity - longest
            while gap:
                if found := filler(gap):
                    for length in found:
                        left[length] -= 1
                    pattern += found
                    break
                if (length := best_fit(gap)) is None:
                    break
                left[length] -= 1
                pattern.append(length)
                gap -= length
            for length in pattern:
                left[length] += 1
            need = np.bincount(pattern, minlength=capacity + 1)
            times = int((left[need > 0] // need[need > 0]).min())
            left -= need * times
            plan.append((tuple(pattern), times))
            if (left[need > 0] == 0).any():
                sums.clear()
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """Give every piece a ``sequence_id`` and an ``offset`` in its sequence.

    ``pieces`` needs ``id_col``, ``piece``, ``length`` (1 to ``capacity``) and
    ``ids_crc32``; all columns are kept, and columns named like the two results
    are replaced. Rows alike in all of these are interchangeable.
    An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, used, base = [], dict.fromkeys(counts, 0), 0
    for pattern, times in plan_patterns(counts, capacity):
        offset = 0
        for length in pattern:
            slots.append((length, used[length], used[length] + times, base, offset))
            used[length] += times
            offset += length
        base += times
    schema = "slot_length long, first long, beyond long, base long, offset long"
    places = spark.createDataFrame(slots, schema)

    salts = 16 + sum(counts.values()) // RANKED_TOGETHER
    order = "PARTITION BY length, salt ORDER BY `{0}`, piece, ids_crc32".format(id_col)
    salted = pieces.withColumn("salt", F.expr(f"pmod(xxhash64(`{id_col}`, piece), {salts})"))
    begins = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
        .selectExpr("length AS l", "salt AS s", "sum(n) OVER (PARTITION BY length ORDER BY salt) - n AS begin")
    )
    ranked = salted.withColumn("rank", F.expr(f"row_number() OVER ({order}) - 1"))
    ranked = ranked.join(begins, F.expr("length = l AND salt = s"))
    # The plan has a row for each slot of a pattern. Every pattern but the
    # last of a length uses one length up, so its size follows the capacity
    # and not the corpus.
    placed = ranked.withColumn("rank", F.expr("rank + begin")).join(
        F.broadcast(places), F.expr("length = slot_length AND rank >= first AND rank < beyond")
    )
    return placed.select(
        *[col(c) for c in pieces.columns],
        F.expr("base + rank - first").alias("sequence_id"),
        "offset",
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack ``docs`` into sequences of ``capacity`` ids.

    A document is its ids and then ``end_id`` (the text of an added token of
    the vocabulary counts as that token, as ``tokenizers`` has it); only documents over
    ``capacity`` are cut, into full pieces with the shorter rest first.
    Returns one row per piece: id, piece, start, length, ids_crc32,
    sequence_id, offset (and ``ids``). Pieces are staged, so texts are
    tokenized once. Null ids and repeated rows are packed like any other.
    """
    pieces = tokenize_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    return pack(stage(pieces, "pieces"), capacity, id_col)

"""Operator 9: benchmark decontamination by spaced seeds, DataFrame functions only.

A seed is a hash of the words under a fixed mask, whose open positions may
differ. The two masks (six words of eight) together hit every stretch of 13
words with at most two substitutions, and with a third of shorter span every
item of 8 to 12 words with a sixth of them substituted (both exhaustively
tested). Shorter items have one seed of all their words. Hits on the same
alignment are followed by a verification that counts the equal words of the
aligned text and item around the hit.

The test side is broadcast, in blocks of a fixed number of seeds, so the
training side streams past it without a shuffle whatever its skew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col

#: Word positions under each mask.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
WINDOW = 13
SUBSTITUTIONS = 2
#: Besides MASKS, for items of SPAN words up to a window.
SHORT_MASK = (0, 1, 2, 3, 5)
#: Scripts written without blanks: every letter is a word.
_UNSPACED = "([" + "".join(rf"\p{{Is{s}}}" for s in "Han Hiragana Katakana Thai Lao Khmer Myanmar".split()) + "])"
#: Seeds of the test side in one broadcast: some 50 bytes each.
SEEDS_PER_BROADCAST = 400_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words of lower-cased text: what letters and digits make,
    letters of scripts without blanks one by one."""
    text = F.lower(F.coalesce(text, F.lit("")))
    apart = F.regexp_replace(text, _UNSPACED, " $1 ")
    text = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(apart)
    words = F.split(text, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


#: Word positions, and the least and the most words of the items it is for.
Mask = tuple[tuple[int, ...], int, int]


def _seed(words: str, at: str, masks: list[Mask], mask: int) -> str:
    return f"xxhash64({mask}, " + ", ".join(f"get({words}, {at} + {o})" for o in masks[mask][0]) + ")"


def _seeds(words: str, at: str, masks: list[Mask]) -> str:
    return "array(" + ", ".join(_seed(words, at, masks, m) for m in range(len(masks))) + ")"


def _hits(items: DataFrame, docs: DataFrame, masks: list[Mask], n_seeds: int, seeds_per_broadcast: int) -> DataFrame:
    """Alignments on which a seed of an item occurs in a document, which the
    first of successive hits of a mask stands for."""
    span = min(positions[-1] + 1 for positions, _, _ in masks)
    inside = " OR ".join(
        f"mask = {m} AND n_item BETWEEN {low} AND {high} AND q + {positions[-1]} < n_item"
        for m, (positions, low, high) in enumerate(masks)
    )
    seeds = items.where(F.size("iw") >= span).select(
        "item", "iw", F.expr(f"explode(sequence(0, size(iw) - {span}))").alias("q")
    ).selectExpr(
        "item", "q", "size(iw) AS n_item", f"posexplode({_seeds('iw', 'q', masks)}) AS (mask, seed)",
        f"CASE WHEN q > 0 THEN {_seeds('iw', '(q - 1)', masks)} END AS before",
    ).where(inside).selectExpr("item", "q", "n_item", "mask", "seed", "get(before, mask) AS before")
    blocks = max(1, -(-n_seeds // seeds_per_broadcast))

    at = docs.where(F.size("w") >= span).select("id", "w", F.expr(f"explode(sequence(0, size(w) - {span}))").alias("p"))
    probes = at.selectExpr("id", "w", "p", f"posexplode({_seeds('w', 'p', masks)}) AS (probe_mask, probe)")

    # Of the hits that follow one another on an alignment only the first counts.
    previous = "CASE probe_mask " + " ".join(
        f"WHEN {m} THEN {_seed('w', '(p - 1)', masks, m)}" for m in range(len(masks))
    ) + " END"

    def hits_of(block: int) -> DataFrame:
        part = seeds.where(f"pmod(seed, {blocks}) = {block}")
        first = F.expr(f"before IS NULL OR p = 0 OR before <> {previous}")
        return (
            probes.join(F.broadcast(part), F.expr("probe = seed AND probe_mask = mask"))
            .where(first)
            .selectExpr(
                "id", "item", "p - q AS doc_word", "greatest(q - p, 0) AS skipped",
                "slice(w, greatest(p - q, 0) + 1, n_item - greatest(q - p, 0)) AS here",
            )
        )

    return reduce(DataFrame.union, [hits_of(b) for b in range(blocks)])


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    seeds_per_broadcast: int = SEEDS_PER_BROADCAST,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds a passage of.

    Returns id, item id, ``doc_word`` (where the item's first word lies or
    would lie in the document, counted from 0), ``n_matched`` (equal words on
    that alignment), ``n_item_words`` and ``coverage`` (their ratio); one row
    per pair, the alignment with most equal words, the leftmost of a tie.

    A passage is a stretch of 13 aligned words, or of the whole item if it is
    shorter, of which all but two (of a shorter one: a sixth, rounded down)
    are equal; an item of under 8 words must be there exactly and as a whole,
    so that an item of one word is found wherever this word is. Words are runs
    of letters and digits, lower-cased; in scripts without blanks (Chinese,
    Japanese, Thai, Lao, Khmer, Burmese) every letter is one. Null and empty
    texts match nothing. A null id is reported as null. Rows that repeat an
    id are merged. With an empty side the result is empty.
    """
    items = (
        benchmark.select(col(item_id_col).alias("item"), word_hashes(col(item_text_col)).alias("iw"))
        .where(F.size("iw") > 0)
        .distinct()
    )
    sizes = items.groupBy(F.least(F.size("iw"), F.lit(WINDOW)).alias("n")).agg(
        F.count("*").alias("items"), F.sum(F.size("iw")).alias("words"))
    of_size = {r["n"]: (r["items"], r["words"]) for r in sizes.collect()}
    docs = docs.select(col(id_col).alias("id"), word_hashes(col(text_col)).alias("w"))

    def hits_by(masks: list[Mask]) -> DataFrame:
        n_seeds = sum(
            words - n_items * positions[-1]
            for positions, low, high in masks for n, (n_items, words) in of_size.items() if low <= n <= high
        )
        return _hits(items, docs, masks, n_seeds, seeds_per_broadcast)

    hits = hits_by([(positions, SPAN, (1 << 31) - 1) for positions in MASKS])
    short = [(tuple(range(n)), n, n) for n in range(1, SPAN)] + [(SHORT_MASK, SPAN, WINDOW - 1)]
    if short := [m for m in short if any(m[1] <= n <= m[2] for n in of_size)]:
        hits = hits.union(hits_by(short))
    equal = "transform(here, (x, i) -> int(x = get(iw, i + skipped)))"
    width = f"least({WINDOW}, size(iw))"
    allowed = f"CASE WHEN size(iw) >= {WINDOW} THEN {SUBSTITUTIONS} WHEN size(iw) >= {SPAN} THEN size(iw) div 6 ELSE 0 END"
    sums = (
        "CASE WHEN size(equal) >= width THEN array_max(transform(sequence(0, size(equal) - width), "
        "i -> aggregate(slice(equal, i + 1, width), 0, (a, x) -> a + x))) ELSE 0 END"
    )
    verified = (
        hits.join(items, "item")
        .selectExpr("id", "item", "doc_word", "size(iw) AS n_item_words", f"{equal} AS equal",
                    f"{width} AS width", f"{allowed} AS allowed")
        .where(f"{sums} >= width - allowed")
        .selectExpr("id", "item", "n_item_words", "struct(aggregate(equal, 0, (a, x) -> a + x) AS n, -doc_word AS d) AS best")
    )
    best = verified.groupBy("id", "item").agg(F.max("best").alias("best"), F.first("n_item_words").alias("n_item_words"))
    return best.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_id_col),
        F.expr("-best.d").alias("doc_word"),
        F.expr("best.n").alias("n_matched"),
        "n_item_words",
        F.expr("best.n / n_item_words").alias("coverage"),
    )

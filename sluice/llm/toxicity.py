"""Operator 4: toxicity scores from a weighted lexicon.

Text is folded (look-alike letters, accents, digits and signs that stand for
letters), and an Aho-Corasick automaton finds lexicon words and word beginnings
in it, except within exception phrases. The weights found, normalised by
length, give a calibrated probability. Lexicon and calibration are learned
from labelled rows; scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col, row_schema

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v",
    "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "m", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "γ": "y",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g", "ɩ": "i", "օ": "o", "ո": "n", "ս": "u", "հ": "h",
}
# Digits and signs that stand for letters inside a word.
_SUBSTITUTES = {
    "0": "o", "1": "i", "!": "i", "|": "i", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "8": "b",
    "9": "g", "2": "z", "6": "b",
}
_INVISIBLE = "­​‌‍⁠﻿"
_TOKEN = re.compile(r"(?:[^\W_]|[@$!|])+")
_INSIDE = str.maketrans(_SUBSTITUTES)

#: Phrases in which a word of the lexicon says nothing against anyone.
EXCEPTIONS = (
    "trash can", "trash bin", "trash talk", "clown fish", "idiot proof", "stupid simple", "worthless check",
    "not stupid", "not an idiot", "not a moron", "not a loser", "not trash", "not worthless",
)
#: Lengths of the word beginnings that may enter the lexicon.
BEGINNINGS = (4, 5, 6)
#: Distinct features a task counts before it hands them on.
COUNTED_TOGETHER = 200_000
#: Tokens a task remembers the folded forms of.
REMEMBERED_TOKENS = 1 << 18


@cache
def _letters() -> dict[int, str | None]:
    """Compatibility forms and accented letters to a-z, by Unicode's own rule."""
    table: dict[int, str | None] = {}
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x2100, 0x2190), *range(0x2460, 0x2500),
                  *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
        if plain and plain.isascii() and plain.isprintable():
            table[point] = plain.lower()
    table |= {ord(c): latin for c, latin in _LOOKALIKES.items()}
    table |= dict.fromkeys(map(ord, _INVISIBLE)) | dict.fromkeys(range(0x300, 0x370))
    return table


class _Folded(dict):
    """Token -> folded token; i and l fold together, as 1 stands for both."""

    def __missing__(self, token: str) -> str:
        if len(self) >= REMEMBERED_TOKENS:
            self.clear()
        word = token.strip("!|")
        if not word.isalpha() and any(c.isalpha() for c in word):
            word = word.translate(_INSIDE)
        word = self[token] = word.replace("l", "i")
        return word


def folded_words(text: str | None, memory: dict[str, str]) -> list[str]:
    text = (text or "").lower()
    if not text.isascii():
        text = text.translate(_letters())
    return [w for w in map(memory.__getitem__, _TOKEN.findall(text)) if w]


def word_features(word: str) -> list[str]:
    """A blank and the word's beginnings, and the whole word between blanks."""
    return [f" {word} ", *(f" {word[:n]}" for n in BEGINNINGS if len(word) > n)]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    offset: float = -4.0
    _made: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_made": {}}

    def _automaton(self):
        if "automaton" not in self._made:
            import ahocorasick

            found = ahocorasick.Automaton()
            for feature, weight in self.lexicon.items():
                found.add_word(feature, (len(feature), weight))
            for phrase in self.exceptions:
                words = " ".join(folded_words(phrase, _Folded()))
                found.add_word(f" {words} ", (len(words) + 2, None))
            found.make_automaton()
            self._made.update(automaton=found, memory=_Folded())
        return self._made["automaton"], self._made["memory"]

    def weight(self, text: str | None) -> float:
        """Weights of the words found, each word's largest, over the root of the
        number of words (and some, so that a short text is not one word)."""
        automaton, memory = self._automaton()
        words = folded_words(text, memory)
        if not words or not len(automaton):
            return 0.0
        best: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
            start = end - length + 1
            if weight is None:
                excepted.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        # Both in order of place: one pass over the spans.
        total, spans, inside = 0.0, iter(sorted(excepted)), -1
        span = next(spans, None)
        for at in sorted(best):
            while span is not None and span[0] <= at:
                inside, span = max(inside, span[1]), next(spans, None)
            if at >= inside:
                total += best[at]
        return 3 * total / math.sqrt(len(words) + 30)

    def score(self, text: str | None) -> float:
        z = self.slope * self.weight(text) + self.offset
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def fit_logistic(x: np.ndarray, n: np.ndarray, positive: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton's method on counts per value of ``x``.

    The ridge keeps the slope finite where the classes don't overlap.
    """
    a, b, total = 0.0, 0.0, max(n.sum(), 1)
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    u = x / scale
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        gradient = np.array([((n * p - positive) * u).sum() + ridge * a, (n * p - positive).sum() + 1e-6 * b])
        v = n * p * (1 - p)
        hessian = np.array([[(v * u * u).sum() + ridge, (v * u).sum()], [(v * u).sum(), v.sum() + 1e-6]])
        hessian += np.eye(2) * 1e-9 * total
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a / scale, b


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    lexicon_size: int = 20_000,
    min_docs: int = 8,
    min_weight: float = 2.5,
    min_share: float = 2.0,
    exceptions: tuple[str, ...] = EXCEPTIONS,
    weight_col: str | None = None,
) -> ToxicityModel:
    """Lexicon and calibration from rows labelled 0 or 1.

    A feature is a folded word or a word's beginning; its weight is the
    logarithm of how much more often, at the least, words of toxic documents
    have it: by its rate, since a word that clean texts hold now and then may
    fill toxic ones. The lexicon
    keeps the ``lexicon_size`` features with most evidence of those that
    ``min_docs`` toxic documents hold, with a weight of ``min_weight`` at
    least, and that ``min_share`` times as large a share of the toxic documents
    holds as of the clean ones (two standard errors against it). Counts come to the driver for these only. Without toxic or without
    clean rows the lexicon is empty and every text has the same score.

    ``weight_col`` tells how many rows of its label a sampled row stands for;
    the calibration counts it as so many, so that scores don't follow the
    sampling rates. Lexicon weights compare shares within a label.
    """
    standing_for = (col(weight_col) if weight_col else F.lit(1)).cast("decimal(28,9)")  # sums the same in any order
    rows = labelled.select(
        col(text_col).alias("text"), col(label_col).cast("int").alias("label"), standing_for.alias("n")
    ).where("label IN (0, 1)")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By label; a count is of words below one_doc, and of documents above.
        memory, counted, one_doc = _Folded(), (Counter(), Counter()), 1 << 40

        def flush() -> pa.RecordBatch:
            names = list(counted[0].keys() | counted[1].keys())
            columns = [np.fromiter((c[f] for f in names), dtype=np.int64, count=len(names)) for c in counted]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array(c % one_doc) for c in columns), *(pa.array(c // one_doc) for c in columns)],
                names=["feature", "clean", "toxic", "clean_docs", "toxic_docs"],
            )
            for c in counted:
                c.clear()
            return batch

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                words = folded_words(text.as_py(), memory)
                found: Counter[str] = Counter()
                for word, times in Counter(words).items():
                    for feature in word_features(word):
                        found[feature] += times
                found[""] = len(words)
                counter = counted[label.as_py()]
                for feature, times in found.items():
                    counter[feature] += times + one_doc
                if len(counted[0]) + len(counted[1]) > COUNTED_TOGETHER:
                    yield flush()
        yield flush()

    sums = ["clean", "toxic", "clean_docs", "toxic_docs"]
    counts = (
        rows.select("text", "label").mapInArrow(count, "feature string, " + ", ".join(f"{c} long" for c in sums))
        .groupBy("feature").agg(*[F.sum(c).alias(c) for c in sums])
        .where(f"feature = '' OR toxic_docs >= {int(min_docs)}")
    )
    total = counts.where("feature = ''").head()
    if total is None or not total["clean_docs"] or not total["toxic_docs"]:
        full = rows.agg(*[F.sum(F.when(F.col("label") == x, F.col("n"))).cast("double") for x in (0, 1)]).head()
        clean, toxic = (n or 0.0 for n in full)
        share = (toxic + 0.5) / (toxic + clean + 1) if total else 0.02
        return ToxicityModel({}, exceptions, 0.0, math.log(share / (1 - share)))
    # Rates are taken a standard error against the feature; a document's words
    # come together, so its error is that of the number of documents. Where few
    # documents hold very many of them, the documents alone must speak as well.
    least_toxic = F.col("toxic") * (1 - 1 / F.sqrt("toxic_docs"))
    most_clean = F.col("clean") * (1 + F.coalesce(F.try_divide(F.lit(1.0), F.sqrt("clean_docs")), F.lit(0.0))) + 2
    weight = F.log(least_toxic / max(total["toxic"], 1)) - F.log(most_clean / max(total["clean"], 1))
    toxic_share = F.greatest(F.col("toxic_docs") - 2 * F.sqrt("toxic_docs"), F.lit(0.5)) / total["toxic_docs"]
    clean_share = (F.col("clean_docs") + 2 * F.sqrt("clean_docs") + 2) / total["clean_docs"]
    chosen = (
        counts.where("feature <> ''").withColumn("weight", weight)
        .where((F.col("weight") >= min_weight) & (toxic_share >= min_share * clean_share))
        .orderBy((F.col("weight") * F.log1p("toxic_docs")).desc(), "feature").limit(lexicon_size)
    )
    model = ToxicityModel({r["feature"]: r["weight"] for r in chosen.collect()}, exceptions)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [round(64 * model.weight(text.as_py())) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), batch.column(1), batch.column(2)], names=["bin", "label", "n"]
            )

    bins = (
        rows.mapInArrow(weigh, "bin long, label int, n decimal(28,9)")
        .groupBy(F.least("bin", F.lit(1 << 14)).alias("bin"))
        .agg(F.sum("n").cast("double").alias("n"), F.sum(F.expr("IF(label = 1, n, 0)")).cast("double").alias("toxic"))
        .toPandas()
    )
    slope, offset = fit_logistic(bins["bin"].to_numpy() / 64, bins["n"].to_numpy(float), bins["toxic"].to_numpy(float))
    return ToxicityModel(model.lexicon, exceptions, slope, offset)


def sample_labels(labels: DataFrame, per_class: int = 20_000, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """About ``per_class`` ids of each label, by the hash of the id: few enough
    to be broadcast whatever the number of labels. ``weight`` is how many rows
    of its label a row stands for."""
    rows = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label")).where(
        "id IS NOT NULL AND label IN (0, 1)"
    )

    def count(rows: DataFrame) -> dict[int, int]:
        return {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}

    counts = count(rows)
    resolution = 1 << 30
    limit = [min(resolution, resolution * per_class // max(counts.get(x, 0), 1)) for x in (0, 1)]
    order = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(resolution))
    sample = rows.where(order < F.when(F.col("label") == 1, limit[1]).otherwise(limit[0]))
    taken = count(sample)
    weight = [counts.get(x, 0) / max(taken.get(x, 0), 1) for x in (0, 1)]
    return sample.withColumn("weight", F.when(F.col("label") == 1, weight[1]).otherwise(weight[0]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score``, from 0 to 1.

    Null and empty texts have the score of a text without a hit. An input
    column named ``score`` is replaced. Repeated rows and null ids are rows
    like any other.
    """
    docs = docs.drop("score")
    packed = docs.select(col(text_col).alias("text"), F.struct(*[col(c) for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores, pa.float64())], names=["row", "score"])

    out = packed.mapInArrow(score, row_schema(packed, "score double"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], "score")


def held_out(id_col: str = "doc_id"):
    """Rows no model may learn from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.crc32(col(id_col).cast("string")) % 3 == 1

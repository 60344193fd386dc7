"""Operator 7: language identification.

A text's hidden vector is the average of the embeddings of its hashed subwords
(character 2- to 4-grams within and across word ends); a linear softmax over
it gives the languages. Embeddings and softmax are trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows; a temperature
and the rejection thresholds are calibrated on a part of it that is not
trained on. Prediction reads every text whole, batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col, row_schema

BUCKET_BITS = 16
SIZES = (2, 3, 4)
#: Characters of a text that are hashed at once; the rest follows.
PART = 1 << 18
UNDETERMINED = "und"


@cache
def _folding() -> np.ndarray:
    """Code point -> itself if it is a letter, else the blank."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), dtype=bool, count=0x110000)
    return np.where(letter, points, np.uint32(32))


def subwords(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the text's character n-grams, part by part.

    Letters are lower-cased, everything else is a blank, one at a time, and
    the text begins and ends with one. Every n-gram comes once, wherever the
    parts meet. Yields nothing if the text has no letter.
    """
    text = f" {text.lower()} "
    before, after_blank = np.zeros(0, dtype=np.uint64), False
    for start in range(0, len(text), PART):
        part = text[start : start + PART]
        points = _folding()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        blank = points == 32
        keep = ~(blank & np.append(after_blank, blank[:-1]))
        after_blank = blank[-1]
        points = np.concatenate([before, points[keep].astype(np.uint64)])
        rolled = points
        for n in range(2, max(SIZES) + 1):
            if len(points) < n:
                break
            rolled = rolled[:-1] * np.uint64(0x100000001B3) + points[n - 1 :]
            if n in SIZES:  # without those of the parts before alone
                fresh = rolled[max(0, len(before) - n + 1) :]
                yield (fresh * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        before = points[-(max(SIZES) - 1) :]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket -> share of each language's logit, and whether it was seen
    bias: np.ndarray
    temperature: float
    least_score: float
    least_known: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        total, n = np.zeros(self.table.shape[1]), 0
        for buckets in subwords(text or ""):
            total += self.table[buckets].sum(axis=0, dtype=np.float64)
            n += len(buckets)
        if not n or not self.languages:
            return UNDETERMINED, 0.0, True
        mean = total / n
        p = _softmax((mean[:-1] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.least_score or mean[-1] < self.least_known)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(
    samples: list[tuple[np.ndarray, np.ndarray, str]],
    dim: int = 16,
    epochs: int = 8,
    rate: float = 2.0,
    held_back: int = 5,
    rejected_share: float = 0.001,
    seed: int = 11,
) -> LanguageModel:
    """Train on rows of (buckets, their shares of the text, language).

    Every ``held_back``-th row, in the given order, only calibrates: the
    temperature minimises its log loss, and a text is rejected if its
    probability or its share of n-grams seen in training is under the
    ``rejected_share`` quantile of the rows held back, and under a half of
    their median.
    """
    languages = tuple(sorted({language for *_, language in samples}))
    if not languages:
        return LanguageModel((), np.zeros((1 << BUCKET_BITS, 1), np.float32), np.zeros(0), 1.0, 0.0, 0.0)
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 1 / dim, (1 << BUCKET_BITS, dim)).astype(np.float32)
    weight, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    seen = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
    held = samples[::held_back] if len(samples) >= 10 * held_back else []
    used = [s for i, s in enumerate(samples) if not held or i % held_back]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(used)):
            buckets, share, language = used[i]
            hidden = share @ embedding[buckets]
            error = _softmax(hidden @ weight + bias)
            error[languages.index(language)] -= 1
            back = weight @ error
            weight -= step * np.outer(hidden, error)
            bias -= 0.1 * step * error
            embedding[buckets] -= step * np.outer(share, back) * min(len(buckets), 100)
            seen[buckets] = 1
    table = np.column_stack([embedding @ weight, seen]).astype(np.float32)
    if not held:
        return LanguageModel(languages, table, bias, 1.0, 0.0, 0.0)
    means = np.array([share @ table[buckets] for buckets, share, _ in held])
    logits, known = means[:, :-1] + bias, means[:, -1]
    truth = np.array([languages.index(language) for *_, language in held])

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    score = _softmax(logits / temperature).max(axis=1)
    least = [min(np.quantile(x, rejected_share), np.median(x) / 2) for x in (score, known)]
    return LanguageModel(languages, table, bias, float(temperature), float(least[0]), float(least[1]))


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    per_language: int = 600,
    **options,
) -> LanguageModel:
    """Fit on about ``per_language`` rows of each label, chosen by the hash of
    their id; only their bucket counts come to the driver."""
    rows = labelled.select(
        col(id_col).alias("id"), col(text_col).alias("text"), col(label_col).cast("string").alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit([])
    resolution = 1 << 30
    shares = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, min(resolution, resolution * per_language // n))]
    )
    order = F.xxhash64(F.lit(5), "id")
    chosen = rows.withColumn("order", order).where(
        F.pmod(order, F.lit(resolution)) < F.element_at(shares, F.col("lang"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, lang, at in zip(batch.column(0), batch.column(1), batch.column(2)):
                total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
                for buckets in subwords(text.as_py()):
                    total += np.bincount(buckets, minlength=1 << BUCKET_BITS)
                found = np.flatnonzero(total)
                if len(found):
                    shares = (total[found] / total.sum()).astype("<f4")
                    row = found.astype("<u2").tobytes(), shares.tobytes(), lang.as_py(), at.as_py()
                    for values, value in zip(out, row):
                        values.append(value)
            kinds = (pa.binary(), pa.binary(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(out, kinds)], names=["buckets", "shares", "lang", "at"]
            )

    # Six bytes a bucket; the training rows are views of the collected columns.
    sample = chosen.select("text", "lang", "order").mapInArrow(
        count, "buckets binary, shares binary, lang string, at long"
    ).toArrow().combine_chunks()
    langs, places = sample["lang"].to_pylist(), sample["at"].to_pylist()
    model = fit(
        [(np.frombuffer(sample["buckets"][i].as_buffer(), "<u2"), np.frombuffer(sample["shares"][i].as_buffer(), "<f4"), langs[i])
         for i in sorted(range(len(places)), key=lambda i: (places[i], langs[i]))],
        **options,
    )
    del sample
    pa.default_memory_pool().release_unused()
    return model


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``lang_pred``, ``score``, ``rejected``.

    ``lang_pred`` is ``und`` with score 0 for null texts, texts without a
    letter and a model that saw no labelled row; these are rejected, and so are
    texts below the calibrated thresholds. Input columns named like the three
    results are replaced. Repeated rows and null ids are rows like any other.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    packed = docs.select(col(text_col).alias("text"), F.struct(*[col(c) for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                names=["row", "lang_pred", "score", "rejected"],
            )

    out = packed.mapInArrow(predict, row_schema(packed, "lang_pred string, score double, rejected boolean"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], "lang_pred", "score", "rejected")


def held_out(id_col: str = "doc_id"):
    """Rows no model may learn from: crc32 of the id's text is divisible by 5."""
    return F.crc32(col(id_col).cast("string")) % 5 == 0

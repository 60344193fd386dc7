"""The pipeline against a plain-Python version of its stages."""

import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm.packing import load_encoder

SF = "/root/testdata/sf0.01"


def without_repeated_lines(docs):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})

    holders = {}
    for i, text in docs.items():
        for line in text.split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    first = {k: min(ids) for k, ids in holders.items() if len(ids) > 1}
    return {i: "\n".join(x for x in text.split("\n") if first.get(key(x), i) == i) for i, text in docs.items()}


def one_of_each_family(docs):
    sets = {}
    for i, text in docs.items():
        words = text.encode().lower().split()
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    label = {i: i for i in docs}
    links = [(a, b) for a in docs for b in docs
             if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in docs:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: text for i, text in docs.items() if label[i] == i}


def without_passages(docs, items):
    def tokens(text):
        return np.array([hash(w) for w in re.findall(r"[^\W_]+", text.lower())])

    def holds(doc, item):
        width, allowed = min(13, len(item)), 2 if len(item) >= 13 else len(item) // 6
        for shift in range(width - len(item), len(doc) - width + 1):
            low, high = max(0, -shift), min(len(item), len(doc) - shift)
            equal = (doc[low + shift : high + shift] == item[low:high]).astype(int)
            if len(equal) >= width and np.convolve(equal, np.ones(width, int), "valid").max() >= width - allowed:
                return True
        return False

    items = [tokens(t) for t in items]
    return {i: text for i, text in docs.items() if not any(holds(tokens(text), item) for item in items if len(item) >= 8)}


def test_pipeline_equals_plain_python(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r["text"] for r in documents.where("length(text) < 3000").limit(160).collect()}
    base = 10**6
    some = sorted(docs)[:6]
    for n, i in enumerate(some):  # exact and near copies; a passage, plain and altered; no language
        docs[base + n] = docs[i]
        docs[base + 10 + n] = docs[i].replace("\n", " ") + " ended"
        docs[base + 20 + n] = f"Some words before.\n{items[n]}"
        words = items[n + 6].split()[:20]
        words[len(words) // 2] = "altered"
        docs[base + 30 + n] = f"Some words {' '.join(words)} and after"
    docs |= {base + 40: "", base + 41: "12 34 !!", base + 42: "one line of its own that nobody repeats"}

    languages = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = [(i, t, languages.get(i, "en"), "s", len(t)) for i, t in docs.items()]
    frame = spark.createDataFrame(rows, documents.schema).repartition(4)
    for name, apply in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stage(apply(spark, frame, SF), name)
        got = frame.count()
        if name == "language_id":
            want = {i: t for i, t in docs.items() if any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            want = without_repeated_lines(want)
        elif name == "near_dedup":
            want = one_of_each_family(want)
        elif name == "decontamination":
            want = without_passages(want, items)
        if name != "packing":
            assert frame.columns == documents.columns and got == len(want)
            found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in frame.collect()}
            assert found == {i: (t, len(t)) for i, t in want.items()}
    assert not {base + 20 + n for n in range(6)} & set(want) and base + 42 in want
    encoder = load_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r["doc_id"]: r["n"] for r in frame.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == {i: len(encoder.encode_ordinary(t)) + 1 for i, t in want.items()}
    assert frame.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_near_copies_keep_one_row_of_each_group(spark):
    text = "some words that are long enough to make a shingle or two of them"
    rows = [(1, text), (1, text), (2, text), (3, "other words, of which none is in the first"), (3, "and a text of its own"),
            (4, None), (4, None), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS row_text")
    got = sorted((tuple(r) for r in corpus_pipeline.near_copies(spark, docs, SF).collect()), key=repr)
    want = [(1, text, "x"), (3, rows[3][1], "x"), (3, rows[4][1], "x"), (4, None, "x"), (None, text, "x"), (None, text, "x")]
    assert got == sorted(want, key=repr)

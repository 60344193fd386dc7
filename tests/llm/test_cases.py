"""Each operator on awkward rows: nulls, empty and long texts, repeats, ties,
empty tables, and extra columns named like internal or result columns."""

import pytest
from pyspark.sql import functions as F

from sluice.llm import language_id, toxicity
from sluice.llm.decontaminate import find_overlaps
from sluice.llm.embedding_dedup import near_duplicate_vectors
from sluice.llm.html_extract import extract
from sluice.llm.license_scan import scan_licenses
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.minhash_dedup import near_duplicates
from sluice.llm.packing import pack_documents
from sluice.llm.queries import tokenizer_path
from sluice.llm.sharding import shard

EXTRA = {  # clash with names that the operators use inside or return
    "row": "r", "id": "i", "pos": "p", "h1": "h", "line": "l", "n_lines": "n", "node": "n", "key": "k", "a": "a",
    "component_id": "c", "score": "s", "lang_pred": "x", "depth": "d", "prefix": "p", "sequence_id": "q", "length": "z",
    "odd.name": "o", "version": "v", "w": "w", "seed": "s", "label": "l", "kept": "k",
}
LONG = " ".join(f"word{i} and\n" * 2 for i in range(20_000))
ROWS = [
    (1, "A shared line of text\nown one of the first", "en"),
    (2, "  a SHARED line of text \nown one of the second", "en"),
    (2, "  a SHARED line of text \nown one of the second", "en"),  # repeated row
    (2, "a shared line of text\nthe same id with other words", None),
    (None, "a shared line of text\nof no document", None),
    (None, None, None), (3, None, "en"), (4, "", "en"), (5, " \t\n\x0b", None), (6, "1234 5678 !!", "en"), (7, LONG, "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return rows.select("*", *[F.lit(v).alias(n) for n, v in EXTRA.items()]).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_line_dedup(docs, none):
    out = dedup_lines(docs)
    assert {"odd.name", "version", "row"} <= set(out.columns) and out.columns.count("n_lines") == 1
    got = rows(out.where("doc_id < 7 OR doc_id IS NULL"), "doc_id", "text", "n_lines", "n_dropped")
    assert got == sorted([
        (1, "A shared line of text\nown one of the first", 2, 0),
        (2, "own one of the second", 2, 1), (2, "own one of the second", 2, 1),
        (2, "the same id with other words", 2, 1),
        (None, "a shared line of text\nof no document", 2, 0), (None, "", 1, 0),
        (3, "", 1, 0), (4, "", 1, 0), (5, " \t\n\x0b", 2, 0), (6, "1234 5678 !!", 1, 0),
    ], key=repr)
    assert out.where("doc_id = 7").head()["text"] == LONG
    assert dedup_lines(none).count() == 0


def test_line_dedup_of_a_very_long_document(spark):
    import time

    shared = [f"a line that both of them hold {i}" for i in range(1000)]
    own = [f"own line {i} of it" for i in range(300_000)]
    mixed = own[:100_000] + shared + own[100_000:]
    docs = spark.createDataFrame([(1, "\n".join(shared)), (2, "\n".join(mixed))], "doc_id long, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    assert got[2]["text"] == "\n".join(own) and got[2]["n_dropped"] == 1000 and got[1]["n_dropped"] == 0
    assert time.perf_counter() - start < 60


def test_license_scan(spark, docs, none):
    assert scan_licenses(docs).count() == 0 and scan_licenses(none).count() == 0
    odd = spark.createDataFrame([(None, "x\nReleased under the MIT License. y"), (1, "MIT")], "doc_id long, text string")
    assert rows(scan_licenses(odd.union(odd)), "doc_id", "license", "start_char") == [(None, "mit-line", 2)] * 2
    assert scan_licenses(odd, templates={}).count() == 0 and scan_licenses(odd, templates={"e": ""}).count() == 0


def test_near_duplicates(docs, none):
    got = rows(near_duplicates(docs).where("doc_id < 7 OR doc_id IS NULL"), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted([
        (1, 6, 1, True), (2, 6, 2, True), (2, 6, 2, True), (2, 7, 2, True), (None, 4, None, True),
        (None, 0, None, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True),
    ], key=repr)
    assert near_duplicates(none).count() == 0


def test_toxicity(docs, none):
    labelled = docs.where("doc_id IN (1, 2)").withColumn("toxic", F.col("doc_id") - 1)
    model = toxicity.train(labelled, min_docs=1, min_weight=0.1)
    scored = toxicity.score_toxicity(docs, model)
    assert scored.count() == len(ROWS) and scored.where("score BETWEEN 0 AND 1").count() == len(ROWS)
    assert scored.where("text IS NULL OR text = ''").select("score").distinct().count() == 1
    for rest in (none, docs.where("doc_id = 1")):
        unknown = toxicity.train(rest.withColumn("toxic", F.lit(0)))
        assert unknown.lexicon == {} and 0 <= unknown.score("anything") < 0.7
    assert toxicity.score_toxicity(none, model).count() == 0


def test_html_extract(spark, none):
    pages = spark.createDataFrame(
        [(1, "u", None), (1, "u", None), (None, None, ""), (2, "u", "<p>"), (3, "u", "plain &amp; simple"),
         (4, "u", "<div>" * 50_000 + "deep" + "</div>" * 50_000), (5, "u", "<p>one<p>two <!-- never closed"),
         (6, "u", "<p>x</p>" * 100_000)],
        "page_id long, url string, html string",
    ).withColumns({"row": F.lit(1), "text": F.lit("old")})
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert got == {1: "", None: "", 2: "", 3: "plain & simple", 4: "deep", 5: "one\ntwo", 6: "\n".join(["x"] * 100_000)}
    assert extract(pages).count() == 8 and extract(pages.where("false")).count() == 0


def test_packing(docs, none):
    out = pack_documents(docs, tokenizer_path())
    assert out.where("piece = 0").count() == len(ROWS)
    assert rows(out.where("doc_id IN (3, 4)"), "doc_id", "length") == [(3, 1), (4, 1)]
    assert pack_documents(none, tokenizer_path()).count() == 0


def test_language_id(docs, none):
    model = language_id.train(docs)
    got = rows(language_id.identify(docs, model), "doc_id", "lang_pred", "rejected")
    assert [g[1] for g in got if g[0] in (3, 4, 5, 6)] == ["und"] * 4 and (1, "en", False) in got and len(got) == len(ROWS)
    unknown = language_id.train(none)
    assert {r["lang_pred"] for r in language_id.identify(docs, unknown).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0


def test_sharding(spark, docs, none):
    out = shard(docs, 1000)
    assert out.count() == len(ROWS) and out.where("shard_bytes > 1000").count() == 1  # the long row, alone
    assert shard(none, 1000).count() == 0
    # One key with most of the rows parts by its texts; rows alike stay together.
    hot = spark.range(3000).selectExpr("if(id < 2000, 7, id) AS doc_id", "if(id < 900, 'same', cast(id AS string)) AS text")
    sharded = shard(hot, 100)
    over = sharded.groupBy("depth", "prefix", "overflow").agg(
        F.sum("n_bytes").alias("b"), F.first("shard_bytes").alias("s"), F.count_distinct("text").alias("texts"))
    assert over.where("b <> s").count() == 0
    assert rows(over.where("b > 100"), "b", "texts") == [(3600, 1)]


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame(
        [(1, "one two three four five six seven eight nine ten"), (2, None), (3, "too short"), (None, ""),
         (1, "one two three four five six seven eight nine ten")], "item_id long, text string"
    ).withColumns({n: F.lit(v) for n, v in EXTRA.items()})
    assert find_overlaps(docs, bench).count() == 0 and find_overlaps(none, bench).count() == 0
    assert find_overlaps(docs, bench.where("false")).count() == 0
    hit = spark.createDataFrame(
        [(None, "x ONE two, three four FIVE-six seven eight nine ten"), (5, "one two three four five six seven eight")] * 2,
        "doc_id long, text string")
    assert rows(find_overlaps(hit, bench), "doc_id", "item_id", "n_matched") == [(None, 1, 10)]


def test_embeddings(spark):
    v, w = [3.0, 4.0], [-4.0, 3.0]
    nan, inf = float("nan"), float("inf")
    data = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, [6.0, 8.0], 0), (4, w, 0), (5, v, 1), (6, v, None), (7, None, 0), (8, [], 0),
        (9, [0.0, 0.0], 0), (10, [nan, 1.0], 0), (11, [inf, 1.0], 0), (12, [None, 1.0], 0), (13, [3.0, 4.0, 0.0], 0), (None, v, 0),
    ]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumns(
        {n: F.lit(x) for n, x in EXTRA.items() if n != "label"})
    got = rows(near_duplicate_vectors(vectors), "vec_id", "n_links", "component_id", "kept")
    want = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 3, 1, False), (None, 0, None, True)]
    want += [(i, 0, i, True) for i in range(4, 14)]
    assert got == sorted(want, key=repr)
    assert near_duplicate_vectors(vectors.where("false")).count() == 0

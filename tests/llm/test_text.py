"""Operators 2, 4, 5, 6, 7, 8 and 9 and the pipeline against brute force, exact
round trips and held-out accuracy."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import decontaminate, language_id, license_scan, packing, toxicity
from sluice.llm.decontaminate import find_overlaps
from sluice.llm.html_extract import main_text
from sluice.llm.license_scan import TEMPLATES, scan_licenses
from sluice.llm.packing import pack_documents, plan_patterns
from sluice.llm.queries import LLM_QUERIES, tokenizer_path
from sluice.llm.sharding import shard, write_shards

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Operator 2


def words_of(text):
    return [w.lower() for w in re.findall(r"\w+", text)]


def whole_alignment(doc, template):
    """(score, matched, first, beyond) of the best local alignment anywhere
    that drifts by no more than a band's width."""
    none = (0, 0, 0, 0, 0)  # score, matched, first word, least and greatest diagonal
    best, above = (0, 0, 0, 0), [none] * (len(doc) + 1)
    for row, word in enumerate(template):
        here = [none]
        for at, other in enumerate(doc):
            moves = []
            for (score, matched, first, low, high), gain in ((above[at], 2 if word == other else -1), (above[at + 1], -1), (here[at], -1)):
                if score:
                    low, high = min(low, at - row), max(high, at - row)
                elif gain == 2:
                    first, low, high = at, at - row, at - row
                if high - low <= 2 * license_scan.BAND:
                    moves.append((score + gain, matched + (gain == 2), first, low, high))
            cell = max(moves, key=lambda c: c[0], default=none)
            here.append(cell if cell[0] > 0 else none)
            if cell[0] > best[0]:
                best = (*cell[:3], at + 1)
        above = here
    return best


def brute_places(doc, template, least):
    if sum((Counter(doc) & Counter(template)).values()) < least:
        return []
    _, matched, first, beyond = whole_alignment(doc, template)
    if not matched or matched < least:
        return []
    left = brute_places(doc[:first], template, least)
    right = [(m, f + beyond, b + beyond) for m, f, b in brute_places(doc[beyond:], template, least)]
    return [*left, (matched, first, beyond), *right]


def test_license_scan_finds_every_place_and_its_span(spark, documents):
    """Against unbanded alignments of every template with every short document."""
    some = [(r["doc_id"], r["text"]) for r in documents.collect() if len(r["text"]) < 700][:60]
    rng = np.random.default_rng(1)
    for n, (name, template) in enumerate(TEMPLATES.items()):
        words = template.split()
        some.append((10**6 + n, f"before it\n{template} {template}\nand {template}"))
        if len(words) > 20:  # two words changed, one dropped, one put in
            for at in rng.choice(np.arange(5, len(words) - 5), 2, replace=False):
                words[at] = "changed"
            del words[7]
            words.insert(12, "inserted")
        some.append((2 * 10**6 + n, "before it\n" + " ".join(words) + "\nafter it"))
    some.append((3 * 10**6, "All rights reserved. All rights reserved. All rights kept. Released under the MIT License. Or "
                 "released under the MIT license"))
    want = {}
    for i, text in some:
        doc = words_of(text)
        for name, template in TEMPLATES.items():
            least = words_of(template)
            for matched, first, beyond in brute_places(doc, least, 0.8 * len(least)):
                want[i, name, first, beyond] = matched
    rows = spark.createDataFrame(some, "doc_id long, text string")
    got = scan_licenses(rows).collect()
    assert {(r["doc_id"], r["license"], r["start_word"], r["end_word"]): r["n_matched"] for r in got} == want
    text_of = dict(some)
    for r in got:
        span = text_of[r["doc_id"]][r["start_char"] : r["end_char"]]
        assert len(words_of(span)) == r["end_word"] - r["start_word"]
        assert r["coverage"] == r["n_matched"] / r["n_template_words"] >= 0.8
    of = lambda i: [r["license"] for r in got if r["doc_id"] == i]
    assert of(3 * 10**6) == ["all-rights-reserved"] * 2 + ["mit-line"] * 2
    number = list(TEMPLATES).index("bsd-3-clause")
    assert of(10**6 + number) == ["bsd-3-clause"] * 3 and of(2 * 10**6 + number) == ["bsd-3-clause"]


def test_many_places_take_time_in_proportion(spark):
    import time

    index, memory = license_scan.Index(TEMPLATES), license_scan._Words()
    start = time.perf_counter()
    found = list(index.scan("All rights reserved. " * 20_000, 0.8, memory))
    assert len(found) == 20_000 and [f[4] for f in found] == list(range(0, 60_000, 3))
    assert time.perf_counter() - start < 60


# Operator 4


def test_folding():
    memory = toxicity._Folded()
    plain = toxicity.folded_words("Idiot clown stupid", memory)
    assert toxicity.folded_words("1d10t сlоwn $tup!d!!", memory) == plain
    assert toxicity.folded_words("ＩＤＩＯＴ cl​own stúpïd", memory) == plain
    assert toxicity.folded_words("2024 7pm", memory)[0] == "2024"


def test_toxicity_of_planted_words(spark, documents):
    """Insults planted in half of the clean documents, some disguised in the
    held-out part; the model must find them there and leave the rest alone."""
    insults = ["blorgface", "snartly", "grumpfist"]
    disguised = {"blorgface": "bl0rgf4ce", "snartly": "sn@rtly", "grumpfist": "grumрfist"}  # Cyrillic р
    clean = documents.where("lang = 'en'").select("doc_id", "text")
    marked = clean.withColumn("toxic", (F.xxhash64("doc_id") % 2 == 0).cast("int"))
    held_out = toxicity.held_out()
    insult = F.element_at(F.array(*map(F.lit, insults)), (F.col("doc_id") % 3 + 1).cast("int"))
    hidden = F.element_at(F.array(*[F.lit(disguised[i]) for i in insults]), (F.col("doc_id") % 3 + 1).cast("int"))
    word = F.when(held_out, hidden).otherwise(insult)
    planted = marked.withColumn("text", F.when(F.col("toxic") == 1, F.concat("text", F.lit(" "), word)).otherwise(F.col("text")))
    model = toxicity.train(planted.where(~held_out))
    scored = toxicity.score_toxicity(planted.where(held_out), model).toPandas()
    assert len(scored) > 100 and ((scored["score"] >= 0.7) == (scored["toxic"] == 1)).mean() > 0.97
    assert model.score("") < 0.7 and 0 <= model.score(None) <= 1


@pytest.mark.parametrize("lang, recall", [("en", 0.85), ("de", 0.9), ("es", 0.9), ("fr", 0.6)])
def test_toxic_texts_of_each_language(toxic_at_sf01, lang, recall):
    toxic, clean = (toxic_at_sf01.get((lang, x)) for x in (1, 0))
    assert toxic[1] >= recall * toxic[0] and clean[1] <= 0.01 * clean[0]


@pytest.fixture(scope="module")
def toxic_at_sf01(spark):
    """(language, label) -> held-out rows and those predicted toxic."""
    sf = "/root/testdata/sf0.1"
    scored = LLM_QUERIES["op4_toxicity"](spark, sf).where("held_out")
    joined = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    counts = joined.groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("hit")).collect()
    return {(r["lang"], r["toxic"]): (r["n"], r["hit"]) for r in counts}


def test_exceptions_and_length():
    model = toxicity.ToxicityModel({" trash ": 5.0, " moron": 5.0}, slope=4.0, offset=-3.0)
    assert model.weight("you trash") > 0 and model.weight("the trash can") == 0
    assert model.weight("moronic " + "word " * 500) < model.weight("moronic word")


def test_many_exceptions_take_time_in_proportion():
    import time

    model = toxicity.ToxicityModel({" trash ": 5.0, " can ": 1.0})
    start = time.perf_counter()
    assert model.weight("trash can " * 200_000) == 0 and model.weight("trash can trash") > 0
    assert time.perf_counter() - start < 20


def test_sampled_labels_are_bounded(spark):
    labels = spark.range(20_000).selectExpr("id AS doc_id", "int(id % 10 = 0) AS toxic")
    got = {r["label"]: r["count"] for r in toxicity.sample_labels(labels, 500).groupBy("label").count().collect()}
    assert all(400 < n < 600 for n in got.values())


def test_scores_do_not_follow_the_sampling_rates(spark):
    """A tenth is toxic; a word that 60 % of these and 6 % of the others hold
    makes a text toxic with a probability of about 0.53, sampled or not."""
    rows = spark.range(12_000).selectExpr(
        "id AS doc_id", "int(id % 10 = 0) AS toxic",
        "concat('some text here', IF(pmod(xxhash64(id), 100) < IF(id % 10 = 0, 60, 6), ' snartly', '')) AS text")
    scores = []
    for per_class in (500, 20_000):
        labels = toxicity.sample_labels(rows.select("doc_id", "toxic"), per_class)
        labelled = rows.select("doc_id", "text").join(labels.toDF("doc_id", "toxic", "weight"), "doc_id")
        model = toxicity.train(labelled, min_weight=1.0, weight_col="weight")
        scores.append([model.score("some text here snartly"), model.score("some text here")])
    assert np.abs(np.subtract(*scores)).max() < 0.1 and abs(scores[1][0] - 0.53) < 0.1
    only = toxicity.sample_labels(rows.where("toxic = 0").select("doc_id", "toxic"), 500)
    labelled = rows.select("doc_id", "text").join(only.toDF("doc_id", "toxic", "weight"), "doc_id")
    assert toxicity.train(labelled, weight_col="weight").score("x") == pytest.approx(0.5 / 10_801)


# Operator 5


@pytest.mark.parametrize("html, text", [
    ('<header><a href="/">Home</a></header><nav>Menu</nav><article><h1>T &amp; U</h1><p>A,  b\n c<br>d.</p>'
     '<div class="ad">Buy</div><aside>See</aside><p>E <a href="x">f</a> g.</p><section class="comments"><p>So, very, nice</p>'
     '</section></article><footer>F</footer>', "T & U\nA, b c d.\nE f g."),
    ('<div id="menu"><a>A</a></div><div class="post"><p>One, two, three and some more words here.</p><p>End.</p></div>'
     '<div class="cookie-notice">Cookies, cookies, cookies, all of them, and many more</div>', "One, two, three and some more words here.\nEnd."),
    ("<main><p>x<script>var a='</p>';</script> y<style>p{}</style></p><form><input><p>Sign</p></form><ul><li>a<li>b</ul></main>", "x y\na\nb"),
    ('<div class="header">Site, name, and a slogan</div><div id="content"><div class="header"><p>Also no text</p></div>'
     '<p>Text, of, the, page, which goes on for a while.</p><ins class="adsbygoogle">Ad</ins></div>',
     "Text, of, the, page, which goes on for a while."),
    ('<main><div class="header"><h1>Own</h1></div><p>a, b</p><p hidden>c</p><p style="display: none">d</p></main>', "Own\na, b"),
    ("<article><p>&lt;b&gt; &eacute;&#8212;&#x41;</article>", "<b> é—A"),
    ('<article><p>Body, of, it.</p><article class="comment"><p>Not, this, one</p></article></article>', "Body, of, it."),
])
def test_main_text(html, text):
    assert main_text(f"<!DOCTYPE html><html><head><title>X</title></head><body>{html}</body></html>") == text
    assert main_text(html) == text


@pytest.mark.parametrize("page", [
    "<head><title>X</title><body>{}</body></html>", "<html><head><meta charset=utf-8><title>X</title><body>{}",
    "<head><title>X</title>{}", "<html><head><script>var a;</script><link rel=x><BODY class=a>{}</html>",
    "<html><body>{}", "<title>X</title>{}", "<head></head>{}</body>", "<head><title>X</title><noscript>y</noscript><header>Site</header>{}",
])
def test_main_text_with_omitted_tags(page):
    article = "<article><h1>T</h1><p>One, two, three.<p>Four.</article>"
    assert main_text("<!DOCTYPE html>" + page.format(article)) == "T\nOne, two, three.\nFour."
    plain = "<p>One, two, three and some more words here.</p><p>End.</p>"
    assert main_text(page.format(plain)) == "One, two, three and some more words here.\nEnd."


_SECTION = "<p>" + "One, two, three, four, five, six, seven, eight, nine, ten, eleven, twelve. " * 2 + "{}</p>"


@pytest.mark.parametrize("html, ends", [
    ("<div id=content>" + "".join(f"<div class=row><div class=col>{_SECTION.format(n)}</div></div>" for n in "ABC")
     + "<div class=row><div class=col><p>Short D</p></div></div></div>", "ABCD"),
    ("".join(f"<div class=row><div class=col>{_SECTION.format(n)}</div></div>" for n in "AB"), "AB"),
    ("<h1>Out</h1><article><div><div><div><div>" + _SECTION.format("A") + "</div></div></div><div>" + _SECTION.format("B")
     + "</div></div></article><div class=list><a href=x>Some, link</a></div>", "AB"),
    ("<main><ul><li><a href=x>In</a></ul><article><div><div><div><div>" + _SECTION.format("A")
     + "</div></div></div></div></article></main>", "A"),
])
def test_main_text_of_wrapped_sections(html, ends):
    for page in (html, f"<html><head><title>X</title></head><body><nav>Menu</nav>{html}<footer>F</footer></body></html>"):
        assert "".join(line[-1] for line in main_text(page).split("\n")) == ends


def test_main_text_of_inline_tags_after_an_omitted_head():
    assert main_text("<head><title>X</title>One, two <b>three</b>, <a href=x>4</a>.<p>Five.") == "One, two three, 4.\nFive."


PROSE = "The long sentence goes on, with commas, and says something at its end. " * 4


@pytest.mark.parametrize("name", [
    "has-sidebar", "content no-sidebar", "post tag-news category-alerts", "with-comments", "is-promo", "status-alert"])
def test_containers_keep_their_text_whatever_they_say_of_the_page(name):
    page = f'<body><div class="main-nav">Menu</div><div class="{name}"><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p></div></body>'
    assert main_text(page).startswith("Title\nThe long") and main_text(page).count("commas") == 8 and "Menu" not in main_text(page)
    inner = f'<body><div class="{name} sidebar"><article><h1>Title</h1><p>{PROSE}</p></article></div><div class="sidebar">S</div></body>'
    assert main_text(inner) == f"Title\n{PROSE.strip()}"


def test_sections_of_an_article_by_what_they_hold():
    links = "".join(f'<li><a href="/{i}">Another story of the day {i}</a></li>' for i in range(6))
    page = (f'<article><h1>T</h1><p>{PROSE}</p><section class="related"><h2>Related work</h2><p>{PROSE}</p></section>'
            f'<section class="discussion"><p>{PROSE}</p></section><section class="related-posts"><ul>{links}</ul></section>'
            f'<div class="comments"><p>{PROSE}</p></div><p>Enter <label>a name</label> or <math>x + y</math> here.</p></article>')
    text = main_text(page)
    assert text.count("commas") == 12 and "Related work" in text and "Another story" not in text
    assert text.endswith("Enter a name or x + y here.")


def test_quotes_count_only_after_an_equals_sign():
    assert main_text("<p title=don't>First</p><p>It's second</p><p>third</p>") == "First\nIt's second\nthird"
    assert main_text('<p " class=x>one</p><p title="a > b">two</p><p title = \'c > "d"\'>three</p>') == "one\ntwo\nthree"


@pytest.mark.parametrize("piece", [
    "<a b", '<a b="', "<p title='", "<iframe>x", "<span class=ad>x", '<div class="ad">x', "<article>x", "<header>x",
    "<center>x", "<main><section class=related>x", "= <a ="])
def test_time_grows_with_the_page(piece):
    import time

    def seconds(n):
        start = time.perf_counter()
        main_text(piece * n + '"')
        return time.perf_counter() - start

    n = 200_000 // len(piece)
    small = min(seconds(n) for _ in range(2))
    assert seconds(8 * n) < 24 * small + 1.0  # 1.6 MB


def test_nested_and_stray_end_tags_grow_with_the_page():
    import time

    start = time.perf_counter()
    main_text("<li><article>" + "<div>" * 50_000 + "</li>" * 50_000)
    main_text("<dd><ul>" + "<center>" * 50_000 + "<dt>x" * 50_000)
    assert time.perf_counter() - start < 30


def test_main_text_of_pages(spark):
    """The pages' articles, cut out by their own markers."""
    import html as entities

    for r in LLM_QUERIES["op5_html_extract"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
        blocks = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


# Operator 6


def test_tokens_equal_the_tokenizers_library(documents):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    reference.encode_special_tokens = True
    texts = [r["text"] for r in documents.limit(150).collect()]
    texts += ["", " ", "\n\n \t x", "don't WE'LL", "<|endoftext|> x", "emoji 👩‍👩‍👧 é é ﬁ 中文 ١٢٣ x²", "a" * 5000, " " * 300 + "b"]
    ours = packing.load_encoder(tokenizer_path())
    assert [ours.encode_ordinary(t) for t in texts] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_tokens_of_very_long_white_space():
    from tokenizers import Tokenizer

    reference, ours = Tokenizer.from_file(tokenizer_path()), packing.load_encoder(tokenizer_path())
    texts = [before + run + after for before in ("", "a", "a. ") for after in ("", "b", "\n.", " 1")
             for run in (" " * 999, " " * 1001, "\n" * 1500, " \t\r\n\x0b\x0c\x85\xa0\u2003\u2028\u3000" * 200, "\x1c" * 1200)]
    texts += [" " * 3_000_000 + "a", "a" + "\n" * 3_000_000, "a" + "\n" * 2_000_000 + " " * 1_000_000 + "\nb"]
    for text in texts:
        assert packing.encode(ours, text) == reference.encode(text, add_special_tokens=False).ids


def test_added_tokens_equal_the_unaltered_library(spark):
    from tokenizers import Tokenizer

    reference, ours = Tokenizer.from_file(tokenizer_path()), packing.load_encoder(tokenizer_path())
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f" {end}\n\n{end}  x", f"{end[:-1]} >{end}>", f"<{end}", f"a{end.upper()}",
             f"{' ' * 1200}{end}{chr(10) * 1200}b"]
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    assert [packing.encode(ours, t) for t in texts] == want and want[0] == [64, 220, 50256, 275]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in pack_documents(rows, tokenizer_path(), with_ids=True).where("piece = 0").collect()}
    assert all(got[n] == [*ids, 0] for n, ids in enumerate(want) if len(ids) < 2048)


def test_packing_round_trip(spark, documents):
    out = pack_documents(documents, tokenizer_path(), with_ids=True).toPandas()
    encoder = packing.load_encoder(tokenizer_path())
    out = out.sort_values(["doc_id", "piece"])
    for (doc_id, pieces), r in zip(out.groupby("doc_id"), documents.orderBy("doc_id").collect()):
        ids = [*encoder.encode_ordinary(r["text"]), 0]
        assert np.concatenate(pieces["ids"].to_list()).tolist() == ids and r["doc_id"] == doc_id
        assert len(pieces) == -(-len(ids) // 2048) and (pieces["length"].iloc[1:] == 2048).all()
        assert (pieces["start"] == pieces["length"].cumsum() - pieces["length"]).all()
    for ids, crc in zip(out["ids"], out["ids_crc32"]):
        assert zlib.crc32(np.asarray(ids, dtype="<u4").tobytes()) == crc
    for _, s in out.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all() and s["length"].sum() <= 2048
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 2048) + 1


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 64, 500):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, capacity + 1, 40), rng.integers(1, 900, 40))}
        plan = plan_patterns(counts, capacity)
        used = dict.fromkeys(counts, 0)
        for pattern, times in plan:
            assert sum(pattern) <= capacity and times > 0
            for n in pattern:
                used[n] += times
        assert used == counts
    assert plan_patterns({5: 4, 3: 2, 2: 6}, 10) and plan_patterns({}, 10) == []
    assert sum(t for _, t in plan_patterns({6: 10, 4: 10, 5: 3, 3: 3, 2: 3}, 10)) == 13


# Operator 7


def test_language_accuracy_on_held_out_rows(spark):
    found = LLM_QUERIES["op7_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert found["rejected"].mean() < 0.005 and found["score"].between(0, 1).all()


def test_prediction_ignores_the_batch_and_reads_long_texts(monkeypatch):
    text = "der die das und ein\n" * 50
    whole = np.sort(np.concatenate(list(language_id.subwords(text))))
    for part in (1, 2, 3, 64, 1000):
        monkeypatch.setattr(language_id, "PART", part)
        parts = np.sort(np.concatenate(list(language_id.subwords(text))))
        assert (parts == whole).all()


@pytest.mark.parametrize("text", ["", " ", "12 !?", "\n" * 50])
def test_texts_without_letters_have_no_subwords(monkeypatch, text):
    for part in (1, 3, 1 << 18):
        monkeypatch.setattr(language_id, "PART", part)
        assert sum(map(len, language_id.subwords(text))) == 0


def test_long_texts_hold_every_subword_once():
    words = "ein Text mit vielen   Wörtern, 12 Zeilen und mehr\n"
    once, twice = (np.bincount(np.concatenate(list(language_id.subwords(words * n))), minlength=1 << 16) for n in (1, 2))
    many = np.bincount(np.concatenate(list(language_id.subwords(words * 20_000))), minlength=1 << 16)
    assert len(words) * 20_000 > 3 * language_id.PART
    assert (many == once + 19_999 * (twice - once)).all()


# Operator 8


def test_sharding_equals_splitting_by_hand(spark, documents):
    limit = 40_000
    got = shard(documents, limit).select("doc_id", "depth", "prefix", "n_bytes", "shard_bytes").toPandas()
    import hashlib

    rows = [(r["doc_id"], int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16), len(r["text"].encode()))
            for r in documents.collect()]
    want, buckets = {}, [(0, rows)]
    while buckets:
        depth, bucket = buckets.pop()
        size = sum(b for _, _, b in bucket)
        if size <= limit or len(bucket) == 1:
            want |= {i: (depth, h >> 60 - depth, size) for i, h, _ in bucket}
        else:
            for bit in (0, 1):
                if half := [r for r in bucket if (r[1] >> 59 - depth) & 1 == bit]:
                    buckets.append((depth + 1, half))
    assert {r.doc_id: (r.depth, r.prefix, r.shard_bytes) for r in got.itertuples()} == want


def test_shards_are_written_as_folders(spark, documents, tmp_path):
    sharded = shard(documents, 400_000)
    write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == documents.count()
    assert len(list((tmp_path / "shards").glob("*/*/*/*.parquet"))) == sharded.select("depth", "prefix").distinct().count()


# Operator 9


def test_masks_hit_every_window_with_two_substitutions():
    for n in range(decontaminate.SUBSTITUTIONS + 1):
        for changed in itertools.combinations(range(decontaminate.WINDOW), n):
            assert any(
                not {at + o for o in mask} & set(changed)
                for mask in decontaminate.MASKS for at in range(decontaminate.WINDOW - decontaminate.SPAN + 1)
            )


def test_masks_hit_short_items_with_a_sixth_substituted():
    masks = (*decontaminate.MASKS, decontaminate.SHORT_MASK)
    for size in range(decontaminate.SPAN, decontaminate.WINDOW):
        for changed in itertools.combinations(range(size), size // 6):
            assert any(
                not {at + o for o in mask} & set(changed) for mask in masks for at in range(size - mask[-1])
            )


def test_short_items_and_scripts_without_blanks(spark):
    """Items of 1 to 12 words with every choice of a sixth of their words
    changed, and with one changed too many; Chinese and Thai sentences."""
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 13)}
    docs, want = [], set()
    for n, words in items.items():
        allowed = n // 6 if n >= 8 else 0
        for much in (allowed, allowed + 1):
            for changed in itertools.combinations(range(n), much):
                part = ["changed" if k in changed else w for k, w in enumerate(words)]
                doc_id = len(docs)
                docs.append((doc_id, " ".join(part if doc_id % 2 else ["before", *part, "after"])))
                if much == allowed:
                    want.add((doc_id, n))
    chinese, thai = "水在标准大气压下的沸点是多少摄氏度", "น้ำเดือดที่อุณหภูมิเท่าใด"
    bench = [(n, " ".join(words)) for n, words in items.items()] + [(20, chinese), (21, thai)]
    for item_id, text in ((20, "请问，" + chinese.replace("标准", "普通") + "？"), (21, "ถาม " + thai), (None, "标准大气压")):
        if item_id:
            want.add((len(docs), item_id))
        docs.append((len(docs), text))
    bench = spark.createDataFrame(bench, "item_id long, text string")
    got = find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("seeds_per_broadcast", [400_000, 500])
def test_overlaps_equal_all_alignments(spark, documents, seeds_per_broadcast):
    """Own documents with exact, altered and too altered passages, compared
    with every alignment of every document and item."""
    rng = np.random.default_rng(4)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    docs = [(r["doc_id"], r["text"]) for r in documents.where("length(text) < 2500").limit(120).collect()]
    for n, item in enumerate(bench):
        words = item["text"].split()
        start = int(rng.integers(0, max(1, len(words) - 20)))
        part = words[start : start + 20]
        for at in rng.choice(len(part), min(len(part), n % 8), replace=False):
            part[at] = "altered"
        docs.append((10**6 + n, "some words first " + " ".join(part).upper() + " and some after"))

    def tokens(text):
        return np.array([hash(w) for w in re.findall(r"[^\W_]+", text.lower())])

    items = {r["item_id"]: tokens(r["text"]) for r in bench}
    want = {}
    for doc_id, text in docs:
        doc = tokens(text)
        for item_id, item in items.items():
            width = min(13, len(item))
            allowed = 2 if len(item) >= 13 else len(item) // 6
            for shift in range(-len(item) + 1, len(doc)):
                low, high = max(0, -shift), min(len(item), len(doc) - shift)
                if high - low < width:
                    continue
                equal = (doc[low + shift : high + shift] == item[low:high]).astype(int)
                if np.convolve(equal, np.ones(width, int), "valid").max() >= width - allowed:
                    best = (int(equal.sum()), -shift)
                    want[doc_id, item_id] = max(want.get((doc_id, item_id), best), best)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = find_overlaps(frame, spark.read.parquet(f"{SF}/benchmark.parquet"), seeds_per_broadcast=seeds_per_broadcast)
    got = {(r["doc_id"], r["item_id"]): (r["n_matched"], -r["doc_word"]) for r in found.collect()}
    assert got == want and len(want) > 20


# The pipeline


def test_pipeline_stages(spark, documents):
    from pyspark.sql import functions as F

    odd = documents.limit(150).union(spark.createDataFrame(
        [(10**6, "12 34", None, None, 5), (10**6 + 1, None, None, None, None)], documents.schema))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").head()
    leak = spark.createDataFrame([(10**6 + 2, "Read this: " + bench["text"], "en", "s", 9)], documents.schema)
    docs, counts = odd.union(leak).withColumn("n_chars", F.length("text").cast("long")), []
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, SF), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == documents.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    assert not ids & {10**6, 10**6 + 1, 10**6 + 2} and counts[0] == 151 and counts[3] > 100

"""Odd tables, executors without the repository, and operators against slow versions of themselves."""

import json
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import cover_tree, html_extract, language_id, license_scan, ngram_join, poisson_mix, quality_gam, scratch, sentencepiece_codec, url_filter, va_search
from skyledger.llm.piece_trie import SPACE, build_trie

from ..conftest import DATA
from .test_llm import ODD, SF, brute_components, cloud, sets_of, vectors

REPO = Path(__file__).resolve().parents[2]
#: Names that operators use inside or give to results, and some that only differ in case.
CLASHES = ["ids", "n_ids", "restored", "piece_ids", "score", "lang_pred", "features", "predicted", "copy", "shuffle_key", "r_source", "mix_source", "r_salt", "_text", "_ids", "part", "component_id", "id", "row", "n", "sig1", "s", "k0", "c0", "i0", "rule", "verdict", "host", "path", "key", "Score", "embedding2", "dim", "u", "cells", "subtrees", "template", "salt"]
CLASHES = [c for i, c in enumerate(CLASHES) if c.lower() not in {x.lower() for x in CLASHES[:i]}]
LANGS = {"en": "the cat sat on the mat and then it went out of the house", "fr": "le chat est sur la table et il va dans la maison avec nous"}
TEXTS = [None, "", " \n\t", "???", "one", LANGS["en"], LANGS["en"], LANGS["fr"], "the dog " * 30_000, "x" * 20_000, "é 😀 ▁ a▁b", "two  spaces  and a tab\t", LANGS["en"] + " tonight"]


def odd_docs(spark, rows=None):
    """Every text under its own id, repeated rows, a repeated id with another text, null ids, sources and languages, and columns of clashing names."""
    rows = rows if rows is not None else [*enumerate(TEXTS), (5, LANGS["en"]), (7, "another text of the same id"), (None, LANGS["fr"]), (None, None)]
    known = {v: k for k, v in LANGS.items()}
    data = [(i, t, known.get(t), None if i is None or i % 3 == 0 else f"src{i % 3}", None if t is None else len(t), *(f"v{i}-{c}" for c in CLASHES)) for i, t in rows]
    return spark.createDataFrame(data, ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *(f"`{c}` string" for c in CLASHES)]))


def own(rows):
    return Counter(tuple(r[c] for c in CLASHES) for r in rows)


def test_operators_keep_columns_of_any_name(spark):
    df = odd_docs(spark)
    all_rows, n = own(df.collect()), df.count()
    found = language_id.identify(df, df.where("lang is not null")).collect()
    assert own(found) == all_rows and {r["_lang_pred"] for r in found} == {"en", "fr", "und"} and all(0 <= r["_score"] <= 1 for r in found)
    marks = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(12)], "doc_id long, quality int, toxic int")
    judged = quality_gam.classify(df, quality_gam.train_on(df, marks)).collect()
    assert own(judged) == all_rows and all(0 <= r["_score"] <= 1 and r["_predicted"] in (0, 1) for r in judged)
    featured = quality_gam.features(df, df.columns)
    assert featured.columns[-1] == "_features" and own(featured.collect()) == all_rows
    codes = sentencepiece_codec.encode(df, restore=True)
    assert own(codes.collect()) == all_rows and codes.columns[-3:] == ["_piece_ids", "piece_n_ids", "piece_restored"]
    assert all(r["piece_restored"] is (None if r["_piece_ids"] is None else True) for r in codes.where("doc_id <> 10").collect())
    back = sentencepiece_codec.decode(codes, "_piece_ids")
    assert back.columns[-1] == "text" and Counter(r["text"] for r in back.collect()) == Counter(None if r.text is None else r.text.replace(SPACE, " ") for r in df.collect())
    mixed = poisson_mix.poisson_mix(df, spark.createDataFrame([("src1", 0.5), (None, 0.5)], "source string, weight double")).collect()
    assert set(own(mixed)) <= set(all_rows) and all(r["_copy"] >= 1 and len(r["_shuffle_key"]) == 32 and r["source"] != "src2" for r in mixed)
    assert n == len(found) == len(judged)


def test_operators_that_read_some_columns_ignore_the_others(spark):
    df = odd_docs(spark)
    plain = df.select("doc_id", "text")
    key = lambda rows: sorted(map(str, rows))
    join = lambda d: key(ngram_join.jaccard_components(d, 3, 90, 100).drop("part").collect())
    assert join(df) == join(plain)
    assert key(license_scan.scan_licenses(df).collect()) == key(license_scan.scan_licenses(plain).collect())
    pages = df.select("*", F.col("doc_id").alias("page_id"), F.concat(F.lit("http://h.test/"), "doc_id").alias("url"), F.col("text").alias("html"))
    few = pages.select("page_id", "url", "html")
    assert key(html_extract.extract_main_text(pages).collect()) == key(html_extract.extract_main_text(few).collect())
    rules = spark.createDataFrame(url_filter.RULES, "rule string, verdict string")
    assert key(url_filter.filter_urls(pages, rules).collect()) == key(url_filter.filter_urls(few, rules).collect())
    vecs = vectors(spark, [*enumerate(cloud(40)), *ODD])
    wide = vecs.select("*", *(F.lit("x").alias(c) for c in CLASHES))
    assert key(cover_tree.link_vectors(wide).collect()) == key(cover_tree.link_vectors(vecs).collect())
    asked = lambda d: key(va_search.top_k(d, lambda i: i % 20 == 0).collect())
    assert asked(wide) == asked(vecs)


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    df = odd_docs(spark)
    all_rows = own(df.collect())
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, df, sf)
        assert set(own(got.collect())) <= set(all_rows), name
        if name != "sentencepiece":
            assert got.columns == df.columns
        empty = stage(spark, df.limit(0), sf)
        assert empty.isEmpty() and empty.columns == got.columns
    kept = corpus_pipeline.keep_known_language(spark, df, sf).collect()
    assert {r.text for r in kept} == {t for t in (*TEXTS, "another text of the same id") if t and re.search(r"[^\W\d_]", t)} - {r.text for r in kept if r.text is None}


def test_one_row_of_each_group_stays(spark):
    df = odd_docs(spark)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "").collect()
    texts = Counter(r.text for r in got)
    assert texts[LANGS["en"]] == 1 and texts[LANGS["fr"]] == 1 and texts[None] == 2 and texts[""] == texts[" \n\t"] == 1
    assert {r.doc_id for r in got if r.text == LANGS["en"]} == {5} and {r.doc_id for r in got if r.text == LANGS["fr"]} == {7}
    assert texts["another text of the same id"] == 1


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(9)
    a, b = ([f"{c}{rng.randrange(10**6)}" for _ in range(60)] for c in "ab")
    near = lambda words, i: " ".join([*words, f"end{i}"])
    rows = [(1, near(a, 1)), (2, near(a, 2)), (3, near(b, 3)), (4, near(b, 4)), (9, near(a, 9)), (9, near(b, 9)), (None, near(b, 0)), (8, None), (8, "alone here")]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).collect()
    assert Counter((r.id, r.component_id) for r in got) == Counter([(1, 1), (2, 1), (3, 3), (4, 3), (9, 1), (9, 3), (None, 3), (8, 8), (8, 8)])


def test_a_group_around_one_text_is_found_whole(spark):
    """Copies that are near the first text only, not near each other, with passages that unrelated texts share."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(base)]
    for _ in range(60):
        copy = list(base)
        at = rng.randrange(88)
        copy[at : at + 6] = [f"z{rng.randrange(10**6)}" for _ in range(6)]
        texts.append(" ".join(copy))
    texts += [" ".join([f"u{rng.randrange(10**6)}" for _ in range(rng.choice([5, 30, 60]))] + passage) for _ in range(60)]
    sets = sets_of(texts, 5)
    got = {r.id: r.component_id for r in ngram_join.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 80, 100).collect()}
    want = brute_components(sets, 80, 100)
    assert [got[i] for i in range(len(texts))] == want and want.count(0) == 61


def test_prefix_bounds_hold_for_all_small_sizes():
    """The lower parts of two linked sets share ``common`` members in the worst case, where all that isn't shared comes first."""
    for num in (50, 80, 90, 99):
        limit = ngram_join.Threshold(num, 100)
        for n in range(1, 80):
            for m in range(n, 100 * n // num + 1):
                both = -(-(n + m) * num // (100 + num))
                if both > n or limit.overlap(m) > n:
                    continue
                shared = min(limit.lower(n) - (n - both), limit.lower(m) - (m - both))
                assert shared >= max(limit.common(n), limit.common(m)), (num, n, m)
                assert limit.lower(n) <= n


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_bloom_filter_loses_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "BLOOM_BITS", bits)
    rng = np.random.default_rng(bits)
    rows = [tuple(map(int, rng.integers(-(2**63), 2**63, 2))) for _ in range(300)]
    known = ngram_join._bloom(spark.createDataFrame(rows, "sig1 long, sig2 long"))
    assert all(known[ngram_join._bits(np.int64(a), np.int64(b), len(known))].all() for a, b in rows)


def test_models_travel_to_executors_without_the_repository(tmp_path):
    """And without a checkpoint folder, in place of which the warehouse holds intermediate tables."""
    script = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", "{tmp_path}/w").getOrCreate()
def there(_):
    try:
        import skyledger
        return [1]
    except ImportError:
        return [0]
assert spark.sparkContext.parallelize([0], 1).mapPartitions(there).collect() == [0]
from skyledger.llm import cover_tree, html_extract, language_id, license_scan, ngram_join, quality_gam, sentencepiece_codec, va_search
docs = spark.createDataFrame([(i, "the cat sat on mat " + str(i), "en") for i in range(20)], "doc_id long, text string, lang string")
marks = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
pages = docs.selectExpr("doc_id as page_id", "'http://h.test/' as url", "concat('<p>', text, '</p>') as html")
vecs = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(20)], "vec_id long, embedding array<double>")
print([d.count() for d in (language_id.identify(docs, docs), quality_gam.classify(docs, quality_gam.train_on(docs, marks)), sentencepiece_codec.decode(sentencepiece_codec.encode(docs)),
    ngram_join.jaccard_components(docs), html_extract.extract_main_text(pages), license_scan.scan_licenses(docs), cover_tree.link_vectors(vecs), va_search.top_k(vecs, lambda i: i % 20 == 0))])
"""
    env = {"PATH": "/usr/bin:/bin:" + str(Path(sys.executable).parent), "HOME": str(tmp_path), "PYSPARK_PYTHON": sys.executable}
    import os

    env |= {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "SPARK_HOME", "LD_LIBRARY_PATH", "PATH")}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False)
    assert done.stdout.strip().endswith("[20, 20, 20, 20, 20, 0, 20, 19]"), done.stderr[-3000:]


def test_intermediate_tables_go(spark):
    with scratch.released():
        made = scratch.Scratch(spark)
        a, b = made.save(spark.range(3)), made.save(spark.range(4))
        made.drop(a)
        assert b.count() == 4 and made.tables[a.scratch_path] is False
    assert set(made.tables.values()) == {False} and not Path(b.scratch_path.removeprefix("file://")).exists()


class Tree(HTMLParser):
    """Well-formed pages only: (tag, names, children or text)."""

    def __init__(self, page):
        super().__init__()
        self.root = ["", "", []]
        self.open = [self.root]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = [tag, " ".join(v for k, v in attrs if k in ("class", "id")), []]
        self.open[-1][2].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if data.strip():
            self.open[-1][2].append(" ".join(data.split()))


def shape(node):
    return (node[0], re.sub("[0-9]+", "", node[1]), tuple(sorted({shape(c) for c in node[2] if not isinstance(c, str)}, key=str)))


def words(node):
    return (node[0], re.sub("[0-9]+", "", node[1]), tuple(c if isinstance(c, str) else words(c)[2] for c in node[2]))


def flat(x):
    return [x] if isinstance(x, str) else [t for c in x for t in flat(c)]


def slow_texts(pages):
    """Texts of well-formed pages by comparing subtrees themselves, not hashes."""
    def walk(node, path=()):
        for c in node[2]:
            if not isinstance(c, str):
                yield c, (*path, node)
                yield from walk(c, (*path, node))

    def has_main(node):
        return node[0] == "article" or any(has_main(c) for c in node[2] if not isinstance(c, str))

    def signs(tree):
        main = has_main(tree)
        for node, path in walk(tree):
            if node[0] not in ("html", "body", "article") and not has_main(node) and not any(p[0] == "article" for p in path) and flat(words(node)[2]):
                yield node, ("words", node[0], words(node)[1], tuple(flat(words(node)[2])))
                if main and node[0] != "p":
                    yield node, ("shape", shape(node))

    def blocks(node, gone, off, within, main):
        off = off or node[0] in ("nav", "aside", "footer") or "ad" in re.findall("[a-z]+", node[1])
        within = within or node[0] == "article"
        for c in node[2]:
            if isinstance(c, str):
                if not off and (within or not main):
                    yield c
            elif id(c) not in gone:
                yield from blocks(c, gone, off, within, main)

    trees = {i: (host, Tree(page).root) for i, (host, page) in pages.items()}
    bare = {i: tuple(blocks(t, set(), False, False, has_main(t))) for i, (_, t) in trees.items()}
    seen, documents = defaultdict(set), defaultdict(set)
    for i, (host, t) in trees.items():
        if bare[i]:
            documents[host].add(bare[i])
            for _, sign in signs(t):
                seen[host, sign].add(bare[i])
    often = {k for k, d in seen.items() if len(d) >= html_extract.LEAST_PAGES and len(d) >= html_extract.LEAST_SHARE * len(documents[k[0]])}
    return {i: "\n\n".join(blocks(t, {id(n) for n, sign in signs(t) if (host, sign) in often}, False, False, has_main(t))) for i, (host, t) in trees.items()}


@pytest.mark.parametrize("few", [10**6, -1])
def test_template_removal_equals_comparing_subtrees(spark, monkeypatch, few):
    monkeypatch.setattr(html_extract, "BROADCAST_SUBTREES", few)
    rng = random.Random(21)
    pages = {}
    for i in range(160):
        host = rng.choice(["a.test", "a.test", "b.test", "c.test"])
        story = "".join(f"<p>{' '.join(rng.choice(['sun', 'rain', 'wind', str(rng.randrange(50))]) for _ in range(rng.randrange(1, 6)))}</p>" for _ in range(rng.randrange(1, 4)))
        bar = f"<div class='box{rng.randrange(9)}'><p>{rng.choice(['read more', 'join us', 'today ' + str(i)])}</p></div>"
        odd = rng.choice(["", f"<nav><ul><li>{rng.randrange(9)}</li></ul></nav>", f"<section><div class='ad'>{rng.randrange(99)}</div></section>", f"<div><div><p>deep {rng.randrange(3)}</p></div></div>"])
        body = f"<article><h1>{rng.randrange(40)}</h1>{story}</article>" if rng.random() < 0.5 else f"<div>{story}</div>"
        pages[i] = (host, f"<html><body>{bar}{odd}{body}<footer><p>about {rng.randrange(3)}</p></footer></body></html>")
    df = spark.createDataFrame([(i, f"http://{h}/{i}", p) for i, (h, p) in pages.items()], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_main_text(df).collect()}
    want = slow_texts(pages)
    assert got == want and any("read more" not in want[i] for i in want)


def test_templates_take_what_markup_does_not_name(spark):
    story = lambda i: f"<article><p>story {i} of its own</p></article>"
    rows = [(i, f"http://h.test/{i}", f"<body><div class=strip><b>word {i}</b></div>{story(i)}<section><p>line {i}</p><p>more</p></section></body>") for i in range(12)]
    page = html_extract.Page(rows[0][2])
    assert [b[0] for b in page.blocks] == ["word 0", "story 0 of its own", "line 0", "more"]
    hosted = spark.createDataFrame([("h.test", r[2]) for r in rows], "host string, html string")
    template = {r.subtree for r in html_extract.templates(hosted).collect()}
    gone = [(low, high) for words, shape, low, high in page.subtrees if words in template or shape in template]
    assert (0, 1) in gone and (2, 4) in gone and not any(low <= 1 < high for low, high in gone)


def test_templates_take_what_recurs_in_main_beside_the_article(spark):
    menu, ask = "<div class=x1><ul><li>Home</li><li>World</li></ul></div>", "<div class=x2><p>Get our letter</p></div>"
    page = lambda i: f"<body><main>{menu}<div class=x3><h1>Head</h1></div><article><p>Get our letter</p><p>story {i}</p></article><div class=x4><p>end of {i}</p></div>{ask}</main></body>"
    alone = lambda i: f"<body><main><p>same words</p><p>tale {i}</p></main></body>"
    rows = [(i, f"http://h.test/{i}", page(i)) for i in range(6)] + [(i, f"http://m.test/{i}", alone(i)) for i in range(6, 12)] + [(12, "http://few.test/", page(12))]
    got = {r.page_id: r.text for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Head\n\nGet our letter\n\nstory {i}\n\nend of {i}" for i in range(6))
    assert all(got[i] == f"same words\n\ntale {i}" for i in range(6, 12))
    assert got[12] == "Home\n\nWorld\n\nHead\n\nGet our letter\n\nstory 12\n\nend of 12\n\nGet our letter"


def test_html_odd_tables(spark):
    rows = [(1, "http://a.test/", "<p>same</p>")] * 3 + [(None, None, "<p>no id</p>"), (2, "", None), (3, "x", "<div>" * 5000 + "deep" + "</div>" * 5000), (4, "y", "<p>" + "long text " * 50_000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_extract.extract_main_text(df).collect()
    assert Counter(r.text[:9] for r in got) == Counter(["same"] * 3 + ["no id", "", "deep", "long text"]) and max(r.n_chars for r in got) == 499_999
    assert html_extract.extract_main_text(df.limit(0)).isEmpty()


@pytest.mark.parametrize("piece", ["<a ", "<div>", '<a "', "<p>", "<b><p>x", "</a>", "<td>x", "<a '>", "<!--", "<b>x</i>", "&amp;"])
def test_parsing_time_grows_with_the_page(piece):
    import time

    def took(n):
        began = time.process_time()
        html_extract.Page(piece * n)
        return time.process_time() - began

    took(2000)
    assert took(80_000) < 12 * max(min(took(20_000) for _ in range(2)), 0.02)


def test_license_scan_equals_trying_every_place(spark):
    rng = random.Random(31)
    names = dict(list(license_scan.TEMPLATES.items())[:6])
    vocabulary = [w for t in names.values() for w in re.findall(r"\w+", t.lower())]
    texts = []
    for _ in range(60):
        text = [rng.choice(vocabulary) if rng.random() < 0.5 else f"w{rng.randrange(30)}" for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            notice = re.findall(r"\w+|\W+", rng.choice(list(names.values())))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(notice))
                notice[at : at + rng.randrange(2)] = [rng.choice([" other ", " "])]
            text.insert(rng.randrange(len(text) + 1), "".join(notice))
        texts.append(" ".join(text))
    texts += ["", None, *names.values(), " ".join(names.values())]
    index, reader = license_scan.Index(names), license_scan.LicenseWords()
    got = defaultdict(list)
    for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), names).collect():
        got[r.doc_id, r.license].append((r.start_word, r.end_word - 1, r.matched_words))
    for d, text in enumerate(texts):
        for t, name in enumerate(index.names):
            template = index.words[t]
            (_, _, hashes), = reader.chunks(license_scan.pa.array([text or ""]))
            size, band = len(template), license_scan.band_of(len(template))
            found = set()
            for start in range(-size, len(hashes)):
                begin = max(0, start - band)
                pad = band - (start - begin)
                window = hashes[begin : max(0, start + size + band)]
                m, a, z = license_scan.align(template, np.concatenate([np.zeros(pad, np.uint64), window]), band)
                if m >= license_scan.COVERAGE * size:
                    found.add((-m, z - a, begin - pad + a))
            taken = []
            for less, span, a in sorted(found):
                if all(a + span < b or z < a for b, z, _ in taken):
                    taken.append((a, a + span, -less))
            best = lambda rows: sorted(rows)
            assert best(got[d, name]) == best(taken), (text, name)


def test_license_repeated_rows_and_overlaps(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "All rights reserved. All rights reserved.")]
    got = Counter((r.doc_id, r.license, r.start_word) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(1, "MIT", 0): 2, (None, "all-rights-reserved", 0): 1, (None, "all-rights-reserved", 3): 1})


def test_features_and_scores_equal_plain_python(spark):
    rng = random.Random(17)
    texts = [" ".join(rng.choice(["The", "cat", "sat,", "on!", "a", "x1", "#$", "été.", "cat"]) + rng.choice(["", "\n"]) for _ in range(rng.randrange(1, 60))) for _ in range(80)] + [None, "", "   "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    x = np.array([r.features for r in quality_gam.features(df, ["doc_id"]).orderBy("doc_id").collect()])

    def slow(text):
        b = (text or "").encode()
        ws = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", b)]
        if not ws:
            return [0.0] * len(quality_gam.FEATURES)
        n, size, lines = len(ws), len(b), b.split(b"\n")
        count = lambda chars: sum(b.count(bytes([c])) for c in chars) / size
        again = Counter(lines)
        lens = np.array([len(w) for w in ws])
        pairs = list(zip(ws[1:], ws[:-1], strict=True))
        return [
            np.log1p(n), lens.mean(), lens.std(), count(range(65, 91)), count(range(48, 58)), count(b".,;:!?'\"-"), count(b"#$%&*@^~|+=_!"), sum(c >= 128 for c in b) / size,
            len(set(ws)) / n, len(set(pairs)) / max(1, n - 1), max(Counter(ws).values()) / n, n / len(lines), 1 - len(again) / len(lines), sum(len(k) * (v - 1) for k, v in again.items()) / size,
            np.mean([p == q for p, q in pairs]) if pairs else 0.0, n / (sum(b.count(bytes([c])) for c in b".!?") + 1), float((lens <= 3).mean()), count(b"<>{}[]()/\\"),
        ]

    want = np.array([slow(t) for t in texts])
    assert np.allclose(x, want), [(quality_gam.FEATURES[j], x[i, j], want[i, j]) for i, j in zip(*np.nonzero(~np.isclose(x, want)), strict=True)][:5]
    y = (x[:, 0] > 3).astype(float)
    model = quality_gam.fit(x, y)

    def total(row):
        out = model.bias
        for j, edges in enumerate(model.edges):
            out += model.tables[j][sum(v <= row[j] for v in edges)]
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            out += t[sum(v <= row[i] for v in model.coarse[i])][sum(v <= row[j] for v in model.coarse[j])]
        return 1 / (1 + np.exp(-out))

    got = [r.score for r in quality_gam.classify(df, model).orderBy("doc_id").collect()]
    assert np.allclose(got, [total(r) for r in x]) and quality_gam.classify(df.limit(0), model).isEmpty()


def test_languages_equal_summing_segmentations(spark):
    rows = [(1, "cat sat mat", "en"), (2, "le chat las", "fr"), (3, "a rat", "en"), (4, "la rue", "fr"), (5, "the la cat", None), (6, "ça 日 x", None), (7, "12", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trie = build_trie()
    model = language_id.train(df.where("lang is not null"), trie)
    ids = {trie.pieces[i]: i for i in set(trie.piece[trie.piece >= 0].tolist())}

    def total(word, c):
        if not word:
            return 1.0
        out = sum(np.exp(model.log_p[ids[word[:n]], c]) * total(word[n:], c) for n in range(1, len(word) + 1) if word[:n] in ids)
        return out if word[0] in ids else out + np.exp(language_id.OTHER_CHARACTER) * total(word[1:], c)

    for r in language_id.identify(df, df.where("lang is not null")).collect():
        found = re.findall(r"[^\W\d_]+", r.text.lower())
        if not found:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        p = np.array([np.prod([total(SPACE + w, c) for w in found]) for c in range(2)])
        assert r.lang_pred == model.languages[int(p.argmax())] and abs(r.score - p.max() / p.sum()) < 1e-9


def test_encoding_equals_the_best_of_all_segmentations(spark):
    texts = ["the cat  sat", " in street", "a 日 b", "cats\nand dogs", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trie = build_trie()
    scores = sentencepiece_codec.learned_scores(df, "text", trie)
    ids = {trie.pieces[i]: i for i in set(trie.piece[trie.piece >= 0].tolist())}

    def best(run):
        if not run:
            return 0.0
        parts = [scores[ids[run[:n]]] + best(run[n:]) for n in range(1, len(run) + 1) if run[:n] in ids]
        if run[0] not in ids:
            parts.append(scores.min() - 10 + best(run[1:]))
        return max(parts)

    for r in sentencepiece_codec.encode(df, restore=True).collect():
        text = texts[r.doc_id]
        if not text:
            assert r.ids == (None if text is None else [])
            continue
        runs = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))
        unknown = sum(1 for c in text.replace(" ", SPACE) if c not in ids)
        spelt = set(trie.byte_ids.tolist())
        got = sum(scores[i] for i in r.ids if i not in spelt) + unknown * (scores.min() - 10)
        assert r.restored and abs(got - sum(best(x) for x in runs)) < 1e-6


def test_salted_mixing_equals_broadcast(spark, monkeypatch):
    df = odd_docs(spark)
    rows = lambda: Counter(tuple(r) for r in poisson_mix.poisson_mix(df).collect())
    plain = rows()
    monkeypatch.setattr(poisson_mix, "BROADCAST_SOURCES", 0)
    assert rows() == plain


def test_url_filter_odd_tables(spark):
    rules = spark.createDataFrame([("a.test/x", "block"), ("A.test/x", "allow"), ("b.a.test/", "block"), ("a.test/", "allow")], "rule string, verdict string")
    long = "http://a.test/x" + "y" * 100_000
    rows = [(1, "http://a.test/x"), (1, "http://a.test/x"), (2, "http://b.a.test/x"), (3, long), (None, None), (4, "http://c.test/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = [(r.page_id, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, default="block").collect()]
    assert Counter(got) == Counter([(1, "A.test/x", "allow")] * 2 + [(2, "b.a.test/", "block"), (3, "A.test/x", "allow"), (None, None, "block"), (4, None, "block")])
    assert url_filter.filter_urls(pages, rules.limit(0)).where("rule is not null or verdict <> 'allow'").isEmpty()


def test_cover_tree_prunes_clusters_and_misses_nothing():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 32))
    u = np.concatenate([b + rng.normal(scale=0.03, size=(50, 32)) for b in base])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    blocks = [cover_tree.Block(np.arange(i, 2000, 2), np.ones(1000, np.int64), u[i::2], cover_tree.build_levels(u[i::2])) for i in (0, 1)]
    link = u @ u.T >= 0.9
    looked = 0
    links = np.zeros(2000, np.int64)
    for i, j in ((0, 0), (1, 1), (0, 1)):
        a, b, _, n = cover_tree.dual_traversal(blocks[i], blocks[j], i == j, 0.9)
        looked += n
        links[i::2] += a
        if i != j:
            links[j::2] += b
    assert (links == link.sum(axis=1) - 1).all() and looked < 0.1 * 2000 * 1999 / 2


def test_cover_tree_levels_are_nested_nets():
    u = np.array(cloud(300))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    levels = cover_tree.build_levels(u)
    above = np.zeros(300, int)
    for k, r in enumerate(cover_tree.RADII):
        assert (np.linalg.norm(u - u[levels[:, k]], axis=1) <= r + 1e-9).all() and (above[levels[:, k]] == above).all()
        assert set(np.unique(above)) <= set(np.unique(levels[:, k])) or k == 0
        above = levels[:, k]


def test_cover_tree_opens_few_nodes_where_nothing_is_clustered(monkeypatch):
    opened, inner = [], cover_tree._opened

    def counted(*args):
        for found in inner(*args):
            opened.append(len(found[0]))
            yield found

    monkeypatch.setattr(cover_tree, "_opened", counted)
    rng = np.random.default_rng(6)
    u = rng.normal(size=(4000, 32))
    u[3900:] = u[:100] + rng.normal(scale=0.05, size=(100, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    blocks = [cover_tree.Block(np.arange(i, 4000, 2), np.ones(2000, np.int64), u[i::2], cover_tree.build_levels(u[i::2])) for i in (0, 1)]
    a, b, _, looked = cover_tree.dual_traversal(*blocks, False, 0.9)
    link = u[::2] @ u[1::2].T >= 0.9
    assert (a == link.sum(axis=1)).all() and (b == link.sum(axis=0)).all()
    assert looked < 1.05 * 2000 * 2000 and sum(opened) < 0.01 * 2000 * 2000


@pytest.mark.parametrize("scale", [0.05, 0.3, 3.0])
def test_cover_tree_tiles_lose_no_pair(monkeypatch, scale):
    monkeypatch.setattr(cover_tree, "TILE", (7, 12))
    rng = np.random.default_rng(7)
    u = rng.normal(size=(20, 6))[rng.integers(20, size=400)] + rng.normal(scale=scale, size=(400, 6))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    for cosine in (0.9, 0.3):
        block = cover_tree.Block(np.arange(400), np.ones(400, np.int64), u, cover_tree.build_levels(u))
        assert (cover_tree.dual_traversal(block, block, True, cosine)[0] == (u @ u.T >= cosine).sum(axis=1) - 1).all()


def test_blocks_in_reach_meet_once_over_panels(monkeypatch):
    monkeypatch.setattr(cover_tree, "PANEL_BYTES", 100)
    rng = np.random.default_rng(5)
    near = rng.random((12, 12)) < 0.5
    near = near | near.T | np.eye(12, dtype=bool)
    blocks = [(g * 8 + shard, int(rng.integers(10, 60))) for g in range(12) for shard in range(3)]
    met, size = Counter(), dict(blocks)
    for panel, partners in cover_tree.meetings(blocks, lambda g: near[g], lambda n: n // 8):
        assert sum(size[n] for n in panel) <= 100
        met.update(tuple(sorted((n, other))) for n, others in partners.items() for other in others if other in panel)
    assert met == Counter((a, b) for a, _ in blocks for b, _ in blocks if a <= b and near[a // 8, b // 8])


def test_embedding_rows_of_one_id_and_copies(spark):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(5, a), (7, a), (7, b), (3, b), (3, None), (None, [x * 2 for x in b]), (9, [0.0, 0.0, -1.0]), (None, [0.0] * 3)]
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.link_vectors(vectors(spark, rows)).collect())
    assert got == Counter([(5, 1, 5, True), (7, 1, 5, False), (7, 2, 3, False), (3, 2, 3, True), (3, 0, 3, True), (None, 2, 3, False), (9, 0, 9, True), (None, 0, None, True)])


def test_many_cells_and_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 12))
    rows = [(i, (base[i % 30] + rng.normal(scale=0.15, size=12)).astype(np.float32).tolist()) for i in range(900)]
    u = np.array([v for _, v in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = (u @ u.T >= 0.9) & ~np.eye(900, dtype=bool)
    got = {r.vec_id: r.n_links for r in cover_tree.link_vectors(vectors(spark, rows)).collect()}
    assert [got[i] for i in range(900)] == link.sum(axis=1).tolist()


def test_top_k_ties_copies_and_large_values(spark):
    same = [0.5, 0.25]
    rows = [(i, same) for i in range(60)] + [(20, same), (None, same), (100, [3e5, -2e5]), (101, [1.0]), (120, [-1e9, 1e9])]
    got = defaultdict(list)
    for r in va_search.top_k(vectors(spark, rows), lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 100, 120} and [x[0] for x in got[0]] == list(range(1, 21))
    q = lambda v: np.floor(64 * np.float64(np.array(v, np.float32)))
    for query, vec in ((0, same), (20, same), (100, [3e5, -2e5])):
        scores = sorted((-int(q(vec) @ q(v)), i) for i, v in rows if i is not None and i != query and len(v) == 2)[:20]
        assert [(i, -s) for s, i in scores] == [x[1:] for x in got[query]]


def test_bounds_hold():
    rng = np.random.default_rng(6)
    for scale in (1, 60, 1e4, 1e9):
        x, q = np.floor(rng.normal(size=(200, 24)) * scale), np.floor(rng.normal(size=(10, 24)) * scale)
        parts = [va_search.cells_of(v) for v in x]
        low, high = va_search.bounds(q, np.array([c for c, _ in parts]), np.array([w for _, w in parts]))
        assert (low <= q @ x.T).all() and (q @ x.T <= high).all() and (high - low).max() > 0


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
def test_pipeline_equals_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = language_id.identify(docs, docs.where("lang is not null")).where("lang_pred <> 'und' and score >= 0.5")
    first = stages["language_id"](spark, docs, str(SF))
    assert sorted(r.doc_id for r in first.collect()) == sorted(r.doc_id for r in known.collect())
    rows = stages["quality_classifier"](spark, first, str(SF)).orderBy("doc_id").collect()
    after = spark.createDataFrame(rows, docs.schema)
    root = brute_components(sets_of([r.text for r in rows], 5), 80, 100)
    want = [r.doc_id for i, r in enumerate(rows) if root[i] == i]
    third = stages["ngram_jaccard_join"](spark, after, str(SF))
    assert sorted(r.doc_id for r in third.collect()) == want
    mixed = stages["source_mixing"](spark, third, str(SF))
    weights = Counter(r.source for r in third.collect())
    roots = sum(v**0.5 for v in weights.values())
    import hashlib
    import math

    copies = Counter()
    for r in third.collect():
        rate = round(len(want) * (weights[r.source] ** 0.5 / roots) / weights[r.source], 9)
        u = int(hashlib.md5(f"{poisson_mix.SEED}:{r.doc_id}:0".encode()).hexdigest()[:13], 16) / 2**52
        p, f, k = math.exp(-rate), math.exp(-rate), 0
        while f <= u and k < 200:
            k += 1
            p = p * rate / k
            f += p
        copies[r.doc_id] = k
    assert Counter(r.doc_id for r in mixed.collect()) == +copies
    last = stages["sentencepiece"](spark, mixed, str(SF)).collect()
    assert Counter(r.doc_id for r in last) == +copies and all(r.restored for r in last)


def test_names_of_clashes_are_free(spark):
    assert scratch.fresh("score", ["Score", "_score"]) == "__score" and scratch.fresh("x", []) == "x"
    assert json.loads(json.dumps(CLASHES)) == CLASHES and DATA

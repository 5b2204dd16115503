"""Operators for training data against brute force, exact round trips and edge cases."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import cover_tree, html_extract, language_id, license_scan, ngram_join, poisson_mix, quality_gam, queries, sentencepiece_codec, url_filter, va_search
from skyledger.llm.components import connected_components
from skyledger.llm.piece_trie import SPACE, VOCABULARY, build_trie, padded
from skyledger.llm.scratch import Scratch

from ..conftest import DATA

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"
SF = DATA / "sf0.001"
LOW = str.maketrans(url_filter.UPPER, url_filter.LOWER)


def docs(spark, texts, langs=None, sources=None):
    rows = [(i, t, langs[i] if langs else "en", sources[i] if sources else "src0", len(t or ""), 1.0, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


EDGES = [None, "", " \t\n", "one", "One TWO", "a b c d e", "a b c d e", "é 😀 ñ", "w " * 5000, "x" * 3000]


def sets_of(texts, k):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def brute_components(sets, num, den):
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, k, num):
    rng = random.Random(k)
    texts = list(EDGES)
    for _ in range(8):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([9, 10, 30, 120]))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(9999)}"
            texts.append(" ".join(copy))
    sets = sets_of(texts, k)
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, texts), k, num, 100).collect()}
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, brute_components(sets, num, 100), strict=True))}


def test_jaccard_of_large_sets_equals_brute_force(spark):
    """Sets of about 930 and 1,862 shingles, where the number of parity cells changes, on both sides of the threshold."""
    rng = random.Random(4)
    texts = []
    for n in (930, 1864, 2400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for share in (0, 18, 21, 23, 25, 40):  # of a thousand words; each new word changes five shingles
            copy = list(base)
            for at in rng.sample(range(n), n * share // 1000):
                copy[at] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(copy[rng.randrange(9) :]))
    sets = sets_of(texts, 5)
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, texts), 5, 80, 100).collect()}
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, brute_components(sets, 80, 100), strict=True))}


def test_jaccard_of_an_empty_table(spark):
    assert ngram_join.jaccard_components(docs(spark, []), 3, 90, 100).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (102, 101), (200, 200)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == got[101] == 100 and got[200] == 200


def test_url_filter_cases(spark):
    urls = ["http://a.EXAMPLE.net/en/x", "https://net/", "http://net", "https://xnet/", "http://b.example.com/de/?q#f", "http://example.com/DE/", "https://w.org/fr/1", None, "no scheme", "", "http://a.net/en/"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    rules = spark.createDataFrame(url_filter.RULES, "rule string, verdict string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got[0] == ("a.example.net", "example.net/en/", "allow") and got[1] == ("net", "net/", "block") and got[2] == ("net", None, "allow")
    assert got[3][1] is None and got[4][1:] == ("example.com/de/", "block") and got[5][1] is None and got[6][1:] == ("org/fr/", "allow")
    assert [got[i] for i in (7, 8, 9)] == [("", None, "allow")] * 3 and got[10][1] == "net/"
    assert url_filter.filter_urls(pages.limit(0), rules).isEmpty()
    many = spark.createDataFrame([(f"h{i}.test/p{i % 7}/", "block") for i in range(500)], "rule string, verdict string")
    asked = spark.createDataFrame([(i, f"http://h{i}.test/p{i % 7}/x", "") for i in range(1000)], "page_id long, url string, html string")
    assert {r.page_id for r in url_filter.filter_urls(asked, many).where("verdict = 'block'").collect()} == set(range(500))


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in SF.iterdir():
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    df = queries.QUERIES[name](spark, str(SF))
    got = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in got.description]
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, got.fetchall()))


def test_html_blocks():
    page = '<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href="/x">menu</a></nav><header>top</header><div class="ad box">buy</div><article><header><h1>Head &amp; line</h1></header><p><b>bold  text<br>more<p>next &eacute;<!-- no --></p><aside>side</aside><div id="comments"><p>hi</p></div><form>f</form><ul><li>one<li>two</ul></article><footer>foot</footer></body></html>'
    assert html_extract.Page(page).main_blocks() == ["Head & line", "bold text more", "next é", "one", "two"]
    assert html_extract.Page(None).main_blocks() == html_extract.Page("").main_blocks() == [] and html_extract.Page("<p>a<").main_blocks() == ["a<"]


def test_html_template_of_a_host_goes(spark):
    rows = [(i, f"http://h.test/{i}", f"<body><div class=x><p>Read our paper daily</p></div><div><p>story number {i}</p></div></body>") for i in range(20)]
    rows += [(100, "http://other.test/", "<p>Read our paper daily</p>"), (101, None, None), (102, "http://h.test/e", "")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == ("story number 3", 14) and got[100][0] == "Read our paper daily" and got[101] == got[102] == ("", 0) and len(got) == 23


def test_html_copies_of_a_page_keep_their_text(spark):
    def page(story):
        return f"<body><div class=x><p>Read our paper daily</p></div><div><p>{story}</p></div></body>"

    rows = [(i, f"http://h.test/{i}", page(f"story number {i}")) for i in range(20)]
    rows += [(100 + i, f"http://h.test/copy/{i}", page("the copied story")) for i in range(60)]
    rows += [(300 + i, f"http://g.test/{i}", page(f"story number {i}")) for i in range(20)]
    rows += [(200, "http://g.test/again", page("the repeated story"))] * 60
    got = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got if r.page_id == 200} == {"the repeated story"} and {r.text for r in got if 100 <= r.page_id < 200} == {"the copied story"}
    assert {r.text for r in got if r.page_id < 100 or r.page_id >= 300} == {f"story number {i}" for i in range(20)} and len(got) == len(rows)


def test_codec_against_the_library_and_round_trip(spark):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    trie = build_trie()
    model = pb.ModelProto()
    model.ParseFromString(open(VOCABULARY, "rb").read())
    model.trainer_spec.model_type = 1  # unigram Viterbi over the same pieces and scores
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["", " ", "hello world", "  two  spaces ", "The quick brown fox jumps", "naïve café", "internationalisation of tokenizers"]
    encoder, decoder = sentencepiece_codec.Encoder(trie), sentencepiece_codec.Decoder(trie)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert sum(trie.scores[i] for i in ids) >= sum(trie.scores[i] for i in library.encode(text)) - 1e-3
        assert decoder.decode(ids) == text == library.decode(ids.tolist())
    df = sentencepiece_codec.encode(docs(spark, EDGES), restore=True)
    assert [r.restored for r in df.orderBy("doc_id").collect()] == [None, *[True] * (len(EDGES) - 1)]
    tokens = sentencepiece_codec.encode(docs(spark, EDGES).drop("ids"))
    assert [r.text for r in sentencepiece_codec.decode(tokens).orderBy("doc_id").collect()] == EDGES


def test_codec_scores_are_learned_from_all_documents(spark):
    trie = build_trie()
    df = docs(spark, ["the transformation of language models", None, ""] * 300 + ["street"])
    got = sentencepiece_codec.encode(df, restore=True).where("n_ids > 0").collect()
    words = {r.doc_id: [trie.pieces[i] for i in r.piece_ids] for r in got}
    assert all(r.restored for r in got) and "▁the" in words[0] and "▁of" in words[0] and len(words[0]) < 9
    scores = sentencepiece_codec.learned_scores(df, "text", trie)
    usable = list(set(trie.piece[trie.piece >= 0].tolist()))
    assert np.isfinite(scores).all() and abs(np.exp(scores[usable]).sum() - 1) < 1e-3
    assert scores[trie.pieces.index("▁the")] > scores[trie.pieces.index("▁street")] > scores[trie.pieces.index("▁question")]
    assert len(set(sentencepiece_codec.learned_scores(df.limit(0), "text", trie)[usable])) == 1


def test_viterbi_equals_brute_force():
    trie = build_trie()
    ids = {p: i for i, p in enumerate(trie.pieces)}

    def best(word):
        return 0.0 if not word else max((trie.scores[ids[word[:n]]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in ids), default=-np.inf)

    for word in ["▁the", "▁street", "▁retina", "▁abcabc"]:
        assert sum(trie.scores[i] for i in sentencepiece_codec.viterbi(trie, *padded([word.encode()]))[0]) == best(word)


def test_forward_sums_all_segmentations():
    trie = build_trie()
    rng = np.random.default_rng(1)
    log_p = np.log(rng.random((len(trie.pieces), 2)))
    ids = {trie.pieces[i]: i for i in set(trie.piece[trie.piece >= 0].tolist())}

    def total(word, c):
        return 1.0 if not word else sum(np.exp(log_p[ids[word[:n]], c]) * total(word[n:], c) for n in range(1, len(word) + 1) if word[:n] in ids)

    got, _ = language_id.forward(trie, log_p, ["street", "on"])
    assert np.allclose(np.exp(got), [[total(SPACE + w, c) for c in range(2)] for w in ("street", "on")])
    counts = language_id.expected_counts(trie, log_p, ["on"], np.array([[3.0, 0.0]]))
    assert counts[:, 0].sum() >= 3 and counts[:, 1].sum() == 0


def test_language_edges(spark):
    texts = [*EDGES, "the cat sat on the mat", "le chat et la souris", "12 34 !!"]
    langs = [None] * len(EDGES) + ["en", "fr", None]
    df = docs(spark, texts, langs)
    got = {r.doc_id: r for r in language_id.identify(df, df.where("lang is not null")).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[len(texts) - 1].lang_pred == "und" and got[0]._score == 0.0
    assert got[len(EDGES)].lang_pred == "en" and got[len(EDGES) + 1].lang_pred == "fr" and all(0 <= r._score <= 1 and r.score == 1.0 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(df, df.limit(0)).collect()} == {"und"}
    assert language_id.identify(df.limit(0), df.where("lang is not null")).isEmpty()


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
def test_held_out_accuracy(spark):
    sf = str(DATA / "sf0.01")
    known = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    right = queries.op8_language_id(spark, sf).where("held_out").join(known, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = queries.op7_quality_classifier(spark, sf).where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97 and good > 0.93


def test_quality_edges(spark):
    df = docs(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_gam.classify(df, quality_gam.train_on(df, none)).collect()
    assert len(got) == len(EDGES) and {(r.score, r._score) for r in got} == {(1.0, 0.5)}
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(len(EDGES))] + [(None, 1, 0), (3, None, 0)], none.schema)
    assert all(0 <= r._score <= 1 for r in quality_gam.classify(df, quality_gam.train_on(df, marks)).collect())


def test_gam_learns_an_interaction():
    x = np.random.default_rng(2).random((3000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert model.pairs[0] == (0, 1) and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_mixing_rates_and_edges(spark):
    df = docs(spark, [f"t{i}" for i in range(3000)], sources=["a" if i % 3 else None for i in range(3000)])
    weights = spark.createDataFrame([("a", 0.5), (None, 0.5)], "source string, weight double")
    got = {r.source: r["count"] for r in poisson_mix.poisson_mix(df, weights).groupBy("source").count().collect()}
    assert abs(got["a"] - 1500) < 200 and abs(got[None] - 1500) < 200
    assert poisson_mix.poisson_mix(df.limit(0)).isEmpty() and poisson_mix.poisson_mix(df, weights.limit(0)).isEmpty()
    heavy = docs(spark, ["x"] * 3, sources=["a", "b", "b"])
    many = poisson_mix.poisson_mix(heavy, spark.createDataFrame([("a", 400.0)], weights.schema)).count()
    assert 900 < many < 1500  # one document at a rate of 1,200


def test_license_spans(spark):
    text = "Intro words here. licensed under the apache license version 2.0 and more.\nReleased under the MIT License."
    got = license_scan.scan_licenses(docs(spark, [*EDGES, text, text.replace("apache ", "apache software ")])).collect()
    first = {(r.doc_id, r.license): r for r in got}
    n = len(EDGES)
    assert {k for k in first if k[0] == n} == {(n, "Apache-2.0"), (n, "MIT")} and first[n, "MIT"].coverage == 1.0
    assert text.encode()[first[n, "MIT"].start_byte : first[n, "MIT"].end_byte] == b"Released under the MIT License"
    assert (n + 1, "Apache-2.0") in first and not [k for k in first if k[0] < n]
    assert license_scan.scan_licenses(docs(spark, [])).isEmpty()


def test_license_short_templates_are_found_in_any_context():
    index = license_scan.Index({"two": "Public domain", "one": "Unlicense", "three": "All rights reserved.", "mit": "Released under the MIT License."})
    reader = license_scan.LicenseWords()

    def found(text):
        (_, bounds, words), = reader.chunks(license_scan.pa.array([text]))
        return [(index.names[t], m, a, z) for _, t, m, a, z in index.scan(words, bounds)]

    for i in range(200):
        assert found(f"a{i} b{i} c{i} all rights reserved d{i} e{i} f{i}") == [("three", 3, 3, 5)]
        assert found(f"a{i} b{i} c{i} public domain d{i} unlicense e{i} unlicense") == [("two", 2, 3, 4), ("one", 1, 6, 6), ("one", 1, 8, 8)]
    assert found("w x released under MIT license y z") == [("mit", 4, 2, 5)]
    assert found("x all other rights reserved y") == [("three", 3, 1, 4)]
    assert found("under x x released under the mit license y") == [("mit", 5, 3, 7)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")


def cloud(n, dim=8):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, dim))
    return [(base[rng.integers(6)] + rng.normal(scale=rng.choice([0.02, 0.2, 0.8]), size=dim)).astype(np.float32).tolist() for _ in range(n)]


ODD = [(1000, None), (1001, [0.0] * 8), (1002, [1.0] * 7 + [None]), (1003, [float("nan")] * 8), (1004, [float("inf")] + [0.0] * 7), (1005, []), (1006, [1.0, 2.0])]


def test_cover_tree_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 64)
    rows = list(enumerate(cloud(400)))
    rows += [(400 + i, rows[0][1]) for i in range(30)]
    u = np.array([v for _, v in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    root = np.arange(len(u))
    for _ in range(len(u)):
        new = np.minimum(root, np.where(link, root[None, :], len(u)).min(axis=1))
        if (new == root).all():
            break
        root = new
    got = {r.vec_id: r for r in cover_tree.link_vectors(vectors(spark, rows + ODD), 0.9).collect()}
    assert [got[i].n_links for i in range(len(u))] == link.sum(axis=1).tolist() and [got[i].component_id for i in range(len(u))] == root.tolist()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in ODD)
    assert cover_tree.link_vectors(vectors(spark, []), 0.9).isEmpty()


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(va_search, "VECTORS_PER_BLOCK", 50)
    rows = list(enumerate(cloud(260)))
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(int)
    got = {}
    for r in va_search.top_k(vectors(spark, rows + ODD), lambda i: i % 20 == 0).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in range(0, 260, 20):
        scores = sorted(((-int(x[q] @ x[i]), i) for i in range(260) if i != q))[:20]
        assert got[q] == [(i, -s) for s, i in scores]
    assert va_search.top_k(vectors(spark, []), lambda i: i % 20 == 0).isEmpty()


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, str(SF))
    known = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = out.collect()
    assert got and {r.doc_id for r in got} <= known and all(r.n_ids == len(r.ids) for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "ngram_jaccard_join", "source_mixing", "sentencepiece"]

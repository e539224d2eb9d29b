"""Near duplicates, embeddings, pages, archives and the pipeline."""

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm.components import components
from ledgerloom.llm.embeddings import near_duplicate_vectors, neighbour_graph
from ledgerloom.llm.near import SLOTS, _joined_on_prefixes, inverse_frequencies, near_duplicates, weighted_jaccard, weighted_set
from ledgerloom.llm.pages import extracted, main_text
from ledgerloom.llm.tokens import WordCodes, folded_words
from ledgerloom.llm.warc import derivatives, digest, page_responses, plain_text, read_records, record_bytes, written_files


def groups(ids, edges):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (130, 129), (300, None)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {i for e in edges for i in e if i and e[0] != e[1] and None not in e}
    assert got == groups(ids, [e for e in edges if set(e) <= ids])


def edited(text, rng, share):
    words = text.split()
    for i in rng.choice(len(words), int(len(words) * share), replace=False):
        words[i] = f"edit{rng.integers(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(spark, prose):
    rng = np.random.default_rng(5)
    rows = [(i, prose(120, i)) for i in range(40)]
    rows += [(100 + i, edited(rows[i % 5][1], rng, 0.01 + 0.004 * (i % 12))) for i in range(120)]
    rows += [(300 + i, rows[i][1]) for i in range(5)] + [(400, "tiny text"), (401, "tiny text"), (402, ""), (403, ""), (404, None), (405, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_near_duplicates_match_brute_force(copies):
    rows, docs = copies
    members, links = near_duplicates(docs)
    idf, codes = inverse_frequencies(docs, "text"), WordCodes()
    sets = {i: weighted_set(codes.of(folded_words(t)), idf, 5) for i, t in rows}
    want = [(a, b) for a, x in rows for b, y in rows if a < b and x is not None and (x == y or weighted_jaccard(sets[a], sets[b]) >= 0.8)]
    assert len(want) > 100
    got = {r.doc_id: r for r in members.collect()}
    assert {i: r.component_id for i, r in got.items()} == groups([i for i, _ in rows], want)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert got[401].class_id == 400 and got[403].component_id == 402 and got[404].kept and got[405].kept
    for r in links.collect():
        assert r.similarity >= 0.8 and abs(weighted_jaccard(sets[r.a], sets[r.b]) - r.similarity) < 1e-9


def test_prefix_join_finds_every_pair(spark, copies):
    rows, docs = copies
    idf, codes = inverse_frequencies(docs, "text"), WordCodes()
    held = [(i, t) for i, t in rows if t and i < 300]
    sets = {i: weighted_set(codes.of(folded_words(t)), idf, 5) for i, t in held}
    texts = spark.createDataFrame(held, "row long, text string")
    parts = spark.createDataFrame([(i, i % 3) for i, _ in held], "row long, part long")
    got = {(r.a, r.b) for r in _joined_on_prefixes(parts, texts, spark.sparkContext.broadcast(idf), 5, 0.8).collect()}
    want = {(a, b) for a in sets for b in sets if a > b and a % 3 != b % 3 and weighted_jaccard(sets[a], sets[b]) >= 0.8}
    assert want and want <= got and len(got) < len(sets) ** 2 / 4


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs)[0].collect()
    assert len(rows) == odd_docs.count()
    assert sum(r.kept for r in rows if r.class_id == 1 and r.doc_id in (1, 2)) <= 2
    assert near_duplicates(no_docs)[0].count() == 0


def test_weighted_sets_of_short_texts():
    idf, codes = np.ones(SLOTS), WordCodes()
    assert len(weighted_set(codes.of([]), idf, 5)[0]) == 0
    assert len(weighted_set(codes.of([b"a", b"b"]), idf, 5)[0]) == 1
    assert weighted_jaccard(weighted_set(codes.of([]), idf, 5), weighted_set(codes.of([]), idf, 5)) == 0


# embeddings


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 16))
    near = [base[i % 9] + rng.standard_normal(16) * (0.05 + 0.02 * (i % 14)) for i in range(150)]
    x = np.vstack([base, near, base[:4], base[:4] * 7]).astype(np.float32).astype(np.float64)
    bad = [None, [0.0] * 16, [1.0, None] * 8, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [], [1.0] * 8, [1.0] * 8]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(bad)]
    got = {r.vec_id: r for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [(i, j) for i, j in np.argwhere(u @ u.T >= 0.95).tolist() if i < j] + [(1006, 1007)]
    count = np.bincount(np.array(pairs).ravel(), minlength=1008)
    want = groups(list(got), pairs)
    assert len(got) == len(rows)
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (count[i], want[i], want[i] == i), i


def node_table(spark, x):
    rows = [(i, 1, len(v), v.tobytes(), 0.0) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]
    return spark.createDataFrame(rows, "node long, n long, length int, centre binary, radius double")


def test_lists_once_enlarged_stay_so(spark):
    # Groups of all linked nodes; those of 10 need more than 6 neighbours, those of 30 are saturated again later.
    rng = np.random.default_rng(7)
    x = np.vstack([c + rng.standard_normal((n, 64)) * 0.15 for c, n in zip(rng.standard_normal((8, 64)), [10, 30] * 4)])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i, j in np.argwhere(u @ u.T >= 0.95).tolist() if i < j}
    graph, _ = neighbour_graph(node_table(spark, x), float(np.arccos(0.95)), audit=0)
    assert len(want) > 1500 and want <= {(min(r.v, r.u), max(r.v, r.u)) for r in graph.collect()}


def test_vectors_of_empty_and_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, node long, unit string"
    assert near_duplicate_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 2.0], 1, "a"), (1, [1.0, 2.0], 1, "a"), (None, [2.0, 4.0], None, None), (2, None, 2, "b")]
    got = near_duplicate_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.n_links for r in got) == [0, 2, 2, 2] and {r.component_id for r in got} == {1, 2}


# pages


def test_article_is_taken_whole():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>x</p>';</script></head><body>"
        "<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav><div class='ad'>Buy this now, it is good and cheap</div>"
        "<article><h1>Head &amp; line</h1><p><b>First par<b>t</b><br>of it.<p>Short.</p><p>" + "Long text of the story. " * 20 + "</p>"
        "<aside>Side note of some length</aside><form>Mail <input></form><section class='comments'><p>I disagree with all of it</p></section>"
        "</article><footer>&copy; me</footer></body></html>"
    )
    assert main_text(page) == "Head & line First part of it. Short. " + " ".join(["Long text of the story."] * 20)
    for cut in range(0, len(page), 7):
        main_text(page[:cut])


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p>a\n\tb&nbsp;c<p>d", "a b c d"), ("<![x[ <p>ok", ""), ("plain &lt;text", "plain <text"),
        ("<form><article><p>in a form</article></form>", "in a form"), ("<div hidden>no</div><p>yes</p>", "yes"),
        ("<body><div class='page with-sidebar'><div class=menu><a href=1>Home</a></div><div><h2>Title</h2><p>" + "A story. " * 40 + "</div></div>",
         "Title " + " ".join(["A story."] * 40)),
    ],
)
def test_pages_without_the_usual_parts(page, text):
    assert main_text(page) == text or page.startswith("<![")


def test_parts_beside_the_longest_one_are_kept():
    intro, long, end = "The introduction says why. " * 4, "The story goes on and on. " * 80, "In the end all was well. " * 4
    flat = lambda *t: " ".join(" ".join(t).split())
    for tag in ("section", "div", "blockquote", "td"):
        inner = f"<table><tr><td><p>{long}</td></table>" if tag == "td" else f"<{tag}><p>{long}</{tag}>"
        page = f"<body><div id=content><div><p>{intro}</div>{inner}<div><p>{end}</div></div></body>"
        assert main_text(page) == flat(intro, long, end), tag
    page = f"<body><p><a href=1>Home</a></p><p>Short.</p><p>One.</p><p>Two.</p><p>{long}</p><p>A.</p><p>B.</p><p>Last.</p></body>"
    assert main_text(page) == flat("Short. One. Two.", long, "A. B. Last.")
    page = f"<body><div><p>{long}</div><article><p>Another story of some words.</article></body>"
    assert flat(long) in main_text(page)


def test_pages_of_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, doc string"
    rows = [(1, "u", "<p>a</p>", "x", "y"), (1, "u", "<p>a</p>", "x", "y"), (None, None, None, None, None)]
    got = extracted(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text) for r in got) == [(0, "", ""), (1, "u", "a"), (1, "u", "a")]
    assert extracted(spark.createDataFrame([], schema)).count() == 0


# archives


def test_conversion_has_all_visible_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><a href=1>Home</a></nav><div class='ad'>Buy</div>"
        "<p>One</p><script>no()</script><div hidden>no</div><p style='display: none'>no</p><form role=search><button>Go</button></form>"
        "<section class='comments related'><p>I agree</p></section><aside>Side</aside><footer>End</footer></body></html>"
    )
    assert plain_text(page) == ("Top\nHome\nBuy\nOne\nGo\nI agree\nSide\nEnd", "T", 1)
    assert plain_text("<head><title>T</title><p>no body tag")[0] == "no body tag"
    assert plain_text("<p>one</p><![foo[x]]><p>two</p>")[0] == "one\ntwo"
    assert plain_text("<p>one</p><![x[ <p>two</p> three")[0] == "one\ntwo\nthree"


def test_records_come_back_from_files(spark, tmp_path):
    pages = [(1, "http://a.example/x?y=1", "<html><title>A b</title><p>One<p>Two <a href=1>l</a></html>"), (2, None, None), (None, "http://b.example", "é ü")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    responses = page_responses(df, "2024-01-02T03:04:05Z")
    records = derivatives(responses)
    rows = records.collect()
    assert len(rows) == 6 and len({r.record_id for r in rows}) == 6
    source = {r.record_id: r for r in responses.collect()}
    for r in rows:
        of = source[r.refers_to]
        assert r.payload_digest == digest(of.payload.encode()) and r.source_headers == of.http and r.target_uri == of.target_uri
        (head, block), = read_records(record_bytes(r))
        assert block.decode() == r.block and head["WARC-Refers-To"] == r.refers_to and int(head["Content-Length"]) == r.content_length
    assert [r.block for r in rows if r.record_type == "conversion" and r.target_uri and "x?y" in r.target_uri] == ["One\nTwo l"]
    written_files(records, str(tmp_path / "out"))
    members = b"".join(r.member for r in spark.read.parquet(str(tmp_path / "out")).collect())
    back = {h["WARC-Record-ID"]: b for h, b in read_records(members)}
    assert back == {r.record_id: r.block.encode() for r in rows}
    with pytest.raises(ValueError):
        read_records(record_bytes(rows[0]).replace(rows[0].block.encode()[:3], b"###", 1))
    assert derivatives(page_responses(df.where("false"), "2024")).count() == 0


# pipeline


def test_stages_keep_the_columns_and_odd_rows(spark, odd_docs, tmp_path):
    spark.createDataFrame([(1, 1), (5, 1), (6, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "no such words here at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (odd_docs, odd_docs.where("false")):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            docs = corpus_pipeline.saved(out, "test")
        assert docs.count() <= start.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(copies, spark):
    rows, docs = copies
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    members = near_duplicates(docs)[0].collect()
    assert kept == {r.doc_id for r in members if r.kept}


def test_rows_that_share_an_id_are_judged_each_on_its_own(spark, prose, tmp_path):
    path, item = str(tmp_path), prose(30, 900)
    good, bad = [prose(60, i).capitalize() + "." for i in range(60)], [" ".join(w.upper() + "!!" for w in prose(40, i).split()) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(good[:50] + bad[:50])] + [(None, t) for t in [*good[50:], bad[50], item.capitalize() + "."]]
    rows += [(7, bad[51]), (8, good[8] + " end"), (None, good[51] + " end")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 50)) for i in range(100) if i not in (7, 8)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    got = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = corpus_pipeline.saved(stage(spark, got, path), "test")
    # Plainly: no junk, not the benchmark's text, one of each two near copies.
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    pairs = [(8, good[8]), (8, good[8] + " end")], [(None, good[51]), (None, good[51] + " end")]
    assert all(sum(x in kept for x in pair) == 1 for pair in pairs)
    alone = sorted([(i, t) for i, t in rows if "!!" not in t and item.capitalize() + "." != t and not any((i, t) in p for p in pairs)], key=str)
    assert [x for x in kept if not any(x in p for p in pairs)] == alone
    assert sorted((r.doc_id for r in corpus_pipeline.run(spark, path).collect()), key=str) == sorted((i for i, _ in kept), key=str)

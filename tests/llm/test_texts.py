"""Operators on documents against plain Python versions, and their defined results for odd rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm.decontaminate import contaminated_words
from ledgerloom.llm.lines import without_repeated_lines
from ledgerloom.llm.mixing import flight, mixed, source_targets
from ledgerloom.llm.quality import held_out, quality_scores, statistics
from ledgerloom.llm.substrings import without_repeats
from ledgerloom.llm.surrogates import _luhn, distinct_surrogates, with_surrogates
from ledgerloom.llm.tokens import WordCodes, run_hashes
from ledgerloom.llm.warc import plain_text


def by_id(df):
    return {r[0]: r for r in df.collect()}


def test_equal_runs_have_equal_hashes_anywhere():
    codes = WordCodes().of([b"a", b"b", b"c", b"a", b"b", b"c", b"b", b"a"])
    for width in range(1, 6):
        h = run_hashes(codes, width)
        for i in range(len(h)):
            for j in range(len(h)):
                assert (h[i] == h[j]) == (codes[i : i + width].tolist() == codes[j : j + width].tolist())


# substrings


def brute_repeats(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("window, chunk", [(35, 1 << 20), (7, 600), (2, 300), (1, 300)])
def test_repeats_match_brute_force(spark, prose, window, chunk):
    part = prose(window + 9, 99)
    texts = [f"{prose(30 + i, i)} {part} {prose(20, 50 + i)}" if i % 3 else prose(80, i) for i in range(20)] + [part, f"{part} {part}", "a a a a a a", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = by_id(without_repeats(docs, window=window, chunk_bytes=chunk))
    for i, want in enumerate(brute_repeats(texts, window)):
        assert tuple(got[i])[1:4] == want
        words = (texts[i] or "").split()
        assert sum(s["end"] - s["begin"] for s in got[i]["spans"]) == want[1] and len(words) == want[0]


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = without_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted((r.n_words, r.n_removed) for r in rows if r.doc_id == 1) == [(20, 0), (60, 60), (60, 60)]
    assert {(r.n_words, r.kept) for r in rows if r.doc_id in (3, 4, 6)} == {(0, "")}
    assert {r.n_words for r in rows if r.doc_id == 5} == {30_000}
    assert without_repeats(no_docs).count() == 0


# lines


def brute_lines(rows, min_words):
    """Runs of every length; a line alone needs so many words."""
    rows = sorted(rows)
    solid = {i: [(k, x) for k, x in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for i, t in rows}
    places = {}
    for i, _ in rows:
        for k in range(len(solid[i])):
            for n in range(1, len(solid[i]) - k + 1):
                places.setdefault(tuple(x for _, x in solid[i][k : k + n]), []).append((i, k))
    gone, deepest = {i: set() for i, _ in rows}, dict.fromkeys([i for i, _ in rows], 0)
    for run, found in places.items():
        for i, k in found if len(found) > 1 else []:
            if len(run) & (len(run) - 1) == 0:
                deepest[i] = max(deepest[i], len(run))
            if (i, k) != found[0] and (len(run) > 1 or len(run[0].split()) >= min_words):
                gone[i].update(solid[i][j][0] for j in range(k, k + len(run)))
    text = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}
    return {i: (text[i], len(solid[i]), len(gone[i]), deepest[i]) for i in text}


@pytest.mark.parametrize("min_words", [1, 2, 5])
def test_lines_match_brute_force(spark, min_words):
    rng = np.random.default_rng(min_words)
    rows = [(i, "\n".join(rng.choice(["a", "b c", " c  d e", "d e f g h", " ", ""], size=rng.integers(1, 25)))) for i in range(30)]
    rows += [(100, "x\ny\nz\nx\ny\nz\nw"), (101, "q\n\nx\n \ny\nz"), (102, "m\nm\nm\nm\nm"), (103, "one two three four five"), (104, "u\none two three four five\nv")]
    long = [f"line {k}" for k in range(70)]
    rows += [(200, "\n".join(long)), (201, "\n".join(["own", *long[:67], "end"]))]
    got = without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), min_words=min_words).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed, r.deepest) for r in got} == brute_lines(rows, min_words)
    assert {r.deepest for r in got if r.doc_id > 199} == {64}


def test_lines_of_odd_rows(spark, odd_docs, no_docs):
    more = odd_docs.unionByName(odd_docs.limit(0)).withColumnRenamed("row", "n_lines")
    rows = without_repeated_lines(more, min_words=1).collect()
    assert len(rows) == odd_docs.count() and "key" in rows[0].asDict()
    assert [r.text for r in rows if r.doc_id == 2] == [""]
    assert {r.text for r in rows if r.doc_id == 3} == {None} and {r.n_lines for r in rows if r.doc_id == 3} == {0}
    # Rows alike in id and text are one document and get the same result: both stay.
    assert sum(r.text != "" for r in rows if r.doc_id == 1) == 3
    assert without_repeated_lines(no_docs).count() == 0


# decontamination

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(t):
    return FOLDED.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute_contamination(docs, items, window):
    where = {}
    for i, t in items:
        w = fold(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1):
            if n:  # an item without an id counts but is not named
                where.setdefault(tuple(w[k : k + n]), set()).update([] if i is None else [str(i)])
    sizes = {len(k) for k in where}
    out = []
    for _, t in docs:
        w, hit, named = fold(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in where:
                    hit.update(range(k, k + n))
                    named |= where[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(named)))
    return out


def test_contamination_matches_brute_force(spark, prose):
    items = [(i, prose(n, 500 + i)) for i, n in enumerate([40, 13, 12, 5, 2, 1, 30])] + [(20, None), (21, ""), (22, prose(40, 500)), (None, prose(15, 1))]
    docs = [(i, prose(50, i)) for i in range(10)]
    docs += [(10 + i, f"{prose(20, 50 + i)}. {t.upper()}! {prose(9, 70 + i)}") for i, (_, t) in enumerate(items) if t]
    docs += [(30, " ".join(prose(40, 500).split()[5:25])), (31, f"{prose(13, 501)} {prose(13, 501)}"), (32, None), (33, "É straße " + items[5][1]), (34, "")]
    got = by_id(contaminated_words(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    for (i, _), want in zip(docs, brute_contamination(docs, items, 13)):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == want


def test_contamination_of_odd_rows(spark, odd_docs, no_docs, prose):
    items = spark.createDataFrame([(1, prose(60, 1), "x")], "item_id long, text string, doc_id string")
    rows = contaminated_words(odd_docs, items).collect()
    assert len(rows) == odd_docs.count() and sum(r.n_hit == 60 for r in rows) == 3
    assert contaminated_words(no_docs, items).count() == 0
    assert {r.n_hit for r in contaminated_words(odd_docs, items.where("false")).collect()} == {0}


# quality


def junk(prose, i):
    return " ".join(w.upper() + "!!" for w in prose(40, i).split()) if i % 2 else " | ".join(prose(40, i).split())


def test_quality_on_held_out_documents(spark, prose, odd_docs, no_docs):
    rows = [(i, prose(30 + i, i).capitalize() + "." if i % 3 else junk(prose, i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)] + [(9, None), (None, 1)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    # Held-out labels are not learned from: turning them round changes nothing.
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in got)
    odd = quality_scores(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality_scores(no_docs, labels).count() == 0
    assert {r.score for r in quality_scores(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality_scores(docs, labels.where("false")).collect()} == {0.5}


def test_statistics_are_finite():
    for t in [None, "", " ", "\n\n", "a", "é" * 50, "A" * 1000, "1 " * 1000, "x\n" * 300]:
        assert np.isfinite(statistics(t)).all()


def test_held_out_is_the_checksum_rule(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


# mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        share = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * share for s in names}
        capped |= above


def test_mix_reaches_its_targets(spark, prose):
    rows = [(i, prose(3 + i * 7 % 90, i), ["b", "a", None, "tiny", "é"][min(4, i % 41 % 5 if i > 3 else 3)]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed(docs).collect()
    size = {s: sum(r["size"] for r in got if r.source == s) for s in {r.source for r in got}}
    want = brute_targets(size)
    for s in size:
        own = [r for r in got if r.source == s]
        assert abs(own[0].target - want[s]) < 1e-6 and own[0].source_size == size[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= 3 + 0.01 * want[s]
    assert all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in got)
    again = mixed(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 1), (None, 5)], "source string, size long")
    got = {r.source: r.target for r in source_targets(sizes).collect()}
    want = brute_targets({"a": 1000, "b": 10, "c": 1, None: 5})
    assert got == pytest.approx(want) and got["c"] == 3


def test_mix_of_odd_rows(odd_docs, no_docs):
    rows = mixed(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.copies <= 3 for r in rows)
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    assert mixed(no_docs).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 400):
        size, chance = rng.integers(1, 1000, n), rng.random(n)
        p = flight(chance, size, np.random.default_rng(2), land=False)
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert abs(p.sum() - chance.sum()) < 1e-6 and abs((p * size).sum() - (chance * size).sum()) < 1e-3
        assert set(flight(chance, size, np.random.default_rng(2), land=True)) <= {0.0, 1.0}


def test_flight_keeps_the_expectation():
    chance, size = np.full(12, 0.3), np.arange(1, 13)
    mean = np.mean([flight(chance, size, np.random.default_rng(i), land=False) for i in range(1500)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.06


# personal data


def test_surrogates_keep_shape_and_coreference(spark):
    rows = [
        (1, "Ask ann.lee@mail4.example.com or +1 (017) 555-7713, card 4539 1488 0343 6467, from 97.51.17.173."),
        (2, 'Ann: ann.lee@mail4.example.com token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"; Mr. John Smith, Mrs Eve Smith.'),
        (3, "господин Иванов, госпожа Анна Петрова"), (4, "clean 2024, 3.14 and 12:30"),
    ]
    got = by_id(with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "key"))
    for value in re.findall(r"\S+@\S+com|\+1 \(\S+ \S+\d|4539 [\d ]+\d|97[\d.]+\d|04dbe\w+|Smith|John|Иванов|Петрова", " ".join(t for _, t in rows)):
        assert not any(value in r.text for r in got.values()), value
    mail = re.search(r"\S+@\S+\.example", got[1].text)[0]
    assert mail in got[2].text and re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\d\.[a-z]{7}\.example", mail)
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}, card \d{4} \d{4} \d{4} \d{4}, from 2[45]\d\.\d+\.\d+\.\d+\.", got[1].text)
    assert re.search(r'token = "[0-9a-f]{40}"', got[2].text)
    name = re.search(r"Mr\. (\w+) (\w+), Mrs (\w+) (\w+)\.", got[2].text)
    assert name[2] == name[4] and re.search("(?:rin|rold|mund|vin)$", name[1]) and re.search("(?:lina|ria|nelle|sia)$", name[3])
    assert re.fullmatch(r"господин [А-Яа-я]+, госпожа [А-Яа-я]+ [А-Яа-я]+", got[3].text)
    assert got[4].text == rows[3][1] and got[4].n_entities == 0
    card = re.search(r"card ([\d ]{19})", got[1].text)[1]
    both = spark.createDataFrame([("4539 1488 0343 6467", card)], "a string, b string")
    from pyspark.sql import functions as F

    assert len(set(both.select(_luhn(F.col("a")), _luhn(F.col("b"))).first())) == 1


def test_surrogates_stay_distinct_in_small_shapes(spark):
    texts = [(i, f"{a}@b.co and {a}.{b}@b.co") for i, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "xyz")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = by_id(with_surrogates(docs, "key"))
    one = {re.findall(r"\S+@\S+", t)[0]: re.findall(r"\S+@\S+", got[i].text)[0] for i, t in texts}
    assert len(set(one.values())) == len(one) == 8
    assert not set(one.values()) & set(one)
    other = by_id(with_surrogates(docs, "another key"))
    assert any(other[i].text != got[i].text for i, _ in texts)


def test_bare_words_of_a_titled_name_get_its_surrogate(spark):
    rows = [
        (1, "Mr Ann Lee met Mrs Eve Lee-Smith. Lee's wife Ann Lee saw LEE and Lee-Smith; Leek, McLee and lee stay. Mail Lee@a.example.com"),
        (2, "Lee and Ann are not named here"), (3, "Sir Lee Ford and Miss May Lee: Lee Ford, Lee. Dr O'Neil's, O'Neil"),
    ]
    got = by_id(with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "key"))
    one = re.fullmatch(
        r"Mr (\w+) (\w+) met Mrs (\w+) ([\w-]+)\. (\w+)'s wife (\w+) (\w+) saw (\w+) and ([\w-]+); Leek, McLee and lee stay\. Mail \S+\.example", got[1].text
    )
    ann, lee, smith = one[1], one[2], one[4]
    assert (one[5], one[6], one[7], one[8], one[9]) == (lee, ann, lee, lee.upper(), smith)
    assert "Ann" not in got[1].text and got[1].n_entities == 7
    assert got[2].text == rows[1][1]
    three = re.fullmatch(r"Sir (\w+) (\w+) and Miss (\w+) (\w+): (\w+) (\w+), (\w+)\. Dr (\w+)'s, (\w+)", got[3].text)
    assert (three[5], three[6], three[7]) == (three[1], three[2], three[4]) and three[8] == three[9] and three[4] == lee


def test_surrogates_of_odd_rows(odd_docs, no_docs):
    rows = with_surrogates(odd_docs, "key").collect()
    assert len(rows) == odd_docs.count() and {r.text for r in rows if r.doc_id == 3} == {None}
    assert with_surrogates(no_docs, "key").count() == 0


def test_digest_columns_are_of_the_kept_words(spark):
    from ledgerloom.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    rows = QUERIES["op2_substring_dedup"](spark, path).orderBy("doc_id").limit(3).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    for r in rows:
        if not r.n_removed:
            assert r.kept_sha256 == hashlib.sha256(" ".join(texts[r.doc_id].split()).encode()).hexdigest()


def test_surrogates_end_when_a_shape_is_used_up(spark):
    """Every number of a shape is in the corpus: the surrogates grow, stay distinct and are no value of it."""
    found = spark.createDataFrame([("phone", f"+1 {i:04d}") for i in range(10_000)] + [("ssn", "123-45-6789"), ("ip", "10.0.0.1")], "kind string, value string")
    got = distinct_surrogates(found, "k").collect()
    assert len(got) == 10_002 and len({(r.kind, r.surrogate) for r in got}) == 10_002
    assert not {r.surrogate for r in got} & {r.value for r in got}
    assert all(re.fullmatch(r"\+1 \d{5,9}", r.surrogate) for r in got if r.kind == "phone")


def test_title_and_links_come_from_the_markup():
    """References are decoded, comments and scripts hold no links, a second title is none."""
    html = (
        "<html><head><title>A &amp; B\n <!-- C --></title></head><body><!-- <a href=x>no</a> --><script>'<a href=y>'</script>"
        "<a name=here>anchor</a><a class=z\nhref='/q'>yes</a><svg><title>icon</title></svg><A HREF=r>also</A></body></html>"
    )
    text, title, links = plain_text(html)
    assert title.startswith("A & B") and links == 2 and "anchor" in text and "also" in text
    assert plain_text(None) == ("", "", 0) and plain_text("<title>x")[1] == "x"

"""Operators 11 to 13 against plain versions: Merkle manifest, prefix trie, suffix-tree scores."""

import hashlib
import math
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import merkle, suffixes, tries

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


# --- Merkle manifest ---


def _leaf(row, more=0):
    parts = [row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts])


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def _siblings(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else ""))
        at >>= 1
    return out


def _fold(leaf, siblings):
    for right, other in siblings:
        leaf = H(other, leaf) if right else H(leaf, other)
    return leaf


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        trees.append(_tree([_leaf(r) for r in groups[g]]))
    top = _tree([t[-1][0] for t in trees])
    out = []
    for k, (g, tree) in enumerate(zip(order, trees)):
        for at, r in enumerate(groups[g]):
            way = _siblings(tree, at) + _siblings(top, k)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            given_ = _leaf(r, 1 if hit else 0)
            out.append((r["doc_id"], tree[0][at], tree[-1][0], top[-1][0], H(*[s for _, s in way]), _fold(given_, way)))
    return out


def _proved(docs):
    found = merkle.manifest(docs)
    path = F.col("path")
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(path), merkle.folded(F.col("altered"), path))


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("height", [1, 2, 12])
def test_manifest_equals_plain_version(spark, monkeypatch, height):
    """Trees of one to 40 leaves, over one and over several rounds of blocks."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = [(i, f"text {i}", "abcd"[min(i % 7, 3)] if i else None, "s" if i % 3 else None, i % 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _sorted(_proved(docs).collect()) == _sorted(plain_manifest([r.asDict() for r in docs.collect()]))


def test_manifest_of_odd_rows(spark, odd_docs, no_docs):
    """NULLs in all columns, repeated ids and rows, empty and long texts, other columns with clashing names; no rows."""
    docs = odd_docs.withColumn("n_chars", F.col("row").cast("long")).withColumns({"tree": F.lit("x"), "digest": F.lit(1), "at": F.lit(2), "path": F.lit(3)})
    assert _sorted(_proved(docs).collect()) == _sorted(plain_manifest([r.asDict() for r in docs.collect()]))
    assert _proved(no_docs.withColumn("n_chars", F.col("row"))).collect() == []


def test_largest_count_can_be_altered(spark):
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 0)
    docs = spark.createDataFrame([(one, "t", "en", "s", 2**63 - 1), (one, "t", "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert _sorted(_proved(docs).collect()) == _sorted(plain_manifest([r.asDict() for r in docs.collect()]))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.data())
def test_multiproof_is_minimal_and_expands(n, data):
    """Any set of leaves: what is fetched suffices, and without any one of it some proof can't be made."""
    wanted = sorted(data.draw(st.sets(st.integers(0, n - 1), min_size=1)))
    levels = _tree([H(str(i)) for i in range(n)])
    need = merkle.missing_nodes(np.array(wanted), n)
    given_ = {(level, at): levels[level][at] for level, at in need}
    digests = [levels[0][i] for i in wanted]
    for at, proof in zip(wanted, merkle.expanded(wanted, digests, given_, n)):
        assert [p[1:] for p in proof] == [s for _, s in _siblings(levels, at)]
        assert _fold(levels[0][at], [(p[:1] == "L", p[1:]) for p in proof]) == levels[-1][0]
    for gone in given_:
        with pytest.raises(KeyError):
            merkle.expanded(wanted, digests, {k: v for k, v in given_.items() if k != gone}, n)


def test_proofs_of_some_leaves(spark):
    """Proofs for a few rows need the kept nodes only."""
    levels = _tree([H(str(i)) for i in range(5000)])
    leaves = spark.createDataFrame([("t", i, h) for i, h in enumerate(levels[0])], "tree string, at long, digest string")
    sizes = spark.createDataFrame([("t", 5000)], "tree string, n long")
    nodes = merkle.inner_nodes(leaves, sizes)
    assert nodes.count() == sum(map(len, levels[1:]))
    wanted = leaves.where("at in (0, 7, 4095, 4096, 4999)")
    for r in merkle.proofs(wanted, leaves, nodes, sizes).collect():
        assert [p[1:] for p in r["path"]] == [s for _, s in _siblings(levels, r["at"])]
    got = merkle.proofs(wanted, leaves, nodes, sizes).select(merkle.folded(F.col("digest"), F.col("path")).alias("r")).distinct().collect()
    assert [r["r"] for r in got] == [levels[-1][0]]


# --- prefix trie ---


def plain_nodes(rows):
    """``rows``: (conv_id, turn, role, text). The rebuilt conversations and their nodes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        ends = hashlib.sha256(",".join(str(c) for c in m if built[c] == k).encode()).hexdigest()
        out.append((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k], ends))
    return sorted(out, key=str)


def nodes_of(spark, rows):
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"c": F.lit(1), "depth": F.lit("x"), "shard": F.lit(0)})
    found = tries.prefix_nodes(convs, F.crc32(F.col("c").cast("string").cast("binary")) % 9, F.col("c") - F.col("c") % 5)
    return sorted((tuple(r) for r in found.collect()), key=str)


def _talk():
    """Copies, a very common opening, a long conversation, empty ones after rebuilding."""
    rows = []
    for c in range(150):
        for t in range(1 + c % 9):
            text = "hello" if t < 2 and c % 3 else f"turn {t} of {c % 20} ü" if c % 2 else "again"
            rows.append((c, t, "user" if t % 2 else None, text))
    rows += [(200, t, "user", f"long {t}") for t in range(300)] + [(201, t, "user", f"long {t}") for t in range(305)]
    return rows


@pytest.mark.parametrize("limit", [4, 60, 1 << 14])
def test_trie_equals_plain_version(spark, monkeypatch, limit):
    """Also with shards so small that common openings are cut several times."""
    monkeypatch.setattr(tries, "LIMIT", limit)
    monkeypatch.setattr(tries, "PIECE", 3)
    rows = _talk()
    assert nodes_of(spark, rows) == plain_nodes(rows)


def test_trie_of_odd_rows(spark):
    """NULLs in every column, repeated turn numbers, a conversation that loses all its turns, no rows at all."""
    short = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(None, 1, "user", "x"), (0, None, None, None), (0, 1, "user", ""), (10, 1, "user", "y" * 100_000), (10, None, "user", None), (short, 3, "a", "b")]
    assert nodes_of(spark, rows) == plain_nodes(rows)
    alone = [(short, 3, "a", "b")]
    assert nodes_of(spark, alone) == plain_nodes(alone)
    assert nodes_of(spark, []) == []
    twice = nodes_of(spark, [(0, 1, "u", "same"), (0, 1, "u", "same")])
    assert [r[1] for r in twice] == [0, 1, 2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=6), min_size=1, max_size=40))
def test_double_array_holds_exactly_the_prefixes(words):
    sequence = np.repeat(np.arange(len(words)), [len(w) for w in words])
    depth = np.concatenate([np.arange(1, len(w) + 1) for w in words])
    trie, symbols = tries.packed(sequence, depth, np.concatenate([np.array(w) for w in words]))
    ids = dict(zip(np.concatenate([np.array(w) for w in words]).tolist(), symbols.tolist()))
    prefixes = {tuple(w[:d]) for w in words for d in range(len(w) + 1)}
    reached = {}
    for p in prefixes:
        state = np.array([0])
        for x in p:
            state = trie.step(state, np.array([ids[x]]))
            assert state[0] > 0
        reached[p] = int(state[0])
    assert len(set(reached.values())) == len(prefixes)
    for p, state in reached.items():
        for x, i in ids.items():
            assert (trie.step(np.array([state]), np.array([i]))[0] >= 0) == ((*p, x) in prefixes)


# --- scores ---


def plain_scores(texts):
    """``texts``: (doc_id, text). Probabilities by plain counting."""
    docs = [(d, suffixes.tokens_of(t)) for d, t in texts]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    count = Counter()
    for d, w in docs:
        for n in range(1, suffixes.DEPTH + 2):
            count.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if not out(d))
    total = sum(n for k, n in count.items() if len(k) == 1)
    distinct = sum(len(k) == 1 for k in count)
    base = lambda x, less=0: (max(count[x,] - less, 0) + 1) / (max(total - less, 0) + distinct + 1)

    gains = Counter()
    for d, w in docs:
        for i in range(len(w) if not out(d) else 0):
            p = base(w[i], 1)
            for n in range(1, min(suffixes.DEPTH, i) + 1):
                s = tuple(w[i - n : i])
                if count[s] < suffixes.LEAST:
                    break
                was, p = p, (count[*s, w[i]] - 1 + suffixes.PRIOR * p) / (count[s] - 1 + suffixes.PRIOR)
                gains[s] += math.log(p / was)
    rows = []
    for d, w in docs:
        score = 0.0
        for i, x in enumerate(w):
            p = base(x)
            for n in range(1, min(suffixes.DEPTH, i) + 1):
                s = tuple(w[i - n : i])
                if count[s] < suffixes.LEAST or round(gains[s] * suffixes._PART) < suffixes.DIVERGENCE * suffixes._PART:
                    break
                p = (count[*s, x] + suffixes.PRIOR * p) / (count[s] + suffixes.PRIOR)
            score += math.log10(p)
        known = sum(count[x,] > 0 for x in w)
        rows.append((d, out(d), len(w), known, total, sum(math.log10(base(x)) for x in w), score))
    return rows


def _same_scores(found, texts):
    key = lambda r: tuple(str(x) for x in r[:4]) + (round(r[5], 5),)
    got, want = sorted((tuple(r) for r in found.collect()), key=key), sorted(plain_scores(texts), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-6)


def _texts(prose):
    texts = [(i, " ".join("the cat sat on the MAT and".split() * (i % 4)) + " " + prose(30, i % 50)) for i in range(300)]
    return texts + [(1000 + i, prose(400, i)) for i in range(20)] + [(2000, "")]


@pytest.mark.parametrize(("chunk", "shard"), [(1 << 21, 1 << 22), (500, 1000)])
def test_scores_equal_plain_version(spark, monkeypatch, prose, chunk, shard):
    """One chunk and many, one shard and many."""
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    monkeypatch.setattr(suffixes, "SHARD", shard)
    texts = _texts(prose)
    _same_scores(suffixes.text_scores(spark.createDataFrame(texts, "doc_id long, text string")), texts)


def _coded(texts):
    """A chunk with these learned texts."""
    words = [suffixes.WordCodes().of(suffixes.tokens_of(t)) for t in texts]
    vocabulary, numbers = np.unique(np.concatenate(words), return_inverse=True)
    return {
        "sizes": [len(w) for w in words], "held": [False] * len(words), "vocabulary": suffixes._packed_keys(vocabulary),
        "words": suffixes._packed(numbers.astype(np.uint64)),
    }


def test_scores_ask_only_for_what_other_chunks_may_hold(monkeypatch):
    """Pairs after rare words, and with a word that no other chunk holds, are not sent; their counts are right all the same."""
    monkeypatch.setattr(suffixes, "LEAST", 2)
    rows = [_coded(["the cat sat", "the cat ran", "the own own"]), _coded(["the cat sat"])]
    slices = []
    for number, row in enumerate(rows):
        _, keys, _, own, _ = suffixes.Chunk(row, []).asked(0)
        slices.append(suffixes._slices(0, number, keys, own, 0))
    found = suffixes._totals(pd.concat(slices, ignore_index=True)).set_index("chunk")
    # the, cat, sat, ran, own, the end.
    assert found.loc[-1, "n"] == 6
    first = suffixes.Chunk(rows[0], [suffixes._unpacked(found.loc[0, "answer"], np.int64)])
    assert first.counts[0].tolist() == [4, 3, 2, 4, 4, 3, 1, 4, 4, 2, 2, 4]
    at, keys, inverse, own, known = first.asked(1)
    # the cat, cat sat, sat end; the cat, cat ran (ran: only here; ran end: rare before it); the own, own own, own end.
    assert at.tolist() == [1, 2, 3, 5, 6, 9, 10, 11]
    assert known[inverse].tolist() == [False, False, False, False, True, True, True, True]
    assert own[inverse].tolist() == [2, 1, 1, 2, 1, 1, 1, 1]


def test_scores_answer_gains_by_one_bit():
    """What chunks gain by a context comes back as whether it is retained."""
    keys = np.array([1 << 40, 1 << 50], np.uint64)
    least = int(suffixes.DIVERGENCE * suffixes._PART)
    slices = [suffixes._slices(-1, chunk, keys, np.array(own), 0) for chunk, own in ((0, [least, 5]), (1, [0, least - 6]))]
    found = suffixes._totals(pd.concat(slices, ignore_index=True)).set_index("chunk")
    assert [suffixes._unpacked(found.loc[c, "answer"], np.int64).tolist() for c in (0, 1)] == [[1, 0], [1, 0]]


def test_scores_delete_what_exchanges_wrote(spark, prose, monkeypatch, tmp_path):
    """Totals and shuffle files of an exchange do not outlive it, and the session's setting is as before."""
    monkeypatch.setattr(suffixes, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    spark.conf.unset(suffixes._CLEANUP)
    before = spark.conf.get(suffixes._CLEANUP, None)
    suffixes.text_scores(spark.createDataFrame(_texts(prose), "doc_id long, text string"))
    assert spark.conf.get(suffixes._CLEANUP, None) == before
    assert sorted({f.name.split("-")[0] for f in tmp_path.iterdir()}) == ["chunks", *(f"exchange{k}" for k in range(suffixes.DEPTH + 2))]


def test_scores_are_probabilities_and_beat_single_words(spark, prose):
    """Every word after a state adds up to one, unknown words included; held-out texts gain from the contexts."""
    found = suffixes.text_scores(spark.createDataFrame(_texts(prose), "doc_id long, text string")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]
    codes = np.arange(5)
    counts = np.array([3.0, 0.0, 9.0, 1.0, 2.0])
    base = suffixes._base(counts, counts.sum(), 4)
    # Index 1 stands for all unknown words.
    state = (np.array([2.0, 0, 5, 0, 0]) + suffixes.PRIOR * base) / (7 + suffixes.PRIOR)
    assert len(codes) == 5 and math.isclose(base.sum(), 1) and math.isclose(state.sum(), 1)


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    """NULL ids and texts, repeated rows, empty and long texts, clashing columns; no rows; nothing to learn from."""
    docs = odd_docs.withColumns({"chunk": F.lit(1), "held": F.lit("x"), "docs": F.lit(2)})
    _same_scores(suffixes.text_scores(docs), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert suffixes.text_scores(no_docs).collect() == []
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    only = [(i, "a b c") for i in out]
    _same_scores(suffixes.text_scores(spark.createDataFrame(only, "doc_id long, text string")), only)
    assert suffixes.text_scores(spark.createDataFrame(only, "doc_id long, text string")).first()["base_score"] == 0

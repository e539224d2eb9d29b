"""Near-duplicate documents by improved consistent weighted sampling.

A document is a weighted set: its shingles of ``width`` words, each weighing its count times the mean inverse document
frequency of its words. Frequencies are counted over all documents. ``bands * depth`` consistent weighted samples are
drawn; two documents agree in one with a probability equal to their weighted Jaccard similarity. Documents that agree in
a whole band are candidates, and every candidate pair is verified on the full weighted sets.

Equal texts are one class and only its representative goes on. A band may be shared by very many documents, so a bucket
is not spelled out into pairs: its most central document (the pivot) is compared with all others. Only where the bucket
then still falls into several components it is looked at again: all pairs across components in a bucket of up to
``SMALL`` documents, and for the documents of larger ones an exact join on the rarest part of their sets. So every pair in
a bucket that reaches the threshold and could join two components is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.tables import carried, restored, row_key, saved
from ledgerloom.llm.tokens import MULTIPLIER, WordCodes, folded_words, mix, run_hashes

#: Words are counted in this many slots, so the table of frequencies has this size whatever the corpus.
SLOTS = 1 << 18
#: Shingles share this many rows of random draws; a sample still names the shingle itself.
DRAWS = 1 << 14
SMALL = 16
SEED = 20240517


@lru_cache(maxsize=2)
def _draws(samples: int) -> tuple[np.ndarray, ...]:
    """Random numbers of a sample: r and c from Gamma(2, 1), beta uniform; as r, 1 / r, beta, log c + r * (beta - 1)."""
    u = np.random.default_rng(SEED).random((5, DRAWS, samples)) + 1e-300
    r, log_c, beta = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]
    return tuple(x.astype(np.float32) for x in (r, 1 / r, beta, log_c + r * (beta - 1)))


def weighted_set(codes: np.ndarray, idf: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the shingles and their weights; a text of fewer words is one shingle."""
    width = min(width, len(codes))
    if not width:
        return np.empty(0, np.uint64), np.empty(0)
    hashes = run_hashes(codes, width)
    worth = np.concatenate([[0], np.cumsum(idf[(codes % np.uint64(SLOTS)).astype(np.int64)])])
    worth = (worth[width:] - worth[:-width]) / width
    found, first, count = np.unique(hashes, return_index=True, return_counts=True)
    # Rounded, so that the order of adding does not show.
    return found, count * np.round(worth[first], 6)


def sample_bands(hashes: np.ndarray, weights: np.ndarray, bands: int, depth: int) -> list[int]:
    """One 64-bit key per band of ``depth`` consistent samples."""
    if not len(hashes):
        return []
    n = bands * depth
    r, inverse, beta, rest = _draws(n)
    best, chosen = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64)
    column = np.arange(n)
    for i in range(0, len(hashes), 1024):
        h = hashes[i : i + 1024]
        slot = (h % np.uint64(DRAWS)).astype(np.int64)
        # t = floor(log w / r + beta); log a = log c - r * (t - beta + 1); the smallest a wins.
        t = inverse[slot]
        t *= np.log(weights[i : i + 1024]).astype(np.float32)[:, None]
        t += beta[slot]
        np.floor(t, out=t)
        log_a = r[slot]
        log_a *= t
        np.subtract(rest[slot], log_a, out=log_a)
        k = log_a.argmin(0)
        value = log_a[k, column]
        name = mix(h[k] ^ mix(t[k, column].astype(np.int64).view(np.uint64)))
        chosen, best = np.where(value < best, name, chosen), np.minimum(value, best)
    with np.errstate(over="ignore"):
        key = np.arange(bands, dtype=np.uint64)
        for part in chosen.reshape(bands, depth).T:
            key = mix(key * MULTIPLIER + part)
    return key.view(np.int64).tolist()


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones; 0 if a set is empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    total = float(a[1].sum() + b[1].sum()) - both
    return both / total if total else 0.0


def inverse_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Inverse document frequency by slot of the word, counted over all documents.

    ``sqrt(1 + log((1 + documents) / (1 + documents with the word)))``: smoothed as usual, and damped by the root, so that
    a group of many copies, whose words are common because of the copies, doesn't lose weight against single edits.
    Comes to the driver and goes to the executors: ``SLOTS`` numbers.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, seen, n = WordCodes(), np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for t in batch["text"]:
                slots = np.unique(codes.of(folded_words(t)) % np.uint64(SLOTS)).astype(np.int64)
                seen[slots] += 1
                n += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": np.append(at, -1), "n": np.append(seen[at], n)})

    parts = docs.select(F.col(text).alias("text")).mapInPandas(count, "slot long, n long")
    found = parts.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    n_docs = int(found.loc[found["slot"] < 0, "n"].sum())
    n = np.zeros(SLOTS)
    own = found[found["slot"] >= 0]
    n[own["slot"].to_numpy(np.int64)] = own["n"].to_numpy(float)
    return np.sqrt(1 + np.log((1 + n_docs) / (1 + n)))


def _signed(docs: DataFrame, idf, width: int, bands: int, depth: int) -> DataFrame:
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes()
        for batch in batches:
            keys = [sample_bands(*weighted_set(codes.of(folded_words(t)), idf.value, width), bands, depth) for t in batch["text"]]
            yield batch.drop(columns="text").assign(bands=keys)

    return docs.mapInPandas(sign, "row long, doc string, h1 long, h2 long, k1 long, k2 long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, idf, width: int, threshold: float) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose weighted Jaccard similarity reaches the threshold."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, name, held = WordCodes(), None, None
        for batch in batches:
            out = []
            for a, b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                if a != name:  # rows of a pivot mostly follow one another
                    name, held = a, weighted_set(codes.of(folded_words(ta)), idf.value, width)
                s = weighted_jaccard(held, weighted_set(codes.of(folded_words(tb)), idf.value, width))
                if s >= threshold:
                    out.append((a, b, s))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])

    other = texts.select(F.col("row").alias("b"), F.col("text").alias("tb"))
    pivot = texts.select(F.col("row").alias("a"), F.col("text").alias("ta"))
    return pairs.join(other, "b").join(pivot, "a").select("a", "b", "ta", "tb").mapInPandas(
        verify, "a long, b long, similarity double"
    )


def _slot_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How many of the texts have a shingle in each of ``SLOTS`` slots."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, seen = WordCodes(), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for t in batch["text"]:
                words = codes.of(folded_words(t))
                seen[np.unique(run_hashes(words, min(width, len(words))) % np.uint64(SLOTS)).astype(np.int64)] += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": at, "n": seen[at]})

    found = texts.select("text").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(SLOTS, np.int64)
    n[found["slot"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return n


def _joined_on_prefixes(rows: DataFrame, texts: DataFrame, idf, width: int, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of rows ``(row, part)`` in different parts that may reach the threshold: none that does is missing.

    Shingles are ordered by rarity. Two sets that reach the threshold share a shingle within the first ``1 - threshold`` of the
    weight of each, and at the first shared one, what lies before it and the sizes bound what they can have in common.
    A shingle all of whose rows are in one part is dropped; of the others only rows outside the shingle's largest part
    look for partners, so a large group of copies isn't compared with itself.
    """
    own = texts.join(rows, "row")
    rare = rows.sparkSession.sparkContext.broadcast(_slot_counts(own, width))  # SLOTS numbers

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes()
        for batch in batches:
            for row, part, t in zip(batch["row"], batch["part"], batch["text"]):
                h, w = weighted_set(codes.of(folded_words(t)), idf.value, width)
                order = np.lexsort((h, rare.value[(h % np.uint64(SLOTS)).astype(np.int64)]))
                before = np.cumsum(w[order]) - w[order]
                keep = before <= (1 - threshold) * w.sum() + 1e-6
                yield pd.DataFrame({"token": h[order][keep].view(np.int64), "row": row, "part": part, "before": before[keep], "total": w.sum()})

    schema = "token long, row long, part long, before double, total double"
    tokens = saved(own.select("row", "part", "text").mapInPandas(prefixes, schema), "prefixes")
    per = tokens.groupBy("token", "part").agg(F.count(F.lit(1)).alias("n"))
    main = per.groupBy("token").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    tokens = tokens.join(main.drop("parts"), "token")
    x = tokens.where("part <> main").select("token", F.col("row").alias("x"), F.col("part").alias("px"), F.col("before").alias("bx"), F.col("total").alias("wx"))
    common = F.least(F.col("wx") - F.col("bx"), F.col("total") - F.col("before"))
    enough = common >= threshold / (1 + threshold) * (F.col("wx") + F.col("total")) - 1e-6
    once = (F.col("part") == F.col("main")) | (F.col("x") > F.col("row"))
    met = x.join(tokens, (x["token"] == tokens["token"]) & (F.col("px") != F.col("part")) & once & enough)
    return met.select(F.greatest("x", "row").alias("a"), F.least("x", "row").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8, bands: int = 16, depth: int = 4,
    keys: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``.

    ``members`` has one row ``(doc, class_id, component_id, kept)`` per input row: the smallest id of an equal text, the
    smallest id that links reach, and whether the row is the one of its component that stays. ``links`` are verified
    pairs ``(a, b, similarity)`` of representatives of different texts.

    Texts equal byte for byte, the empty one included, are one class; texts without words link with no other text. A NULL
    text stands alone. Of rows with the same smallest id one is kept; a NULL id counts as smallest. Other columns
    are not read. ``keys`` adds the ``row_key`` of id and text to ``members``. An empty table gives none.
    """
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs, text))
    key = row_key(doc, text)
    wide = docs.select(F.monotonically_increasing_id().alias("row"), carried(doc).alias("doc"), F.col(text).alias("text"), *key)
    alone = F.col("text").isNull()
    wide = wide.select(
        "row", "doc", F.when(alone, F.col("row")).otherwise(F.xxhash64("text")).alias("h1"),
        F.when(alone, F.lit(-1)).otherwise(F.xxhash64(F.lit("second"), "text")).alias("h2"), "k1", "k2", "text",
    )
    # The row numbers are part of the written table; texts are found again by their keys.
    rows = saved(_signed(wide, idf, width, bands, depth).withColumn("id", restored(docs, doc, "doc")).drop("doc"), "signatures")
    classes = saved(
        rows.groupBy("h1", "h2").agg(F.min(F.struct("id", "row", "k1", "k2")).alias("first"), F.min_by("bands", F.struct("id", "row")).alias("bands")),
        "classes",
    )
    band = classes.select(F.col("first.row").alias("row"), F.explode("bands").alias("key"))
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = band.join(shared, "key")
    central = members.groupBy("row").agg(F.sum("n").alias("central"))
    members = saved(members.join(central, "row").select("key", "row", "n", "central"), "buckets")

    wanted = classes.join(members.select("row").distinct(), classes["first"]["row"] == F.col("row"), "left_semi")
    wanted = wanted.select("first.k1", "first.k2", "first.row")
    texts = docs.select(*key, F.col(text).alias("text")).join(wanted, ["k1", "k2"]).groupBy("k1", "k2")
    texts = saved(texts.agg(F.first("row").alias("row"), F.first("text").alias("text")).select("row", "text"), "texts")

    pivots = members.groupBy("key").agg(F.max_by("row", F.struct("central", -F.col("row"))).alias("pivot"))
    pairs = members.join(pivots, "key").where("row <> pivot").select(F.greatest("row", "pivot").alias("a"), F.least("row", "pivot").alias("b"))
    tested = saved(pairs.distinct(), "pairs")
    links = saved(_verified(tested, texts, idf, width, threshold), "links")
    label = components(links)
    named = members.join(label, members.row == label.id, "left").select("key", "row", "n", F.coalesce("component", "row").alias("part"))
    several = named.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("key")
    named = saved(named.join(several, "key"), "open")
    small = named.where(F.col("n") <= SMALL)
    others = small.select("key", F.col("row").alias("other"), F.col("part").alias("apart"))
    across = small.join(others, "key").where("row > other and part <> apart").select(F.col("row").alias("a"), F.col("other").alias("b"))
    large = saved(named.where(F.col("n") > SMALL).select("row", "part").distinct(), "large")
    onward = _joined_on_prefixes(large, texts, idf, width, threshold)
    pairs = saved(across.unionByName(onward).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    links = saved(links.unionByName(_verified(pairs, texts, idf, width, threshold)), "links")
    label = components(links)

    found = classes.join(label, classes["first"]["row"] == label.id, "left").select(
        "h1", "h2", "first", F.coalesce("component", "first.row").alias("component")
    )
    heads = found.groupBy("component").agg(F.min(F.struct("first.id", "first.row")).alias("head"))
    found = saved(found.join(heads, "component").select("h1", "h2", F.col("first.id").alias("class_id"), "head"), "heads")
    named = ["k1", "k2"] if keys else []
    out = rows.select("row", "id", "h1", "h2", *named).join(found, ["h1", "h2"]).select(
        F.col("id").alias(doc), "class_id", F.col("head.id").alias("component_id"), (F.col("row") == F.col("head.row")).alias("kept"), *named
    )
    first = classes.select(F.col("first.row").alias("row"), F.col("first.id").alias("id"))
    named_links = links.join(first.toDF("a", "id_a"), "a").join(first.toDF("b", "id_b"), "b")
    return out, named_links.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "similarity")

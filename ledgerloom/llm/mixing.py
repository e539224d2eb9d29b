"""Mix sources to target weights by balanced sampling with the cube method.

Each source has a target number of words. A document is taken ``floor(f)`` times for sure, ``f`` being its source's target
over its source's size, and once more with the probability that is left. Which documents get the extra copy is drawn by
the cube method: probabilities of a few documents at a time move along the null space of the constraints (sum of words,
number of documents), up or down with odds that keep the expectation, until all but a few have become 0 or 1.

How the work is spread: a source is dealt into blocks of about ``BLOCK`` documents; each block moves on its own and keeps
both totals, leaving at most two documents undecided. These few are dealt into blocks again, until one block
per source remains, where the last ones are rounded and a few swaps bring the word total back. No block grows with the
input, and no source, however large, comes to one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, n_words, restored, row_key, saved
from ledgerloom.operators.ordered import ordered_row_number

BLOCK = 4096
_TINY = 1e-9


def source_targets(sizes: DataFrame, cap: int = 3, cycle: int = 3) -> DataFrame:
    """``(source, source_size, n_docs, target)`` from ``(source, size)``.

    Sources by code point, NULL last, weigh 1, 2, .. ``cycle``, repeating. They share the total of all sizes by weight, but
    no target goes beyond ``cap`` times the source's size; what is cut off is shared again by weight among the
    others, until none is above. Only single totals come to the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per = per.select("source", F.col("source").isNull().alias("last"), "source_size", "n_docs")
    ranked = ordered_row_number(per, [], ["last", "source"], "place")
    ranked = saved(ranked.withColumn("weight", (F.col("place") - 1) % cycle + 1).drop("place", "last"), "sources")
    most = cap * F.col("source_size")
    total, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    share = total / weights if total else 0.0
    while total:
        above = F.col("weight") * F.lit(share) > most
        fixed, weights = ranked.agg(F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        after = (total - (fixed or 0)) / weights if weights else share
        if after == share:
            break
        share = after
    target = F.least(F.col("weight") * F.lit(float(share)), most.cast("double"))
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Move the chances of one block to 0 or 1, keeping their sum and the sum of ``chance * size``.

    Up to two stay between; with ``land`` they too are decided.
    """
    p, s = chance.tolist(), size.astype(float).tolist()
    draws = iter(rng.random(2 * len(p) + 8).tolist())
    open_, waiting = [], iter(range(len(p)))
    while True:
        while len(open_) < 3 and (i := next(waiting, None)) is not None:
            if _TINY < p[i] < 1 - _TINY:
                open_.append(i)
            else:
                p[i] = float(round(p[i]))
        if len(open_) == 3:
            a, b, c = open_
            u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])  # orthogonal to (1, 1, 1) and to the sizes
            if not any(u):
                u = (1.0, -1.0, 0.0)
        elif len(open_) == 2 and s[open_[0]] == s[open_[1]]:
            u = (1.0, -1.0)
        else:
            break
        up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(open_, u) if x)
        down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(open_, u) if x)
        step = up if next(draws) * (up + down) < down else -down
        for i, x in zip(open_, u):
            p[i] += step * x
            if p[i] < _TINY or p[i] > 1 - _TINY:
                p[i] = float(round(p[i]))
        open_ = [i for i in open_ if 0 < p[i] < 1]
    p = np.array(p)
    return _landed(p, chance, size.astype(np.int64)) if land else p


def _landed(p: np.ndarray, chance: np.ndarray, size: np.ndarray, swaps: int = 4) -> np.ndarray:
    """Decide the last ones, then swap a few taken documents for others not taken while the word total comes nearer."""
    want = float((chance * size).sum())
    out = p >= 0.5
    for _ in range(swaps):
        off = want - float(size[out].sum())
        inside, outside = np.flatnonzero(out), np.flatnonzero(~out)
        if not len(inside) or not len(outside):
            break
        outside = outside[np.argsort(size[outside], kind="stable")]
        sizes = size[outside]
        # For each taken document, the one whose size makes up best for the gap.
        near = np.clip(np.searchsorted(sizes, size[inside] + off), 1, max(1, len(sizes) - 1))
        near = np.minimum(near, len(sizes) - 1)
        lower = np.maximum(near - 1, 0)
        pick = np.where(np.abs(sizes[lower] - size[inside] - off) <= np.abs(sizes[near] - size[inside] - off), lower, near)
        gap = np.abs(sizes[pick] - size[inside] - off)
        k = int(gap.argmin())
        if gap[k] >= abs(off):
            break
        out[inside[k]], out[outside[pick[k]]] = False, True
    return out.astype(float)


def _settled(block: pd.DataFrame) -> pd.DataFrame:
    # Large documents first, so that those left over at the end are small.
    block = block.sort_values(["size", "k1", "k2"], ascending=[False, True, True], ignore_index=True)
    first = block.iloc[0]
    rng = np.random.default_rng([int(first["level"]), int(first["block"]), len(block), int(first["k1"]) % (1 << 64)])
    chance = flight(block["chance"].to_numpy(), block["size"].to_numpy(), rng, bool(first["alone"]))
    return block.assign(chance=chance).drop(columns=["block", "alone", "level"])


def mixed(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", cap: int = 3) -> DataFrame:
    """One row ``(doc, source, size, source_size, target, copies, taken)`` per input row.

    ``size`` is the number of words (0 for NULL), ``target`` the words wanted of the row's source, ``copies`` how often the mix
    takes the document (``cap`` times at most) and ``taken = copies * size``. NULL is a source of its own. A source without
    words has the target 0 and gives no copies. Draws depend on the contents of rows only, so reruns agree, whatever
    the partitioning; rows alike in id, text and source may swap their draws. Other columns are not read. An empty
    table gives none.
    """
    key = row_key(doc, text, source)
    units = docs.select(
        carried(doc).alias("doc"), F.col(source).cast("string").alias("source"), n_words(text).alias("size"), *key, F.monotonically_increasing_id().alias("row")
    )
    # Rows alike are numbered, so that however many there are they don't meet in one block; which of them has which number is all one.
    units = ordered_row_number(saved(units, "units"), ["k1", "k2"], ["row"], "again").drop("row")
    units = saved(units, "units")
    targets = saved(source_targets(units, cap), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    same = units["source"].eqNullSafe(targets["source"])
    state = units.join(targets, same).select(
        "doc", units["source"], "size", "k1", "k2", "again", "source_size", "target", F.floor(ratio).alias("base"), (ratio - F.floor(ratio)).alias("chance"),
        F.col("n_docs").alias("n"),
    )
    schema = "doc string, source string, size long, k1 long, k2 long, again long, source_size long, target double, base long, chance double"
    done, level = None, 0
    while True:
        blocks = F.ceil(F.col("n") / BLOCK)
        dealt = state.withColumns({"block": F.pmod(F.xxhash64("k1", "again", F.lit(level)), blocks), "alone": blocks == 1, "level": F.lit(level)}).drop("n")
        moved = saved(dealt.groupBy("source", "block").applyInPandas(_settled, schema), "moved")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        done = moved.where(~open_) if done is None else done.unionByName(moved.where(~open_))
        left = moved.where(open_)
        if left.isEmpty():
            break
        counts = left.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("source", "of")
        state = left.join(counts, left["source"].eqNullSafe(counts["of"])).drop("of")
        level += 1
    copies = (F.col("base") + F.col("chance")).cast("bigint")
    return done.select(
        restored(docs, doc), F.col("source").cast(docs.schema[source].dataType).alias(source), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )

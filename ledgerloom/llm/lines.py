"""Line dedup: repeated runs of lines, found with the prefix doubling of a suffix array over line ids.

A text is the sequence of its lines; blank lines are no part of it. Every position starts a suffix of line ids. After
round k all suffixes that share their first 2**k lines have the same name, made from the names of their two halves; such a
set is an interval of the suffix array in which neighbours have a common prefix of 2**k lines at least. Suffixes that share
their prefix with no other drop out, and doubling goes on until none is left, so the last round of a suffix tells its longest
common prefix up to a factor of two.

The name of an interval is its first suffix in the order of ids, so "is a later copy" is a comparison. A line goes if it
stands in a later copy of a run of two lines or more, which all are covered by windows of two, or if it is a later copy
alone and has ``min_words`` words. Joined together these windows are the maximal repeated runs.

Everything is DataFrame operations: aggregates that combine before the shuffle and joins to one row per name, which
adaptive execution splits when a line is very common.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import SPACE, row_key, saved

_AT = ("k1", "k2", "line")


def line_table(docs: DataFrame, doc: str, text: str, min_words: int = 1) -> DataFrame:
    """``(doc, k1, k2, pos, alone, h1, h2)``: lines that are not blank, with their place in the text and their hashes.

    ``alone`` tells lines of ``min_words`` words or more. Rows alike in id and text are one sequence.
    """
    lines = docs.select(F.col(doc).alias("doc"), *row_key(doc, text), F.posexplode(F.split(text, "\n", -1)).alias("pos", "own"))
    lines = lines.where(F.col("own").rlike(f"[^{SPACE}]"))
    long_enough = F.col("own").rlike(f"([^{SPACE}]+[{SPACE}]+){{{min_words - 1}}}[^{SPACE}]") if min_words > 1 else F.lit(True)
    return lines.select("doc", "k1", "k2", "pos", long_enough.alias("alone"), F.xxhash64("own").alias("h1"), F.xxhash64(F.lit("second"), "own").alias("h2"))


def _named(suffixes: DataFrame, by: list[str]) -> DataFrame:
    """Those suffixes that share ``by`` with another, named by the first of them."""
    place = F.struct("doc", *_AT)
    names = suffixes.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("name")).where("n > 1").drop("n")
    return suffixes.join(names, by).drop(*by)


def _joined(left: DataFrame, right: DataFrame, shift: int) -> DataFrame:
    """Suffixes whose prefix is ``left`` there and ``right`` ``shift`` lines further on."""
    right = right.select("k1", "k2", (F.col("line") - shift).alias("line"), F.col("name").alias("second"))
    return left.withColumnRenamed("name", "first").join(right, list(_AT))


def repeated_prefixes(lines: DataFrame) -> Iterator[tuple[int, DataFrame]]:
    """For the depths 1, 2, 4, ..: ``(doc, k1, k2, line, alone, name)``, the suffixes whose first lines start another suffix too.

    ``lines`` is what ``line_table`` gives. ``name`` is the first such suffix. Ends when no suffix shares its prefix.
    """
    order = Window.partitionBy("k1", "k2").orderBy("pos")
    # Equal rows give equal lines at equal places; each place counts once.
    placed = lines.groupBy("doc", "k1", "k2", "pos").agg(*[F.first(c).alias(c) for c in ("alone", "h1", "h2")])
    placed = saved(placed.withColumn("line", F.row_number().over(order)).drop("pos"), "lines")
    names, depth = saved(_named(placed, ["h1", "h2"]), "names"), 1
    while not names.isEmpty():
        yield depth, names
        halves = _joined(names, names.select("k1", "k2", "line", "name"), depth)
        names, depth = saved(_named(halves, ["first", "second"]), "names"), 2 * depth


def repeated_runs(later: DataFrame) -> DataFrame:
    """Maximal runs ``(k1, k2, begin, end)`` that windows ``(k1, k2, line, width)`` cover, as numbers of lines not blank."""
    order = Window.partitionBy("k1", "k2").orderBy("line", "width")
    so_far = F.max(F.col("line") + F.col("width")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("line") > so_far, F.lit(True))
    runs = later.withColumn("run", F.sum(fresh.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("k1", "k2", "run").agg(F.min("line").alias("begin"), F.max(F.col("line") + F.col("width")).alias("end")).drop("run")


_ADDED = ("n_lines", "n_removed", "n_runs", "deepest")


def without_repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 5) -> DataFrame:
    """The rows with ``text`` without later copies of repeated line runs, and ``n_lines``, ``n_removed``, ``n_runs``, ``deepest`` added.

    A run is any number of lines in a row, not counting blank ones; a line alone needs ``min_words`` words between ASCII white
    space. It is a later copy if the same lines start anywhere earlier in the order of ids (NULL first) and lines, in the
    same text or another. Later copies are deleted, the first stays. ``n_runs`` are the maximal deleted runs; ``deepest`` is the
    largest power of two of lines in a row that the text shares with any other place (0 if none).

    Blank lines stay. Kept lines are joined by a line feed. A NULL text stays NULL and has no lines; an empty one
    stays empty. A text all of whose lines go becomes empty (or its blank lines) and its row stays. Rows with the same
    id are told apart by their texts; rows alike in both get the same result and are no copies of each other. Other
    columns are passed on, but the added columns replace those of their names. An empty table gives none.
    """
    windows = deepest = None
    for depth, names in repeated_prefixes(line_table(docs, doc, text, min_words)):
        shared = names.select("k1", "k2", F.lit(depth).alias("deepest")).distinct()
        deepest = shared if deepest is None else deepest.unionByName(shared)
        if depth <= 2:
            later = names.where(F.col("name") != F.struct("doc", *_AT))
            own = (later.where("alone") if depth == 1 else later).select("k1", "k2", "line", F.lit(depth).alias("width"))
            windows = own if windows is None else windows.unionByName(own)
    k1, k2 = row_key(doc, text)
    others = [c for c in docs.columns if c not in _ADDED]
    # Internal names, so that columns of the input can't clash with them.
    keyed = docs.select(*others, k1.alias("__k1"), k2.alias("__k2"))
    if windows is None:
        joined = keyed.withColumns({"__gone": F.lit(None).cast("array<struct<begin:int,end:int>>"), "__deepest": F.lit(0)})
    else:
        runs = saved(repeated_runs(windows), "runs").select("k1", "k2", F.struct("begin", "end").alias("run"), F.lit(0).alias("deepest"))
        found = runs.unionByName(deepest.withColumn("run", F.lit(None).cast(runs.schema["run"].dataType)))
        gone = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("run")), F.max("deepest"))
        # Both sides are shuffled whatever their size, so a small corpus shows what a large one costs.
        joined = keyed.join(gone.toDF("__k1", "__k2", "__gone", "__deepest").hint("shuffle_merge"), ["__k1", "__k2"], "left")
    lines = F.split(text, "\n", -1)
    full = F.coalesce(F.array_size(F.filter(lines, lambda x: x.rlike(f"[^{SPACE}]"))), F.lit(0))
    removed = F.coalesce(F.aggregate("__gone", F.lit(0), lambda a, r: a + r["end"] - r["begin"]), F.lit(0))
    kept = F.when(F.coalesce(F.array_size("__gone"), F.lit(0)) == 0, F.col(text)).otherwise(_kept(lines))
    return joined.select(
        *[kept.alias(c) if c == text else F.col(c) for c in others], full.cast("bigint").alias("n_lines"),
        removed.cast("bigint").alias("n_removed"), F.coalesce(F.array_size("__gone"), F.lit(0)).cast("bigint").alias("n_runs"),
        F.coalesce("__deepest", F.lit(0)).cast("bigint").alias("deepest"),
    ).select(*docs.columns, *[c for c in _ADDED if c not in docs.columns])


def _kept(lines: Column) -> Column:
    """Lines outside the removed runs. One fold over the lines keeps the number of lines so far and the next run."""
    solid = lambda x: x.rlike(f"[^{SPACE}]")
    # Numbers of the removed lines, ascending; numbers of all lines that are not blank, by their place.
    removed = F.flatten(F.transform("__gone", lambda r: F.sequence(r["begin"], r["end"] - 1)))
    places = F.filter(F.transform(lines, lambda x, i: F.when(solid(x), i)), lambda i: i.isNotNull())
    out = F.transform(removed, lambda n: F.element_at(places, n))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), out)
    return F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n")

"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ``window`` words (a shorter item is one window). A window is the set of its positional
word shingles, and a document contains it only if it contains all of them. For full containment the necessary prefix
of a set is one element, so only the window's rarest shingle (counted over all documents) is joined with the documents.
Each hit says where the window would start; length and position bounds drop what would not fit, and the words
themselves are compared at last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, restored, saved
from ledgerloom.llm.tokens import WordCodes, folded_words, run_hashes

#: Bits of the map of benchmark shingles. The map is this large whatever the input: when a benchmark outgrows it,
#: more words of the documents go on to the join, and the result stays the same.
MAP_BITS = 1 << 24


def item_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """``(item, words)`` for each window; ``words`` joined by one space. Items without words have none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, t in zip(batch["doc"], batch["text"]):
                words = folded_words(t)
                n = min(window, len(words))
                rows += [(name, b" ".join(words[i : i + n]).decode()) for i in range(len(words) - n + 1) if n]
            yield pd.DataFrame(rows, columns=["doc", "words"])

    found = items.select(carried(item).alias("doc"), F.col(text).alias("text")).mapInPandas(cut, "doc string, words string")
    return found.select(restored(items, item).alias("item"), "words")


def _map_of(windows: DataFrame, shingle: int) -> tuple[np.ndarray, list[int], int]:
    """Bits of the hashes of all window shingles, the widths of shingles, the fewest words of a window."""

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes()
        for batch in batches:
            for w in batch["words"]:
                words = w.encode().split()
                bit = (run_hashes(codes.of(words), min(shingle, len(words))) % np.uint64(MAP_BITS)).astype(np.int64)
                yield pd.DataFrame({"slot": bit >> 5, "bit": bit & 31, "n": len(words)})

    found = windows.select("words").distinct().mapInPandas(hashes, "slot long, bit long, n int")
    # One row per 32 bits of the map at most, whatever the size of the benchmark.
    slots = found.groupBy("slot").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits"), F.min("n").alias("fewest"),
        F.collect_set(F.least("n", F.lit(shingle))).alias("widths"),
    ).toPandas()
    bits = np.zeros(MAP_BITS // 32, np.uint32)
    bits[slots["slot"].to_numpy(np.int64)] = slots["bits"].to_numpy(np.int64).astype(np.uint32)
    widths = sorted({int(w) for ws in slots["widths"] for w in ws})
    return bits, widths, int(slots["fewest"].min()) if len(slots) else 1


def _matching_runs(docs: DataFrame, bits: np.ndarray, widths: list[int], fewest: int) -> DataFrame:
    """Per document its number of words and the stretches in which every shingle may be one of the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # MAP_BITS / 8 bytes

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, bits = WordCodes(), shared.value
        for batch in batches:
            counts, runs = [], []
            for text in batch["text"]:
                words = folded_words(text)
                counts.append(len(words))
                runs.append(_runs(words, codes.of(words), bits, widths, fewest))
            yield pd.DataFrame({"doc": batch["doc"], "row": batch["row"], "n_words": counts, "runs": runs})

    schema = "doc string, row long, n_words long, runs array<struct<start:int,words:string>>"
    return docs.mapInPandas(find, schema)


def _runs(words, codes, bits, widths, fewest) -> list[tuple[int, str]]:
    change = np.zeros(len(words) + 1, np.int32)
    for w in widths:
        slot = run_hashes(codes, w) % np.uint64(MAP_BITS)
        at = np.flatnonzero(bits[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32) & 1)
        np.add.at(change, at, 1)
        np.add.at(change, at + w, -1)
    covered = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
    edges = np.diff(covered)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return [(int(s), b" ".join(words[s:e]).decode()) for s, e in zip(starts, ends) if e - s >= fewest]


def _shingles(words: str, width: str) -> str:
    """SQL for the positional shingles of an array of words."""
    return f"transform(sequence(0, size({words}) - {width}), p -> struct(p as p, array_join(slice({words}, p + 1, {width}), ' ') as shingle))"


def contaminated_words(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = 13, shingle: int = 4,
) -> DataFrame:
    """One row ``(doc, n_words, n_hit, items)`` per input row: words, words inside an occurrence, sorted item ids as text.

    Words are runs of digits, letters and non-ASCII characters after folding A-Z. A NULL or empty text has no words; a
    NULL item has no windows, and one without an id counts but is not named. Rows with the same id are judged each on its own text. Items that share windows are
    all named. Other columns of the inputs are not read. Empty tables give no hits.
    """
    windows = saved(item_windows(items, item, item_text, window), "windows")
    bits, widths, fewest = _map_of(windows, shingle)
    rows = docs.select(carried(doc).alias("doc"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    # The row numbers are part of the written table, so everything below agrees on them.
    seen = saved(_matching_runs(rows, bits, widths, fewest), "runs")

    # The windows that may occur, each with its shingles.
    want = windows.select("words").distinct().withColumn("w", F.split("words", " "))
    want = want.withColumn("width", F.least(F.size("w"), F.lit(shingle)))
    want = want.select("words", F.size("w").alias("n"), "width", F.explode(F.expr(_shingles("w", "width"))).alias("s"))
    want = want.select("words", "n", "width", F.col("s.p").alias("offset"), F.col("s.shingle").alias("shingle"))
    runs = seen.select("row", F.explode("runs").alias("r")).select("row", "r.start", F.col("r.words").alias("run"))
    run_words = runs.withColumn("rw", F.split("run", " "))
    pieces = run_words.select(
        "row", "start", F.size("rw").alias("size"), F.explode(F.array(*[F.lit(w) for w in widths or [shingle]])).alias("width"), "rw"
    ).where("size >= width")
    pieces = pieces.select("row", "start", "size", F.explode(F.expr(_shingles("rw", "width"))).alias("s"))
    pieces = pieces.select("row", "start", "size", F.col("s.p").alias("p"), F.col("s.shingle").alias("shingle"))

    # Rarity over all documents; a window with a shingle that never occurs can't occur.
    rarity = pieces.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_seen"))
    ranked = want.join(rarity, "shingle", "left").groupBy("words", "n").agg(
        F.min(F.coalesce("n_seen", F.lit(0))).alias("rarest"),
        F.min_by(F.struct("shingle", "offset"), F.struct(F.coalesce("n_seen", F.lit(0)), "shingle", "offset")).alias("prefix"),
    )
    prefix = saved(ranked.where("rarest > 0").select("words", "n", "prefix.shingle", "prefix.offset"), "prefix")

    # Length and position bounds, then the words themselves.
    begin = F.col("p") - F.col("offset")
    placed = pieces.join(prefix, "shingle").where((begin >= 0) & (begin + F.col("n") <= F.col("size")))
    placed = placed.select("row", "start", begin.alias("at"), "words", "n").distinct()
    occurs = placed.join(run_words.select("row", "start", "rw"), ["row", "start"])
    occurs = occurs.where(F.array_join(F.slice("rw", F.col("at") + 1, F.col("n")), " ") == F.col("words"))
    occurs = saved(occurs.select("row", (F.col("start") + F.col("at")).alias("begin"), "n", "words"), "occurrences")

    spans = occurs.groupBy("row", "begin").agg(F.max(F.col("begin") + F.col("n")).alias("end"))
    before = Window.partitionBy("row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0))))
    hit = spans.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").cast("bigint").alias("n_hit"))
    named = occurs.select("row", "words").distinct().join(windows.select("words", "item").where("item is not null"), "words")
    named = named.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    found = hit.join(named, "row", "left").withColumnRenamed("row", "hit_row")
    return seen.join(found, seen.row == found.hit_row, "left").select(
        restored(docs, doc), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """The rule: at least a twentieth of the words lies inside occurrences."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))

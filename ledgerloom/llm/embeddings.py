"""Near-duplicate embeddings with NN-descent.

Groups of near copies are folded first: vectors within half the threshold angle of a common centre are all linked with
each other, whatever their number, so such a ball is one node with a centre, a radius and a count, and no pair inside it is
spelled out. Balls are found by hashing centres with random hyperplanes a few times and merging what lies close.

NN-descent then works on the nodes: starting from neighbours in blocks of the same hash, each node's neighbours (and those
whose neighbour it is) are introduced to each other and every node keeps its ``k`` nearest, until hardly anything
changes. A node whose ``k``-th neighbour is still near enough for a link is saturated; the lists of saturated nodes are
doubled and stay so. Finally a bounded set of nodes is compared with all others, and if the graph has missed too many of
their neighbours, lists grow and the descent goes on.

Links are decided in double precision on the vectors themselves. Between two nodes the triangle inequality settles most
vectors at once (linked with all of the other node, or none); only those in between are compared one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.tables import carried, restored, saved

_MARGIN = 1e-6
_BLOCK = 64


def _matrix(column: pd.Series, kind: type = np.float64) -> np.ndarray:
    """Rows of equal length; shorter ones are filled with zeros, which no finite vector of another length can match."""
    parts = [np.frombuffer(b, np.float64) for b in column]
    width = max(map(len, parts), default=0)
    out = np.zeros((len(parts), width), kind)
    for row, p in zip(out, parts):
        row[: len(p)] = p
    return out


def _prepared(vectors: DataFrame, vec: str, embedding: str) -> DataFrame:
    """``(row, id, unit, length)``; ``unit`` is the normalised vector as doubles, NULL for vectors that can't link."""

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = []
            for v in batch["v"]:
                x = None if v is None else np.array([np.nan if c is None else c for c in v], np.float64)
                size = 0.0 if x is None or not np.isfinite(x).all() else float(np.linalg.norm(x / max(1e-300, np.abs(x).max(initial=0.0))))
                units.append((x / np.abs(x).max() / size).tobytes() if size > 0 else None)
            lengths = [0 if u is None else len(u) // 8 for u in units]
            yield pd.DataFrame({"row": batch["row"], "id": batch["id"], "unit": units, "length": lengths})

    held = vectors.select(F.monotonically_increasing_id().alias("row"), carried(vec).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    found = held.mapInPandas(prepare, "row long, id string, unit binary, length int")
    return saved(found.withColumn("id", restored(vectors, vec, "id")).withColumnRenamed(vec, "id") if vec != "id" else found, "vectors")


def _hashed(nodes: DataFrame, bits: int, seed: int) -> DataFrame:
    """``(node, n, key)``: the side of ``bits`` random hyperplanes on which a centre lies."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = np.zeros(len(batch), np.int64)
            for length, own in batch.groupby("length").indices.items():
                planes = np.random.default_rng([seed, int(length)]).standard_normal((int(length), bits))
                side = _matrix(batch["centre"].iloc[own]) @ planes > 0
                keys[own] = (side @ (1 << np.arange(bits))) | int(length) << 40
            yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "key": keys})

    return nodes.select("node", "n", "length", "centre").mapInPandas(sign, "node long, n long, key long")


def _angles(pairs: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """The pairs' rows with the angle between two columns of unit vectors instead of these."""
    kept = [c for c in pairs.columns if c not in (left, right)]
    schema = ", ".join([*[f"{c} {pairs.schema[c].dataType.simpleString()}" for c in kept], "angle double"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = _matrix(batch[left]), _matrix(batch[right])
            width = max(a.shape[1], b.shape[1])
            a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
            yield batch[kept].assign(angle=np.arccos(np.clip((a * b).sum(1), -1, 1)))

    return pairs.mapInPandas(measure, schema)


def _centres(placed: DataFrame, dims: int) -> DataFrame:
    """``(node, n, length, centre)``: the normalised mean of each node's vectors, combined before the shuffle."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Sum what meets here; a node with very many vectors arrives as a few sums.
            for length, own in batch.groupby("length"):
                node, where = np.unique(own["node"].to_numpy(), return_inverse=True)
                sums = np.zeros((len(node), int(length)))
                np.add.at(sums, where, _matrix(own["unit"]))
                yield pd.DataFrame({"node": node, "n": np.bincount(where), "length": int(length), "x": list(sums)})

    parts = placed.select("node", "length", "unit").mapInPandas(unpack, "node long, n long, length int, x array<double>")
    sums = parts.groupBy("node", "length").agg(F.sum("n").alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(dims)])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch["x"].to_list()
            size = [max(1e-300, float(np.linalg.norm(np.asarray(v)[:n]))) for v, n in zip(x, batch["length"])]
            centre = [(np.asarray(v, np.float64)[:n] / s).tobytes() for v, n, s in zip(x, batch["length"], size)]
            yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "length": batch["length"], "centre": centre})

    sums = sums.select("node", "n", "length", F.array(*[F.col(f"x{i}") for i in range(dims)]).alias("x"))
    return sums.mapInPandas(pack, "node long, n long, length int, centre binary")


def _folded(units: DataFrame, dims: int, reach: float, passes: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``(placed, nodes)``: the node of each vector with its angle to the centre, and the nodes."""
    placed = units.select("row", "unit", "length", F.col("row").alias("node"))
    nodes = placed.select("node", F.lit(1).cast("bigint").alias("n"), "length", F.col("unit").alias("centre"))
    for turn in range(passes):
        keys = _hashed(nodes, bits, turn)
        pivot = keys.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.max_by("node", F.struct("n", -F.col("node"))).alias("pivot")).where("many > 1")
        near = keys.join(pivot, "key").where("node <> pivot").select("node", "pivot")
        near = near.join(nodes.select("node", F.col("centre").alias("left")), "node")
        near = near.join(nodes.select(F.col("node").alias("pivot"), F.col("centre").alias("right")), "pivot")
        moves = _angles(near).where(F.col("angle") <= reach).select(F.col("node").alias("was"), "pivot")
        placed = saved(
            placed.join(moves, placed["node"] == moves["was"], "left").select("row", "unit", "length", F.coalesce("pivot", "node").alias("node")), "placed"
        )
        nodes = saved(_centres(placed, dims), "nodes")
    apart = _angles(placed.select("row", "node", F.col("unit").alias("left")).join(nodes.select("node", F.col("centre").alias("right")), "node"))
    inside = F.col("angle") <= reach / 2 - _MARGIN
    apart = apart.select("row", F.when(inside, F.col("node")).alias("ball"), F.when(inside, F.col("angle")).otherwise(F.lit(0.0)).alias("angle"))
    # What lies too far out is a node of its own, numbered apart from the balls.
    placed = saved(
        placed.drop("node").join(apart, "row").select("row", "unit", "length", "angle", F.coalesce("ball", -1 - F.col("row")).alias("node")), "placed"
    )
    size = placed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
    alone = placed.where("node < 0").select("node", "length", F.col("unit").alias("centre"))
    nodes = nodes.select("node", "length", "centre").unionByName(alone).join(size, "node")
    return placed, saved(nodes, "nodes")


_EDGES = "v long, u long, s float"


def _nearest(ids: np.ndarray, centres: np.ndarray, k: int) -> pd.DataFrame:
    """For each of a few nodes its ``k`` nearest among them."""
    s = centres @ centres.T
    np.fill_diagonal(s, -2)
    k = min(k, len(ids) - 1)
    if k < 1:
        return pd.DataFrame({"v": [], "u": [], "s": []})
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return pd.DataFrame({"v": np.repeat(ids, k), "u": ids[best].ravel(), "s": np.take_along_axis(s, best, 1).ravel()})


def _best(edges: DataFrame, k: DataFrame | int) -> DataFrame:
    """The ``k`` nearest of each node; ``k`` may be a table ``(v, k)`` of longer lists."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("s"), "u"))
    edges = edges.groupBy("v", "u").agg(F.max("s").alias("s"))
    if isinstance(k, int):
        return edges.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    edges = edges.join(k.withColumnRenamed("v", "of"), F.col("v") == F.col("of"), "left").drop("of")
    return edges.withColumn("rank", rank).where(F.col("rank") <= F.col("k")).drop("rank", "k")


def _started(nodes: DataFrame, bits: int, turns: int, k: int) -> DataFrame:
    """First neighbours: nodes of the same hash, in blocks of bounded size."""
    out = None
    for turn in range(turns):
        keys = _hashed(nodes, bits, 1000 + turn)
        many = keys.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
        dealt = keys.join(many, "key").withColumn("block", F.pmod(F.xxhash64("node", F.lit(turn)), "blocks"))
        dealt = dealt.join(nodes.select("node", "centre"), "node")
        lists = dealt.groupBy("key", "block").agg(F.collect_list(F.struct("node", "centre")).alias("near"))
        found = _introduced(lists, k)
        out = found if out is None else out.unionByName(found)
    return out


def _introduced(lists: DataFrame, k: int) -> DataFrame:
    def introduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for near in batch["near"]:
                own = {x["node"]: x["centre"] for x in near}
                if len(own) > 1:
                    yield _nearest(np.array(list(own), np.int64), _matrix(pd.Series(list(own.values())), np.float32), k)

    return lists.select("near").mapInPandas(introduce, _EDGES)


def _descended(nodes: DataFrame, graph: DataFrame, k: DataFrame | int, width: int, rounds: int, still: float) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins until less than a share ``still`` of the edges is new."""
    own = nodes.select(F.col("node").alias("u"), "centre")
    for turn in range(rounds):
        back = graph.select(F.col("u").alias("v"), F.col("v").alias("u"))
        # Being the neighbour of very many is no reason for a long list: as many of them as a list has, by chance.
        rank = F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("u", "v", F.lit(turn))))
        back = back.withColumn("rank", rank).where(F.col("rank") <= width).drop("rank")
        around = graph.select("v", "u").unionByName(back).distinct()
        lists = around.join(own, "u").groupBy("v").agg(F.collect_list(F.struct(F.col("u").alias("node"), "centre")).alias("near"))
        after = saved(_best(graph.unionByName(_introduced(lists, width)), k), "graph")
        total, fresh = after.join(graph.select("v", "u", F.lit(1).alias("old")), ["v", "u"], "left").agg(F.count(F.lit(1)), F.count_if(F.col("old").isNull())).first()
        graph = after
        if fresh <= still * total:
            break
    return graph


def neighbour_graph(nodes: DataFrame, reach: float, k: int = 6, rounds: int = 5, audit: int = 256) -> tuple[DataFrame, float]:
    """``(graph, recall)``: the edges ``(v, u, s)``, and the share of audited neighbours near enough for a link that it has.

    Lists of saturated nodes are doubled until none is saturated. ``audit`` nodes (a documented bound) are compared with
    all others; while a neighbour near enough for a link is missing, all lists grow and the descent goes on, up
    to four times.
    """
    # Hashes so long that a bucket holds about half a block.
    bits = max(4, math.ceil(math.log2(max(2, nodes.count()) / (_BLOCK / 2))))
    graph = saved(_best(_started(nodes, bits, 6, k), k), "graph")
    graph = _descended(nodes, graph, k, k, rounds, 0.05)
    farthest = nodes.agg(F.max("radius")).first()[0] or 0.0
    radius = nodes.select(F.col("node").alias("v"), "radius")
    sizes = nodes.select(F.col("node").alias("v"), F.lit(k).alias("k"))
    width = k
    for turn in range(4):
        while True:
            last = graph.groupBy("v").agg(F.count(F.lit(1)).alias("have"), F.min("s").alias("s")).join(radius, "v").join(sizes, "v")
            full = last.where((F.col("have") >= F.col("k")) & (F.acos(F.least("s", F.lit(1.0))) <= reach + F.col("radius") + farthest + 0.01))
            full = saved(full.select("v", (2 * F.col("k")).alias("more")), "saturated")
            if full.isEmpty():
                break
            # A list that was enlarged stays so, whichever others are saturated later.
            sizes = saved(sizes.join(full, "v", "left").select("v", F.coalesce("more", "k").alias("k")), "sizes")
            width = sizes.agg(F.max("k")).first()[0]
            graph = _descended(nodes, graph, sizes, width, 2, 0.0)
        recall = _audited(nodes, graph, reach, audit)
        if recall == 1.0:
            break
        k *= 2
        sizes = saved(sizes.select("v", F.greatest("k", F.lit(k)).alias("k")), "sizes")
        width = max(width, k)
        graph = _descended(nodes, graph, sizes, width, rounds, 0.05)
    return graph, recall


def _audited(nodes: DataFrame, graph: DataFrame, reach: float, audit: int) -> float:
    """Of up to ``audit`` nodes, compared with all others: the share of their possible links that the graph has."""
    asked = nodes.select("node", "centre", "radius").orderBy(F.xxhash64("node")).limit(audit).toPandas()
    if len(asked) < 2:
        return 1.0
    ids, centres, radii = asked["node"].to_numpy(), _matrix(asked["centre"]), asked["radius"].to_numpy()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            c, own = _matrix(batch["centre"]), batch["node"].to_numpy()
            width = max(c.shape[1], centres.shape[1])
            s = np.pad(centres, ((0, 0), (0, width - centres.shape[1]))) @ np.pad(c, ((0, 0), (0, width - c.shape[1]))).T
            near = np.arccos(np.clip(s, -1, 1)) <= reach + radii[:, None] + batch["radius"].to_numpy()[None, :]
            i, j = np.nonzero(near & (ids[:, None] != own[None, :]))
            yield pd.DataFrame({"v": ids[i], "u": own[j]})

    near = nodes.select("node", "centre", "radius").mapInPandas(compare, "v long, u long")
    known = graph.select("v", "u").unionByName(graph.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct()
    found, total = near.join(known.withColumn("known", F.lit(1)), ["v", "u"], "left").agg(F.count("known"), F.count(F.lit(1))).first()
    return found / total if total else 1.0


def near_duplicate_vectors(
    vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95, passes: int = 4, k: int = 6
) -> DataFrame:
    """One row ``(vec, n_links, component_id, kept, recall)`` per input row.

    ``n_links``: other vectors with cosine ``threshold`` or more; ``component_id``: smallest id that links reach, itself
    included; ``kept``: whether that is the row's own; ``recall``: the share of audited possible links that the graph has.

    NULL and zero vectors and those with NULL or non-finite components link with nothing, and so do vectors of
    different lengths. Equal vectors are links. Rows with the same id are vectors of their own. A NULL id is never the
    smallest if there is another. Other columns are not read. An empty table gives none.
    """
    theta = float(np.arccos(threshold))
    rows = _prepared(vectors, vec, embedding)
    units = rows.where("unit is not null").select("row", "unit", "length")
    dims = units.agg(F.max("length")).first()[0] or 0
    bits = max(8, math.ceil(math.log2(max(2, units.count()) / 8)))
    placed, nodes = _folded(units, dims, theta, passes, bits)
    graph, recall = neighbour_graph(nodes, theta, k)

    shape = nodes.select(F.col("node").alias("v"), F.col("radius").alias("rv"), F.col("length").alias("lv"))
    other = nodes.select(F.col("node").alias("u"), F.col("radius").alias("ru"), "n", F.col("length").alias("lu"), F.col("centre").alias("right"))
    pairs = graph.select("v", "u").unionByName(graph.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct()
    near = F.acos(F.least("s", F.lit(1.0))) <= theta + F.col("rv") + F.col("ru") + 0.01
    close = graph.join(shape, "v").join(other.select("u", "ru", "lu"), "u").where(near & (F.col("lv") == F.col("lu"))).select("v", "u")
    pairs = saved(close.unionByName(close.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct(), "pairs")
    asked = placed.select("row", F.col("node").alias("v"), F.col("unit").alias("left")).join(pairs, "v").join(other, "u")
    asked = saved(_angles(asked.select("row", "v", "u", "n", "ru", "left", "right")), "asked")
    edge = theta - F.col("ru")
    whole = asked.where(F.col("angle") < edge - _MARGIN)
    some = asked.where((F.col("angle") >= edge - _MARGIN) & (F.col("angle") <= theta + F.col("ru") + _MARGIN)).select("row", "v", "u")
    one = some.join(placed.select("row", F.col("unit").alias("left")), "row").join(
        placed.select(F.col("node").alias("u"), F.col("row").alias("with"), F.col("unit").alias("right")), "u"
    )
    linked = saved(_linked(one.select("row", "v", "u", "left", "right"), threshold), "linked")
    counts = whole.select("row", F.col("n").alias("more")).unionByName(linked.select("row", F.lit(1).cast("bigint").alias("more")))
    counts = counts.groupBy("row").agg(F.sum("more").alias("more"))
    joined = components(whole.select("v", "u").unionByName(linked.select("v", "u")).distinct(), "v", "u")

    size = nodes.select("node", "n")
    node = placed.select("row", "node").join(size, "node").join(joined, F.col("node") == joined["id"], "left")
    node = node.select("row", (F.col("n") - 1).alias("inside"), F.coalesce("component", "node").alias("component")).join(counts, "row", "left")
    held = rows.select("row", "id").join(node, "row", "left")
    # Vectors that can't link are components of their own.
    held = saved(held.withColumn("component", F.coalesce(F.concat(F.lit("n"), F.col("component").cast("string")), F.concat(F.lit("r"), F.col("row").cast("string")))), "held")
    first = held.groupBy("component").agg(F.min("id").alias("component_id"))
    n_links = F.coalesce("inside", F.lit(0)) + F.coalesce("more", F.lit(0))
    return held.join(first, "component").select(
        F.col("id").alias(vec), n_links.cast("bigint").alias("n_links"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(float(recall)).alias("recall"),
    )


def _linked(pairs: DataFrame, threshold: float) -> DataFrame:
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cosine = (_matrix(batch["left"]) * _matrix(batch["right"])).sum(1) if len(batch) else np.empty(0)
            yield batch.loc[cosine >= threshold, ["row", "v", "u"]]

    return pairs.mapInPandas(link, "row long, v long, u long")

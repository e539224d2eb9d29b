"""Prefix trie of conversations with double arrays.

Equal conversations are one sequence with a count. Sequences are dealt into shards by prefix: of its prefixes of 1, 2, 4, ..
turns a sequence goes by the shortest whose sequences go on for ``LIMIT`` turns at most together, so a very common first
turn is split further down and a shard stays small. Each shard numbers its turns densely and packs its
trie into a double array: a state's child for turn ``t`` is ``BASE[state] + t`` if ``CHECK`` of that slot names the state.
Walking the sequences through the arrays gives the nodes and their sums.

Nodes below the prefix that a shard goes by are in no other shard and are finished there. The nodes above are shared: before
the shards are packed a small table tells each shard their smallest members, which also decide the one shard that accounts for
such a node; their partial sums are then added up. A node is known everywhere by its depth and 128 bits of hash of its turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import saved
from ledgerloom.operators.ordered import ordered_row_number

LIMIT = 1 << 14
#: Ids in a row on their way to a digest.
PIECE = 512
_NODE = ["depth", "p1", "p2"]


def numbered_turns(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(c, rn, h1, h2, bytes)``: turns with their number in the conversation, hashes and the bytes of their text.

    In the order of ``turn`` (NULL first); turns of the same number in that of their hashes, so reruns agree.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = convs.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), F.xxhash64(by, said).alias("h1"),
        F.xxhash64(F.lit("second"), said, by).alias("h2"), F.octet_length(said).cast("long").alias("bytes"),
    )
    numbered = ordered_row_number(rows, ["c"], ["turn", "h1", "h2", "bytes"], "rn")
    return saved(numbered.select("c", "rn", "h1", "h2", "bytes"), "turns")


def rebuilt(turns: DataFrame, borrowed: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """``(conversations (c, length), turns (c, depth, h1, h2, bytes, p1, p2))`` after the first turns were replaced.

    A conversation ``c`` gets the first ``borrowed`` turns of ``base`` in place of its own; both are expressions over ``c``.
    ``p1``, ``p2`` hash the turns up to this one.
    """
    sizes = saved(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select("c", "n", borrowed.alias("h"), base.alias("base")), "conversations")
    whole = sizes.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    plan = sizes.join(whole, "base", "left").withColumn("lent", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = saved(plan.select("c", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    said = ["h1", "h2", "bytes"]
    own = turns.join(plan.select("c", "h", "lent"), "c").where("rn > h").select("c", (F.col("lent") + F.col("rn") - F.col("h")).alias("depth"), *said)
    most = plan.agg(F.max("lent")).first()[0] or 0
    first = turns.where(F.col("rn") <= most).withColumnRenamed("c", "base")
    lent = first.join(plan.select("c", "base", "lent"), "base").where("rn <= lent").select("c", F.col("rn").alias("depth"), *said)
    so_far = Window.partitionBy("c").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    marks = [F.bit_xor(F.xxhash64(*with_)).over(so_far) for with_ in (("depth", "h1", "h2"), ("h2", "h1", "depth"))]
    both = own.unionByName(lent).withColumns({"p1": marks[0], "p2": marks[1]})
    return plan.select("c", "length"), saved(both, "rebuilt")


class DoubleArray:
    """A trie over dense symbols from 0 on: state 0 is the root, ``base[state] + symbol`` the child if ``check`` agrees."""

    def __init__(self) -> None:
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -1, np.int64)
        self.used, self.top, self.free = np.ones(1, bool), 1, 1

    def _grown(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def _open(self, count: int) -> np.ndarray:
        """The next free slots."""
        self._grown(self.top + count)
        slots = np.flatnonzero(~self.used[self.free : self.top + count])[:count] + self.free
        return slots

    def _place(self, symbols: np.ndarray) -> int:
        """A base that gives all these children free slots; after a few tries that is behind the last one."""
        for slot in self._open(16):
            base = slot - symbols[0]
            if symbols[-1] + base < len(self.used) and not self.used[symbols + base].any():
                return int(base)
        return int(self.top - symbols[0])

    def add(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Give ``states`` children; the pairs are distinct, in order of state and symbol, and a state comes once only."""
        if not len(states):
            return
        parents, starts, counts = np.unique(states, return_index=True, return_counts=True)
        for i in np.flatnonzero(counts > 1):
            own = symbols[starts[i] : starts[i] + counts[i]]
            base = self._place(own)
            self._grown(base + int(own[-1]) + 1)
            self.base[parents[i]], self.used[own + base] = base, True
            self.check[own + base] = parents[i]
            self.top = max(self.top, base + int(own[-1]) + 1)
        single = np.flatnonzero(counts == 1)
        slots = self._open(len(single))
        self.base[parents[single]] = slots - symbols[starts[single]]
        self.used[slots], self.check[slots] = True, parents[single]
        if len(slots):
            self.top = max(self.top, int(slots[-1]) + 1)
        full = np.flatnonzero(~self.used[self.free : self.top])
        self.free = self.free + int(full[0]) if len(full) else self.top

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states reached; -1 where there is no such child."""
        at = self.base[states] + symbols
        inside = (at > 0) & (at < len(self.check))
        return np.where(inside & (self.check[np.where(inside, at, 0)] == states), at, -1)


def _levels(depth: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of depth 1, 2, ..; those of one level are in the order of their sequences."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else iter(())


def packed(sequence: np.ndarray, depth: np.ndarray, turn: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The double array of the sequences, and the dense id of each turn.

    ``sequence`` numbers the sequences from 0 on, ``turn`` the turns in any way. Dense ids are given level by level, so most
    siblings have ids in a row and fit into small gaps.
    """
    trie, ids, n = DoubleArray(), np.full(int(turn.max(initial=-1)) + 1, -1, np.int64), 0
    state = np.zeros(int(sequence.max(initial=-1)) + 1, np.int64)
    for rows in _levels(depth):
        here, own = state[sequence[rows]], turn[rows]
        fresh = own[np.lexsort((own, here))]
        fresh = fresh[ids[fresh] < 0]
        fresh = fresh[np.sort(np.unique(fresh, return_index=True)[1])]
        ids[fresh] = np.arange(n, n + len(fresh))
        n += len(fresh)
        pairs = np.unique(np.column_stack([here, ids[own]]), axis=0)
        trie.add(pairs[:, 0], pairs[:, 1])
        state[sequence[rows]] = trie.step(here, ids[own])
    return trie, ids[turn] if len(turn) else turn


def shard_nodes(rows: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard: finished ones and the shard's part of the shared ones.

    ``rows``: ``(c, copies, depth, h1, h2, bytes, p1, p2, cut)``, a sequence's nodes above depth ``cut`` being shared.
    ``shared``: ``(depth, p1, p2, conv, sequences)`` with the smallest member and the number of sequences anywhere.
    """
    rows = rows.sort_values(["c", "depth"], ignore_index=True)
    sequence, depth = np.unique(rows["c"].to_numpy(), return_inverse=True)[1], rows["depth"].to_numpy()
    pairs = np.ascontiguousarray(rows[["h1", "h2"]].to_numpy()).view(np.dtype((np.void, 16))).ravel()
    trie, symbols = packed(sequence, depth, np.unique(pairs, return_inverse=True)[1])

    # Traverse: every sequence walks through the arrays, level by level.
    size = len(trie.check)
    reached, state = np.zeros(len(rows), np.int64), np.zeros(len(rows) and sequence.max() + 1, np.int64)
    levels = list(_levels(depth))
    for own in levels:
        reached[own] = state[sequence[own]] = trie.step(state[sequence[own]], symbols[own])
    states, first = np.unique(reached, return_index=True)
    parent = trie.check
    conv = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(conv, reached, rows["c"].to_numpy())
    conv[0] = rows["c"].min()
    n, nbytes, upper, level = (np.zeros(size, np.int64) for _ in range(4))
    np.add.at(n, reached, rows["copies"].to_numpy())
    n[0] = rows.loc[rows["depth"] == 1, "copies"].sum()
    nbytes[states], level[states] = rows["bytes"].to_numpy()[first], depth[first]
    upper[0], upper[states] = 1, depth[first] < rows["cut"].to_numpy()[first]
    known = {(d, a, b): (c, k) for d, a, b, c, k in zip(*(shared[x] for x in ("depth", "p1", "p2", "conv", "sequences")))}
    p1, p2 = np.zeros(size, np.int64), np.zeros(size, np.int64)
    p1[states], p2[states] = rows["p1"].to_numpy()[first], rows["p2"].to_numpy()[first]
    shown, passing = conv.copy(), np.ones(size, np.int64)
    for s in np.flatnonzero(upper):
        shown[s], passing[s] = known[level[s], p1[s], p2[s]]
    # A shared node is accounted for by the shard that holds its smallest member.
    mine = (shown == conv).astype(np.int64)

    kids, children, leaves = (np.zeros(size, np.int64) for _ in range(3))
    np.add.at(kids, parent[states], 1)
    np.add.at(children, parent[states], mine[states])
    # A shared node that ends here goes on elsewhere if other sequences pass it.
    leaves[states] = (kids[states] == 0) & ((upper[states] == 0) | (passing[states] == 1))
    saved_bytes = (n - mine) * nbytes
    for own in reversed(levels):
        at = np.unique(reached[own])
        np.add.at(saved_bytes, parent[at], saved_bytes[at])
        np.add.at(leaves, parent[at], leaves[at])
    out = np.concatenate([[0], states])
    return pd.DataFrame({
        "shared": upper[out] == 1, "depth": level[out], "p1": p1[out], "p2": p2[out], "conv": shown[out],
        "parent": shown[np.maximum(parent[out], 0)], "n_convs": n[out], "n_children": children[out], "n_leaves": leaves[out], "saved": saved_bytes[out],
    })


_SHARD = "shared boolean, depth long, p1 long, p2 long, conv long, parent long, n_convs long, n_children long, n_leaves long, saved long"


def _dealt(turns: DataFrame, reps: DataFrame) -> DataFrame:
    """The turns of the sequences with the depth ``cut`` and the ``shard`` they go by."""
    power = F.log2("depth") == F.floor(F.log2("depth"))
    marks = turns.where(power)
    weight = marks.groupBy(*_NODE).agg(F.sum(F.col("length") - F.col("depth") + 1).alias("weight")).where(F.col("weight") <= LIMIT)
    light = marks.join(weight.drop("weight"), _NODE)
    cuts = light.groupBy("c").agg(F.min(F.struct(*_NODE)).alias("cut"))
    total = reps.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-int(total) // LIMIT))
    # A sequence all of whose prefixes are common lies in the shared part and may go anywhere.
    by = F.coalesce(F.xxhash64("cut.depth", "cut.p1", "cut.p2"), F.xxhash64("c"))
    plan = reps.join(cuts, "c", "left").select("c", F.coalesce("cut.depth", F.col("length") + 1).alias("cut"), F.pmod(by, F.lit(shards)).alias("shard"))
    return turns.drop("length").join(plan, "c")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, p1, p2, digest)``: SHA-256 of the ids ``c`` that end in a node, ascending, joined by commas.

    Ids are sorted over ranges of all nodes, so a hot node is spread, and joined in pieces. A digest is a chain, so the pieces
    of one node meet in one task, which reads them as a stream.
    """
    order = ["p1", "p2", "depth", "c"]
    placed = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            run = (batch[["p1", "p2", "depth"]].diff().ne(0).any(axis=1)).cumsum()
            part = batch.groupby(run, sort=False).cumcount() // PIECE
            groups = batch.groupby([run, part], sort=False)
            out = groups.agg(p1=("p1", "first"), p2=("p2", "first"), depth=("depth", "first"), first=("c", "first"))
            yield out.assign(ids=groups["c"].agg(lambda c: ",".join(map(str, c)))).reset_index(drop=True)

    pieces = placed.mapInPandas(joined, "p1 long, p2 long, depth long, first long, ids string")
    pieces = pieces.repartition("p1", "p2", "depth").sortWithinPartitions("p1", "p2", "depth", "first")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(batch["p1"], batch["p2"], batch["depth"], batch["ids"]):
                if own == node:
                    state.update(b"," + ids.encode())
                else:
                    done += [(*node, state.hexdigest())] if node else []
                    node, state = own, sha256(ids.encode())
            yield pd.DataFrame(done, columns=["p1", "p2", "depth", "digest"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["p1", "p2", "depth", "digest"])

    return pieces.mapInPandas(digest, "p1 long, p2 long, depth long, digest string")


def prefix_nodes(
    convs: DataFrame, borrowed: Column, base: Column, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (see ``rebuilt``).

    Per node: ``conv`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's smallest member), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes that members after the first share, over the subtree) and ``ends_sha256``.

    NULL roles and texts are empty ones, a NULL turn comes first. Rows without an id belong to no conversation and are left
    out. Repeated rows are turns of their own. A conversation left without turns is a member of the root only. Other columns
    are not read. An empty table has no nodes. The sequence of one conversation (48 bytes a turn) has to fit into a task.
    """
    plan, turns = rebuilt(numbered_turns(convs, conv, turn, role, text), borrowed, base)
    ends = turns.select("c", F.col("depth").alias("length"), "p1", "p2")
    ends = plan.join(ends, ["c", "length"], "left").select("c", F.col("length").alias("depth"), *[F.coalesce(p, F.lit(0)).alias(p) for p in ("p1", "p2")])
    ends = saved(ends, "ends")
    reps = ends.groupBy(*_NODE).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("copies")).withColumnRenamed("depth", "length")
    reps = saved(reps.select("c", "copies", "length"), "sequences")
    own = saved(_dealt(turns.join(reps, "c"), reps), "shards")

    at_root = [F.lit(0).cast("long").alias(x) for x in _NODE]
    members = [F.min("c").alias("conv"), F.count(F.lit(1)).alias("sequences")]
    none = reps.where("length = 0").select(F.lit(-1).cast("long").alias("shard"), F.col("c").alias("conv"), F.lit(1).cast("long").alias("sequences"))
    heads = own.where("depth = 1").groupBy("shard").agg(*members).unionByName(none).select("shard", *at_root, "conv", "sequences")
    above = own.where("depth < cut").groupBy("shard", *_NODE).agg(*members).unionByName(heads)
    node = Window.partitionBy(*_NODE)
    shared = saved(above.withColumns({"conv": F.min("conv").over(node), "sequences": F.sum("sequences").over(node)}), "shared")

    def nodes(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return shard_nodes(left, right)

    found = own.groupBy("shard").cogroup(shared.where("shard >= 0").groupBy("shard")).applyInPandas(nodes, _SHARD)
    found = saved(found, "nodes")
    zero = [F.lit(0).cast("long").alias(x) for x in ("n_children", "n_leaves", "saved")]
    turnless = reps.where("length = 0").select(*at_root, F.col("c").alias("conv"), F.col("c").alias("parent"), F.col("copies").alias("n_convs"), *zero)
    sums = [F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved")]
    merged = found.where("shared").drop("shared").unionByName(turnless).groupBy(*_NODE).agg(F.min("conv").alias("conv"), F.min("parent").alias("parent"), *sums)
    # Shared nodes have children, but for the root of conversations that have no turns at all.
    merged = merged.withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
    every = found.where("not shared").drop("shared").unionByName(merged).join(end_digests(ends), _NODE, "left")
    return every.select(
        F.col("conv").alias(conv), "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("digest", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )

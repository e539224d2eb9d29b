"""Merkle manifest of a table, with the proofs of any rows as octopus multiproofs.

Rows are leaves of one binary tree per group (``lang``); the roots of the groups are the leaves of one more tree. Leaves are
numbered by a distributed row number, and trees are folded in aligned blocks of ``2**HEIGHT`` nodes: a block is
one task's work, its top goes on to the next round, so a tree of a third of all rows is spread like any other. All
inner nodes are kept in a table ``(tree, level, at, digest)``.

A proof needs one sibling per level. Leaves that are to be proved are dealt into partitions by block. Each partition
first works out, from positions alone, the smallest set of nodes that its proofs need and that it can't derive from its own
leaves (the octopus: going up, a sibling that is known too is no request). These coordinates are fetched once, by one
join with the table of nodes; the partition then derives the shared inner nodes and expands every single proof on its own.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, restored, saved
from ledgerloom.operators.ordered import ordered_row_number

HEIGHT = 12
#: The parts of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree string, level int, at long, digest string"


def _field(value: Column) -> Column:
    """``-`` for NULL, else the length in bytes of UTF-8, a colon and the value, so that no two rows read alike."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row from its fields."""
    return F.sha2(F.concat(*[_field(v) for v in values.values()]), 256)


def _height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return max(0, int(n) - 1).bit_length()


def _digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(tree, block, n)``: the blocks that ``nodes`` fall in and the number of leaves of their tree."""
    block = F.shiftright("at", HEIGHT).alias("block")
    # Names given anew keep the two sides of a cogroup apart.
    return nodes.select("tree", block).distinct().join(sizes, "tree").toDF("tree", "block", "n")


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.withColumn("block", F.shiftright("at", HEIGHT))


def inner_nodes(leaves: DataFrame, sizes: DataFrame) -> DataFrame:
    """All nodes ``(tree, level, at, digest)`` above ``leaves`` ``(tree, at, digest)``; ``sizes`` is ``(tree, n)``."""

    def folded(base: int):
        def fold(own: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
            tree, n = about["tree"][0], int(about["n"][0])
            own = own.sort_values("at")
            first, level, digests, out = int(own["at"].iloc[0]), base, own["digest"].to_list(), []
            while level < base + HEIGHT and level < _height(n):
                digests = [_digest(digests[i : i + 2]) for i in range(0, len(digests), 2)]
                first, level = first >> 1, level + 1
                out += [(tree, level, first + i, d) for i, d in enumerate(digests)]
            return pd.DataFrame(out, columns=["tree", "level", "at", "digest"])

        return fold

    largest = sizes.agg(F.max("n")).first()[0] or 0
    out, current = None, leaves.select("tree", "at", "digest")
    for base in range(0, max(1, _height(largest)), HEIGHT):
        groups = _by_block(current).groupBy("tree", "block").cogroup(_blocks(current, sizes).groupBy("tree", "block"))
        found = saved(groups.applyInPandas(folded(base), _NODE), "nodes")
        out = found if out is None else out.unionByName(found)
        current = found.where(F.col("level") == base + HEIGHT).select("tree", "at", "digest")
    return out


def roots(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(tree, digest)``: the last node of each tree; a lone leaf is its own root."""
    left = leaves.select("tree", F.lit(0).alias("level"), "at", "digest").unionByName(nodes).where("at = 0")
    return left.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))


def missing_nodes(positions: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest coordinates ``(level, at)`` that proofs of these leaves need beyond what the leaves themselves give."""
    known, out = np.unique(positions), []
    for level in range(_height(n)):
        beside = known ^ 1
        beside = beside[beside < n]
        out += [(level, int(at)) for at in np.setdiff1d(beside, known, assume_unique=True)]
        known, n = np.unique(known >> 1), (n + 1) // 2
    return out


def expanded(positions: list[int], digests: list[str], fetched: dict[tuple[int, int], str], n: int) -> list[list[str]]:
    """The proof of each leaf, from bottom to top: ``L`` or ``R`` (where the sibling stands) and its digest, empty without one.

    ``fetched`` holds what ``missing_nodes`` names; everything else is derived here, each shared node once.
    """
    proofs: list[list[str]] = [[] for _ in positions]
    known, places = dict(zip(positions, digests)), list(positions)
    for level in range(_height(n)):
        steps, above = {}, {}
        for at in known:
            beside = at ^ 1
            other = "" if beside >= n else known[beside] if beside in known else fetched[level, beside]
            steps[at] = other and "RL"[at & 1] + other
            if at >> 1 not in above:
                above[at >> 1] = _digest([other, known[at]] if at & 1 else [known[at], other])
        for proof, at in zip(proofs, places):
            proof.append(steps[at])
        known, places, n = above, [at >> 1 for at in places], (n + 1) // 2
    return proofs


def proofs(wanted: DataFrame, leaves: DataFrame, nodes: DataFrame, sizes: DataFrame, beyond: DataFrame | None = None) -> DataFrame:
    """``wanted`` (any rows of ``leaves``, with further columns), its ``path`` (the steps from bottom to top) and ``top``.

    ``beyond`` ``(tree, path, top)`` goes on above the root of each tree; ``top`` is the digest that the tree has there as a leaf.
    """
    none = [F.array().cast("array<string>").alias("beyond"), F.lit(None).cast("string").alias("top")]
    about = _blocks(wanted, sizes)
    if beyond is None:
        about = about.select("*", *none)
    else:
        about = about.join(beyond.select("tree", F.col("path").alias("beyond"), "top"), "tree")
    about = saved(about, "blocks")
    dealt = _by_block(wanted)

    def ask(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(missing_nodes(own["at"].to_numpy(), int(block["n"][0])), columns=["level", "at"])
        return found.assign(tree=block["tree"][0], block=block["block"][0])

    asked = dealt.select("tree", "block", "at").groupBy("tree", "block").cogroup(about.select("tree", "block", "n").groupBy("tree", "block"))
    asked = asked.applyInPandas(ask, "tree string, block long, level int, at long")
    every = leaves.select("tree", F.lit(0).alias("level"), "at", "digest").unionByName(nodes)
    fetched = asked.join(every, ["tree", "level", "at"])
    # One row more per block tells the size of the tree and the way on above it.
    fetched = fetched.select("tree", "block", "level", "at", "digest", *none).unionByName(
        about.select("tree", "block", F.lit(-1).alias("level"), F.col("n").alias("at"), F.lit("").alias("digest"), "beyond", "top")
    )

    def expand(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        head, given = given[given["level"] < 0], given[given["level"] >= 0]
        known = {(level, at): d for level, at, d in zip(given["level"], given["at"], given["digest"])}
        on = list(head["beyond"].iloc[0])
        paths = expanded(own["at"].to_list(), own["digest"].to_list(), known, int(head["at"].iloc[0]))
        return own.drop(columns="block").assign(path=[p + on for p in paths], top=head["top"].iloc[0])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields] + ["path array<string>", "top string"])
    return dealt.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInPandas(expand, schema)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(h: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        return F.sha2(F.when(F.startswith(s, F.lit("L")), F.concat(other, h)).otherwise(F.concat(h, other)), 256)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """Digest of a proof's siblings, from bottom to top."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), ""), 256)


def tampered(doc: str = "doc_id") -> Column:
    """Whether the check alters this row: one in seven by the checksum of its id. A NULL id is not altered."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", count: str = "n_chars") -> DataFrame:
    """One row ``(order, leaf, subroot, root, path, altered)`` per row of ``docs``, which has the columns ``FIELDS``.

    ``leaf`` is the row's digest, ``subroot`` the root of its group's tree, ``root`` that of all groups and ``path`` the proof
    of the leaf up to ``root``; ``altered`` is the digest of the row as ``tampered`` leaves it (``count`` one more).

    Leaves are in the order of ``order`` (NULL first), rows with the same one in that of their digests, so reruns agree. Rows
    alike in everything are leaves of their own. A NULL group is a group and comes first; groups are in the order of their
    bytes. NULL fields are written ``-``, an empty text ``0:``. Other columns are not read. An empty table gives no rows.
    """
    fields = {c: F.col(c) for c in FIELDS}
    more = F.col(count).cast("decimal(20,0)") + 1
    altered = F.when(tampered(order) & F.col(count).isNotNull(), leaf_digest(fields | {count: more}))
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), F.col(order).alias("id"), leaf_digest(fields).alias("digest"), altered.alias("altered"))
    rows = ordered_row_number(rows, ["tree"], ["id", "digest"], "at")
    rows = saved(rows.select("tree", (F.col("at") - 1).alias("at"), "digest", carried("id").alias("id"), "altered"), "leaves")
    sizes = saved(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "sizes")
    nodes = inner_nodes(rows, sizes)
    subroots = saved(roots(rows, nodes), "subroots")

    # The tree of trees: its leaves are the subroots, its only group is nameless.
    upper = ordered_row_number(subroots, [], ["tree"], "at")
    upper = saved(upper.select(F.lit("").alias("tree"), (F.col("at") - 1).alias("at"), "digest", F.col("tree").alias("member")), "upper")
    upper_sizes = upper.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    upper_nodes = inner_nodes(upper, upper_sizes)
    root = roots(upper, upper_nodes).first()
    beyond = proofs(upper, upper, upper_nodes, upper_sizes).select(F.col("member").alias("tree"), "path", F.col("digest").alias("top"))
    found = proofs(rows, rows, nodes, sizes, saved(beyond, "beyond"))
    return found.select(
        restored(docs, order, "id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root and root["digest"]).alias("root"),
        "path", F.coalesce("altered", "digest").alias("altered"),
    )

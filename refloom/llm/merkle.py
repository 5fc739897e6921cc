"""Merkle manifest of a dataset: ternary hash trees per group, inclusion proofs, and verification of rows as they are now.

A *leaf* is the hash of a row's columns. The leaves of a group, in order, are reduced three by three to its *subroot*, the subroots of all groups
likewise to the *root*. A *proof* of a leaf is what stands beside its path up to the root.

Cogrouped subtree exchange: positions are found along sorted ranges, so a group of any size is cut into superblocks of ``3 ** LEVELS``
consecutive leaves, each a whole subtree. A first pass hands up one node per superblock, in as many rounds as the largest group needs. Then outer nodes
come back down: every superblock gets one row with all that stands beside *its* path. Leaves and that row are cogrouped by superblock, and one
function finishes the reduction inside, joins the proof and folds the leaf as it is now up to the root. No task holds more than one
superblock, however large a group is; the driver gets a number per round.

Defined results: a NULL column is ``-`` in a leaf, an empty text ``0:``. A NULL group is a group of its own, before all others. Rows with equal ids (a
NULL id comes first) are ordered by their leaf; repeated rows are leaves of their own. A group of one leaf is its subroot, one group's subroot is the
root; the proof of a lone leaf is the hash of nothing. A row without an id is never tampered with by the query. An empty table has an empty manifest.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import materialize
from refloom.operators.skew import number_ranges

ARITY = 3
#: Levels of a superblock: 2,187 leaves.
LEVELS = 7
DIGEST = 64


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Hash of a row: each value as its UTF-8 byte count, ``:`` and itself, ``-`` for NULL."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of every level, from the given ones up."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)])
    return out


def beside(levels: list[list[str]], at: int) -> tuple[list[str], list[int]]:
    """What stands beside the path of node ``at``: per level, the others of its run, joined, and its own place among them."""
    sides, places = [], []
    for nodes in levels[:-1]:
        place = at % ARITY
        run = nodes[at - place : at - place + ARITY]
        sides.append("".join(run[:place] + run[place + 1 :]))
        places.append(place)
        at //= ARITY
    return sides, places


def fold(node: str, sides: Sequence[str], places: Sequence[int]) -> str:
    """The root that a node leads to, given what stands beside its path."""
    for side, place in zip(sides, places, strict=True):
        node = digest(side[: DIGEST * place] + node + side[DIGEST * place :])
    return node


def block_levels(block: int, n: int, levels: int) -> int:
    """Levels inside a superblock of ``n`` nodes. Block 0 is full wherever its tree has more of them, so only it can be a whole tree."""
    return levels if block else height(n)


def _blocked(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(ARITY**levels)))


def rise(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Rounds of nodes (tree, pos, node): the given ones, then the top of each superblock, and so on until each tree has one."""

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, block = pdf.sort_values("pos"), int(pdf["block"].iloc[0])
        found = climb(pdf["node"].tolist(), block_levels(block, len(pdf), levels))[-1]
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "pos": [block], "node": found})

    rounds = [nodes]
    while True:
        blocked = _blocked(rounds[-1].select("tree", "pos", "node"), levels)
        tops = materialize(blocked.groupBy("tree", "block").applyInPandas(top, "tree string, pos long, node string"), "tops")
        rounds.append(tops)
        if not (tops.agg(F.max("pos")).first()[0] or 0):
            return rounds


_OUTER = "tree string, pos long, node string, sides array<string>, places array<int>, subroot string, root string"


def _descend(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The outer rows of ``nodes``, from those of their superblocks."""

    def extend(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, above = left.sort_values("pos", ignore_index=True), right.iloc[0]
        inside = climb(left["node"].tolist(), block_levels(int(left["block"].iloc[0]), len(left), levels))
        paths = [beside(inside, k) for k in range(len(left))]
        left["sides"] = [s + list(above["sides"]) for s, _ in paths]
        left["places"] = [p + list(above["places"]) for _, p in paths]
        left["subroot"], left["root"] = above["subroot"], above["root"]
        return left.drop(columns="block")

    blocked = _blocked(nodes.select("tree", "pos", "node"), levels).groupBy("tree", "block")
    above = outer.withColumn("block", F.col("pos")).groupBy("tree", "block")
    return materialize(blocked.cogroup(above).applyInPandas(extend, _OUTER), "outer")


_OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _finish(leaves: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Reduction inside each superblock, proof and fold of its leaves, beside the one row of outer nodes."""

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, above = left.sort_values("pos", ignore_index=True), right.iloc[0]
        inside = climb(left["node"].tolist(), block_levels(int(left["block"].iloc[0]), len(left), levels))
        outer_sides, outer_places = list(above["sides"]), list(above["places"])
        rest, proofs, folded = "".join(outer_sides), [], []
        for k, now in enumerate(left["now"].tolist()):
            sides, places = beside(inside, k)
            proofs.append(digest("".join(sides) + rest))
            folded.append(fold(now, sides + outer_sides, places + outer_places))
        return pd.DataFrame({
            "doc_id": left["doc_id"].astype("Int64"), "leaf": left["node"], "subroot": above["subroot"], "root": above["root"],
            "proof_sha256": proofs, "folded_root": folded, "verified": [f == above["root"] for f in folded],
        })

    blocked = _blocked(leaves.select("tree", "pos", "doc_id", "node", "now"), levels).groupBy("tree", "block")
    above = outer.withColumn("block", F.col("pos")).groupBy("tree", "block")
    return blocked.cogroup(above).applyInPandas(finish, _OUT)


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source", id_col: str = "doc_id",
    now: dict[str, Column] | None = None, levels: int = LEVELS,
) -> DataFrame:
    """Leaf, subroot, root, proof digest and verification of every row.

    ``now`` gives the present value of changed columns: the leaf of the row with these is folded up beside the original siblings, and the row
    is ``verified`` where that leads to the original root.
    """
    kept = [docs[c] for c in columns]
    present = [(now or {}).get(c, docs[c]) for c in columns]
    # The order of groups: NULL before every text, texts by their bytes.
    tree = F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit(""))
    hashed = docs.select(
        tree.alias("tree"), docs[id_col].cast("long").alias("doc_id"), leaf_hash(kept).alias("node"), leaf_hash(present).alias("now")
    )
    ordered = number_ranges(materialize(hashed, "leaves"), ["doc_id", "node"], ["tree"])
    leaves = ordered.withColumn("pos", F.col("rn") - 1).drop("rn")
    rounds = rise(leaves, levels)

    # Subroots are the leaves of one more tree.
    subroots = number_ranges(rounds[-1].select("tree", "node"), ["tree"])
    groups = subroots.select(F.lit("").alias("tree"), (F.col("rn") - 1).alias("pos"), "node", F.col("tree").alias("of"))
    above = rise(groups, levels)
    none = F.array().cast("array<string>"), F.array().cast("array<int>")
    outer = above[-1].select(
        "tree", "pos", "node", none[0].alias("sides"), none[1].alias("places"), F.lit("").alias("subroot"), F.col("node").alias("root")
    )
    for nodes in above[-2::-1]:
        outer = _descend(nodes, outer, levels)
    named = groups.select("pos", F.col("of")).join(outer, "pos")
    outer = named.select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "node", "sides", "places", F.col("node").alias("subroot"), "root"
    )
    for nodes in rounds[-2:0:-1]:
        outer = _descend(nodes, outer, levels)
    return _finish(leaves, outer, levels)

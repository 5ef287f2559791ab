"""Merkle manifest of a dataset: a tree per source, their roots below one root, a proof per row.

A node is the SHA-256 (lower-case hex) of the hex texts of the nodes it stands for, three consecutive ones
or fewer at the end of a level. Rows get their place by one range shuffle, so no source is ordered in
one task. A superblock is a whole subtree of ``HEIGHT`` levels (or several sources smaller than that):

* going up, superblocks are reduced to one node each, round by round, until every tree has one node;
* going down, the nodes of a round are cogrouped by superblock with the outer proofs of the nodes they
  were reduced to, which gives their own outer proofs;
* at the bottom, rows and outer proofs are cogrouped by superblock, and one function finishes the local
  reduction, joins the proofs and folds the received rows.

Groups hold at most a few superblocks' nodes, however large a source is. Every table in between is
written to the shared folder.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted

ARITY = 3
HEIGHT = 7
DIGEST = 64  # hex digits
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# Nodes of one round: their tree, place in it, the tree's nodes in this round and in the one below.
_NODES = "tree long, pos long, count long, below long, hash string"
_OUTER = "tree long, pos long, below long, subroot string, proof string, path string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def fold(leaf: str, proof: str, path: str) -> str:
    """The root that follows from a leaf and its proof.

    ``proof`` holds the siblings' digests, level by level; ``path`` two digits per level, the place of
    the own node in its run and the length of the run.
    """
    at, node = 0, leaf
    for k in range(0, len(path), 2):
        place, others = int(path[k]), int(path[k + 1]) - 1
        middle, end = at + place * DIGEST, at + others * DIGEST
        node = digest(proof[at:middle] + node + proof[middle:end])
        at = end
    return node


def row_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field ``-`` if null, else its bytes' number, a colon and its text."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _levels(nodes: list[str], whole: bool, height: int) -> list[list[str]]:
    """A superblock's levels: up to its only node if it is a whole tree, else ``height`` more."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= height:
        last = out[-1]
        out.append([digest("".join(last[k : k + ARITY])) for k in range(0, len(last), ARITY)])
    return out


def _proofs(levels: list[list[str]], proof: str, path: str) -> list[tuple[str, str]]:
    """Proof and path of each node of the lowest level, ending in those of the topmost node."""
    above = [(proof, path)]
    for nodes in reversed(levels[:-1]):
        here = []
        for k in range(len(nodes)):
            first = k - k % ARITY
            run = nodes[first : first + ARITY]
            others = "".join(run[: k - first]) + "".join(run[k - first + 1 :])
            rest = above[k // ARITY]
            here.append((others + rest[0], f"{k - first}{len(run)}{rest[1]}"))
        above = here
    return above


def _parts(group: pd.DataFrame, size: int):
    """The subtrees in a group: tree, number among the superblocks of the tree, whether whole, rows."""
    ordered = group.sort_values(["tree", "pos"], kind="stable")
    for tree, rows in ordered.groupby("tree", sort=False):
        yield tree, int(rows["pos"].iloc[0]) // size, int(rows["count"].iloc[0]), rows


def _superblock(size: int, round_: int) -> Column:
    """Key of the superblock of a node.

    The id of a tree is the number of rows before it, so a large tree has the numbers up to the
    next tree for itself; small ones share the key of their stretch of the table.
    """
    tree, pos = F.col("tree"), F.col("pos")
    stretch = size ** (round_ + 1)
    return F.when(F.col("count") > size, tree + F.floor(pos / size)).otherwise(-1 - F.floor(tree / stretch)).alias("superblock")


def numbered(rows: DataFrame, order: list[Column], name: str, path: str) -> DataFrame:
    """Rows with their number (from 0) in the given order, written to ``path``.

    A range shuffle and a sort in each task; the driver sees one count for each task.
    """
    spark = rows.sparkSession
    # Equal rows may hold a third of the table; where they come from lets them be spread.
    spread = [*order, F.col("__tie")]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = (
        rows.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *spread)
        .sortWithinPartitions(*spread)
        .drop("__tie")
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed.write.mode("overwrite").parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    task, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    before, starts = 0, []
    for r in written.groupBy(task.alias("task")).count().orderBy("task").collect():
        starts.append((r["task"], before))
        before += r["count"]
    first = F.broadcast(spark.createDataFrame(starts, "__task long, __before long"))
    return (
        written.join(first, task == F.col("__task"), "left")
        .withColumn(name, F.col("__before") + within)
        .withColumn("__part", task)
        .drop("__at", "__task", "__before")
    )


def _store(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _reduced(nodes: DataFrame, size: int, height: int, round_: int) -> DataFrame:
    """One node for each superblock."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, number, count, rows in _parts(group, size):
            top = _levels(rows["hash"].tolist(), count <= size, height)[-1][0]
            out.append((tree, number, -(-count // size), count, top))
        return pd.DataFrame(out, columns=["tree", "pos", "count", "below", "hash"])

    named = nodes.select("tree", "pos", "count", "hash", _superblock(size, round_))
    return named.groupBy("superblock").applyInPandas(run, _NODES)


def _rounds(nodes: DataFrame, height: int, folder: str) -> list[DataFrame]:
    """The nodes of each round, until every tree has come down to one node."""
    size, out = ARITY**height, [nodes]
    most = nodes.agg(F.max("count")).first()[0] or 0
    while most > 1:
        k = len(out)
        # A finished tree of an earlier round is not touched again.
        out.append(_store(_reduced(out[-1].where("count > 1") if k > 1 else out[-1], size, height, k - 1), f"{folder}/round{k}"))
        most = -(-most // size)
    return out


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """The only node of each tree."""
    out = rounds[0].where("count = 1")
    for nodes in rounds[1:]:
        out = out.unionByName(nodes.where("count = 1"))
    return out.select("tree", "hash")


def _outer(rounds: list[DataFrame], tops: DataFrame, height: int, folder: str) -> list[DataFrame]:
    """Outer proofs of the nodes of every round but the first, from the trees' tops down.

    ``tops`` has tree, subroot, proof and path of the trees' own roots.
    """
    size, found = ARITY**height, {}
    for k in range(len(rounds) - 1, 0, -1):
        ended = rounds[k].where("count = 1").join(tops, "tree").select("tree", "pos", "below", "subroot", "proof", "path")
        if k + 1 in found:
            ended = ended.unionByName(_joined(rounds[k].where("count > 1"), found[k + 1], size, height, k))
        found[k] = _store(ended, f"{folder}/outer{k}")
    return [found[k] for k in sorted(found)]


def _keyed(outer: DataFrame, size: int, round_: int) -> DataFrame:
    """Outer proofs under the superblocks of the nodes below them."""
    # pos * size is the place of the first node below.
    first = outer.select("tree", (F.col("pos") * size).alias("pos"), F.col("below").alias("count"), "subroot", "proof", "path")
    return first.select("*", _superblock(size, round_))


def _joined(nodes: DataFrame, outer: DataFrame, size: int, height: int, round_: int) -> DataFrame:
    """Outer proofs of ``nodes``, one round below ``outer``."""

    def run(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        known = {(r.tree, r.pos // size): r for r in above.itertuples()}
        out = []
        for tree, number, count, rows in _parts(group, size):
            top = known[tree, number]
            levels = _levels(rows["hash"].tolist(), count <= size, height)
            found = _proofs(levels, top.proof, top.path)
            out += [(tree, pos, n, top.subroot, *f) for pos, n, f in zip(rows["pos"], rows["below"], found, strict=True)]
        return pd.DataFrame(out, columns=["tree", "pos", "below", "subroot", "proof", "path"])

    here = nodes.select("tree", "pos", "count", "below", "hash", _superblock(size, round_)).groupBy("superblock")
    above = _keyed(outer, size, round_).groupBy("superblock")
    return here.cogroup(above).applyInPandas(run, _OUTER)


def _source_proofs(tops: DataFrame, height: int, folder: str) -> DataFrame:
    """Proof, path and root of every tree's own root: tree, subroot, proof, path, root."""
    spark = tops.sparkSession
    ordered = _store(numbered(tops.select(F.col("tree").alias("source_tree"), "hash"), [F.col("source_tree")], "pos", f"{folder}/tops"), f"{folder}/subroots")
    total = ordered.count()
    nodes = ordered.select(F.lit(0).cast("long").alias("tree"), "pos", F.lit(total).cast("long").alias("count"), F.lit(0).cast("long").alias("below"), "hash")
    rounds = _rounds(nodes, height, f"{folder}/above")
    top = _tops(rounds).first()
    root = top["hash"] if top else None
    start = spark.createDataFrame([(0, root, "", "")], "tree long, subroot string, proof string, path string")
    outer = _outer(rounds, start, height, f"{folder}/above")
    if outer:
        found = _joined(nodes, outer[0], ARITY**height, height, 0)
    else:
        found = nodes.join(start, "tree").select("tree", "pos", "subroot", "proof", "path")
    return found.join(ordered, "pos").select(F.col("source_tree").alias("tree"), F.col("hash").alias("subroot"), "proof", "path", F.lit(root).cast("string").alias("root"))


def manifest(
    docs: DataFrame,
    folder: str,
    received: dict[str, Column] | None = None,
    fields: list[str] | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
    height: int = HEIGHT,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``leaf``, ``subroot``, ``root``, ``proof``, ``path`` (see
    ``fold``) and ``folded_root``, the root that follows from the row as received and its proof.

    ``fields`` go into a leaf in this order. ``received`` replaces fields by what has arrived; without it
    rows arrive as they were. Leaves of a source ascend by id (nulls first), then by digest; sources
    ascend bytewise, null first. Repeated rows are leaves of their own, empty texts are texts of no
    bytes, other columns are not read. An empty table gives no rows. Ids are whole numbers or texts.
    Tables in between are written below ``folder``.
    """
    spark: SparkSession = docs.sparkSession
    fields = fields or FIELDS
    own = [F.col(quoted(c)) for c in fields]
    came = [(received or {}).get(c, F.col(quoted(c))) for c in fields]
    ids, size = F.col(quoted(id_col)), ARITY**height
    id_type = docs.select(ids.alias("id")).schema["id"].dataType
    leaves = docs.select(
        ids.alias("id"),
        F.col(quoted(group_col)).cast("string").alias("source"),
        row_digest(own).alias("hash"),
        row_digest(came).alias("arrived"),
    )
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("hash"), F.col("arrived")]
    rows = numbered(leaves, order, "at", f"{folder}/leaves")

    # Stretches of a source in one task; a hot source has one for each task, so no join key is hot.
    runs = rows.groupBy("__part", "source").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    trees = runs.groupBy("source").agg(F.min("first").alias("tree"), F.sum("n").alias("count"))
    spans = runs.alias("r").join(trees.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(F.col("r.__part").alias("part"), F.col("r.source").alias("of"), "tree", "count")
    placed = rows.join(spans, (F.col("__part") == F.col("part")) & F.col("source").eqNullSafe(F.col("of")))
    nodes = _store(placed.select("tree", (F.col("at") - F.col("tree")).alias("pos"), "count", "hash", "arrived", F.col("id").cast("string").alias("id")), f"{folder}/placed")

    rounds = _rounds(nodes, height, folder)
    if len(rounds) == 1:
        # Every source has one leaf at most; the round makes no new nodes.
        rounds.append(nodes.select("tree", "pos", "count", F.col("count").alias("below"), "hash"))
    tops = _store(_source_proofs(_tops(rounds[1:]), height, folder), f"{folder}/sources")
    found = tops.first()
    root = found["root"] if found else None
    outer = _outer(rounds, tops.drop("root"), height, folder)

    def run(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        known = {(r.tree, r.pos // size): r for r in above.itertuples()}
        out = []
        for tree, number, count, part in _parts(group, size):
            top = known[tree, number]
            leaf_hashes = part["hash"].tolist()
            proofs = _proofs(_levels(leaf_hashes, count <= size, height), top.proof, top.path)
            for row_id, leaf, arrived, (proof, path) in zip(part["id"], leaf_hashes, part["arrived"], proofs, strict=True):
                out.append((row_id, leaf, top.subroot, proof, path, fold(arrived, proof, path)))
        return pd.DataFrame(out, columns=["id", "leaf", "subroot", "proof", "path", "folded_root"])

    here = nodes.select("*", _superblock(size, 0)).groupBy("superblock")
    above = _keyed(outer[0], size, 0).groupBy("superblock")
    proven = here.cogroup(above).applyInPandas(run, "id string, leaf string, subroot string, proof string, path string, folded_root string")
    return proven.select(F.col("id").cast(id_type).alias(id_col), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof", "path", "folded_root")

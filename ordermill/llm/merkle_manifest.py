"""Merkle manifest of a dataset: digests of records, a tree per partition, a root, and proofs by recomputation.

A record's leaf is the SHA-256 of its fields, each as byte count and value.  Within a partition (here: a language)
leaves stand in order of the record id; every eight consecutive digests become one, level by level, until one is left,
the partition's root; the partitions' roots are joined into one root in the same way.

Checkpoint and recompute: only every third level is stored.  One aligned subtree is then a node of a stored level with
its up to 512 stored descendants, one bounded row; building keeps only the subtree's top, and extracting proofs
recomputes the two levels between from the descendants, writes out each descendant's siblings in them, and drops
them again.  Proofs are extracted from the top down: a subtree takes over the path above it, so a path crosses the
shuffle once per 512 records and level stored.

Everything is DataFrame functions.  Positions are found by ranges (``positions.positioned``), so a language that holds
most rows, or many equal rows, are spread over all tasks.

Defined results: NULL fields are "-", also the id; rows without an id or language come first.  Rows of equal id
follow each other by their digests, so equal tables give equal roots whatever the file order.  An empty table gives
an empty manifest.  Columns other than the fields are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.positions import positioned
from ordermill.session import materialize

FAN_OUT, LEVELS_PER_STEP = 8, 3
SUBTREE = FAN_OUT**LEVELS_PER_STEP
EMPTY_PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field_text(column: Column) -> Column:
    """Byte count, colon and value; "-" for NULL."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*[field_text(f) for f in fields]))


def _runs(nodes: Column) -> Column:
    """The digests one level up."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(nodes) - 1, F.lit(0)), F.lit(FAN_OUT))
    return F.transform(starts, lambda s: digest(F.array_join(F.slice(nodes, s + 1, F.lit(FAN_OUT)), "")))


def _siblings(nodes: Column, at: Column) -> Column:
    """What stands left and right of node ``at`` in its run."""
    inside = F.pmod(at, F.lit(FAN_OUT))
    return F.struct(
        F.array_join(F.slice(nodes, at - inside + 1, inside), "").alias("left"),
        F.array_join(F.slice(nodes, at + 2, F.lit(FAN_OUT - 1) - inside), "").alias("right"))


def _subtrees(nodes: DataFrame, depths: DataFrame, step: int, carried: Sequence[str] = ()) -> DataFrame:
    """Aligned subtrees of a stored level: up to 512 nodes in order, with columns ``carried``, and the levels between.

    ``steps`` is the number of levels to go up from there, less than three at the top of a tree.
    """
    named = depths.select(F.col("tree").alias("__tree"), "depth")
    nodes = nodes.join(named, F.col("tree").eqNullSafe(F.col("__tree")))
    listed = nodes.groupBy("tree", F.expr(f"pos div {SUBTREE}").alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "hash", *carried))).alias("rows"),
        (F.min("depth") - step * LEVELS_PER_STEP).alias("steps"))
    # A level is used several times in what follows; as columns of their own they are worked out once.
    return listed.withColumn("level_0", F.col("rows.hash")).withColumn(
        "level_1", F.when(F.col("steps") >= 1, _runs(F.col("level_0")))).withColumn(
        "level_2", F.when(F.col("steps") >= 2, _runs(F.col("level_1")))).withColumn(
        "level_3", F.when(F.col("steps") >= 3, _runs(F.col("level_2"))))


@dataclass(frozen=True)
class Forest:
    """Trees (column ``tree``) as stored levels: 0, 3, 6, ...; ``depth`` is each tree's number of levels above the leaves."""

    stored: list[DataFrame]
    depths: DataFrame

    def roots(self) -> DataFrame:
        """(tree, hash) of all trees."""
        return self.stored[-1].select("tree", "hash")

    def paths(self, above: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
        """(tree, pos, hash, path, name) and the columns ``carried`` of all leaves; path: siblings left and right, from the leaf up.

        ``above`` (tree, path, name) goes on from the roots; without it paths end there and the name is the root.
        """
        if above is None:
            above = self.roots().select("tree", F.array().cast(EMPTY_PATH).alias("path"), F.col("hash").alias("name"))
        paths = above.select("tree", F.lit(0).cast("bigint").alias("pos"), "path", "name")
        if len(self.stored) == 1:  # every tree is one leaf
            return _same_tree(self.stored[0], paths.drop("pos"))
        for step in range(len(self.stored) - 2, -1, -1):
            extra = carried if step == 0 else ()
            groups = _subtrees(self.stored[step], self.depths, step, extra)
            joined = _same_tree(groups.withColumnRenamed("up", "pos"), paths.withColumnRenamed("path", "above"), ["pos"])

            def own(at: Column) -> Column:
                levels = [
                    F.when(F.col("steps") > n, F.array(_siblings(F.col(f"level_{n}"), F.floor(at / FAN_OUT**n).cast("int"))))
                    for n in range(LEVELS_PER_STEP)]
                return F.concat(*[F.coalesce(x, F.array().cast(EMPTY_PATH)) for x in levels])

            entries = F.transform("rows", lambda row, at: F.struct(
                *[row[c].alias(c) for c in ("pos", "hash", *extra)], F.concat(own(at), F.col("above")).alias("path")))
            paths = joined.select("tree", "name", F.explode(entries).alias("e")).select("tree", "name", "e.*")
        return paths


def _same_tree(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Join on the tree, NULL being one, and columns ``on``."""
    named = right.select(*[F.col(c).alias(f"__{c}") for c in ("tree", *on)], *[c for c in right.columns if c not in ("tree", *on)])
    same = F.col("tree").eqNullSafe(F.col("__tree"))
    for c in on:
        same &= F.col(c) == F.col(f"__{c}")
    return left.join(named, same).drop("__tree", *[f"__{c}" for c in on])


def build(leaves: DataFrame, label: str) -> Forest:
    """Trees over ``leaves`` (tree, pos, hash and more), which are stored."""
    counts = leaves.groupBy("tree").agg(F.count("*").alias("n"))
    # Levels until one node is left: the least d with 8**d >= n, in whole numbers.
    depth = F.size(F.filter(F.sequence(F.lit(0), F.lit(20)), lambda d: F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), (3 * d).cast("int")) < F.col("n")))
    depths = materialize(counts.select("tree", depth.alias("depth")), f"{label}-depths")
    deepest = depths.agg(F.max("depth")).first()[0] or 0
    stored = [leaves]
    for step in range(-(-deepest // LEVELS_PER_STEP)):
        groups = _subtrees(stored[-1], depths, step)
        top = F.element_at(F.coalesce("level_3", "level_2", "level_1", "level_0"), 1)
        stored.append(materialize(groups.select("tree", F.col("up").alias("pos"), top.alias("hash")), f"{label}-{step}"))
    return Forest(stored, depths)


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def manifest(docs: DataFrame, tampered: Column, changed_text: Column, id_col: str = "doc_id", tree_col: str = "lang",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text") -> DataFrame:
    """One row per record: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where ``tampered`` is true, the fold starts from the record with ``changed_text`` for its text.
    """
    now = [F.when(F.coalesce(tampered, F.lit(False)), changed_text).otherwise(F.col(c)) if c == text_col else F.col(c) for c in fields]
    original, claimed = leaf([F.col(c) for c in fields]), leaf(now)
    rows = docs.select(F.col(id_col).alias("id"), F.col(tree_col).alias("tree"), original.alias("hash"), claimed.alias("claimed"))
    # Stored first: finding the ranges reads the digests, not the texts, a second time.
    rows = materialize(rows.withColumn("claimed", F.nullif("claimed", "hash")), "manifest-records")
    rows = materialize(positioned(rows, ["tree"], ["id", "hash"], "pos", "manifest-sorted"), "manifest-leaves")
    trees = build(rows, "manifest")
    ordered = positioned(trees.roots().withColumn("all", F.lit(0)), ["all"], ["tree"], "pos", "manifest-subroots")
    ordered = materialize(ordered.select(F.col("tree").alias("part"), "pos", "hash"), "manifest-top")
    top = build(ordered.select(F.lit(0).alias("tree"), "part", "pos", "hash"), "manifest-top")
    above = top.paths(carried=["part"]).select(F.col("part").alias("tree"), "path", F.col("hash").alias("name"))
    proved = trees.paths(above, carried=["id", "claimed"])
    root = top.roots().select("hash").scalar()
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    result = proved.select(
        F.col("id").alias(id_col), F.col("hash").alias("leaf"), F.col("name").alias("subroot"), root.alias("root"),
        digest(proof).alias("proof_sha256"), folded(F.coalesce("claimed", "hash"), F.col("path")).alias("folded_root"))
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))

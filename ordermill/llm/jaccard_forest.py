"""N-gram Jaccard join by MinHash banding, and near-duplicate groups from it.

Texts become sets of five-word shingles.  Texts with the same set form a copy
class, and from there on only classes are compared.  A class has a signature
of ``trees`` x ``depth`` minima.  This is fixed banding and takes the place of
an LSH forest: a tree is a band, whose first ``prefix()`` minima are folded into
one bucket, and classes that share a bucket are candidates.  There are no tries
and no descent by level.  The length is the same for every table and class: the
longest with which a pair at the threshold is found with the target chance in
some band, 1 - (1 - s^d)^trees >= recall; pairs above the threshold are found
with a greater chance.  The minima beyond it serve the 8-bit signatures only.

Then, for the classes that share a bucket with another:

1. Bucket by bucket, from signatures alone, pairs are set aside that an earlier
   tree has already brought together, or whose 8-bit signatures agree in so few
   places that the similarity can't be the threshold's (six standard
   deviations).  What is left says which texts a bucket needs.
2. The texts needed are read again and verified exactly, bucket by bucket:
   intersections of one text with all others of a block are counted at once.
3. A bucket gives one row per class: how many documents it is linked to, and one
   edge to the root of its linked group.  Pairs are never emitted.

A large bucket is dealt into blocks, and each pair of blocks is a task's work,
so nothing gathers in one task however large a group is; no pair is given up.

Defined results: a text of fewer than five words is one shingle of all of them.
Texts without words, null ones included, are copies of each other and linked
to nothing else.  Repeated rows are copies.  A null id is an id like others, and smallest.
An empty table gives an empty result.  Columns besides id and text are not
read by ``similarity_groups`` and pass through ``keep_one_per_group``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import codepoints as cp
from ordermill.llm.components import connected_components
from ordermill.session import materialize


@dataclass(frozen=True)
class Forest:
    words: int = 5
    threshold: float = 0.8
    trees: int = 16
    depth: int = 6
    recall: float = 0.9997
    block_rows: int = 256
    block_shingles: int = 1_000_000
    seed: int = 17

    def prefix(self) -> int:
        """The longest prefix with which the target recall is met."""
        for depth in range(self.depth, 1, -1):
            if 1 - (1 - self.threshold**depth) ** self.trees >= self.recall:
                return depth
        return 1

    def least_agreement(self) -> int:
        """Equal places of 8-bit signatures below which a pair is out."""
        n = self.trees * self.depth
        return math.floor(n * self.threshold - 6 * math.sqrt(n * self.threshold * (1 - self.threshold)))


def _distinct(values: np.ndarray) -> np.ndarray:
    """``np.unique`` without its table of hashes, which costs more than the sort on the few values of a text."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Of each text, the sorted distinct 64-bit hashes of its shingles."""
    out: list[np.ndarray] = []
    for _, part in cp.blocks(texts):
        starts, ends, counts = cp.word_spans(part)
        hashes = cp.span_hashes(part.codes, starts, ends)
        rolled = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
        for k in range(words):
            rolled = (rolled ^ hashes[k:k + len(rolled)]) * np.uint64(0x9E3779B97F4A7C15)
            rolled ^= rolled >> np.uint64(29)
        at = 0
        for n in counts.tolist():
            if n >= words:
                out.append(_distinct(rolled[at:at + n - words + 1]))
            elif n:
                out.append(np.frombuffer(xxhash.xxh3_64_digest(hashes[at:at + n].tobytes()), dtype=np.uint64))
            else:
                out.append(rolled[:0])
            at += n
    return out


def signatures(sets: list[np.ndarray], forest: Forest) -> np.ndarray:
    """One row of trees x depth 32-bit minima per set; an empty set has zeros."""
    random = np.random.default_rng(forest.seed)
    factors = random.integers(0, 2**32, forest.trees * forest.depth, dtype=np.uint32) | np.uint32(1)
    shifts = random.integers(0, 2**32, forest.trees * forest.depth, dtype=np.uint32)
    out = np.zeros((len(sets), len(factors)), dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):
        some, total = [], 0
        while at < len(full) and (not some or total + len(sets[full[at]]) < 200_000):
            some.append(full[at])
            total += len(sets[full[at]])
            at += 1
        folded = np.concatenate([sets[i] for i in some])
        folded = (folded ^ (folded >> np.uint64(32))).astype(np.uint32)
        sizes = np.array([len(sets[i]) for i in some])
        begin = np.cumsum(sizes) - sizes
        for j, (factor, shift) in enumerate(zip(factors, shifts, strict=True)):
            value = folded * factor + shift
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            out[some, j] = np.minimum.reduceat(value, begin)
    return out


def class_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


SIGNED = "key binary, n_shingles bigint, buckets array<bigint>, sketch binary"


def _signed(forest: Forest, prefix: int):
    """Of each text: class key, number of shingles, a bucket for each tree, 8-bit signature."""
    tree = (np.arange(forest.trees, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)

    @F.arrow_udf("struct<" + SIGNED.replace(" ", ":").replace(",:", ",") + ">")
    def sign(texts: pa.Array) -> pa.Array:
        sets = shingle_sets(texts.to_pylist(), forest.words)
        minima = signatures(sets, forest).reshape(len(sets), forest.trees, forest.depth)
        buckets = np.broadcast_to(tree, (len(sets), forest.trees)).copy()
        for level in range(prefix):
            buckets = cp.mixed(buckets ^ minima[:, :, level].astype(np.uint64) + np.uint64(level))
        flat = pa.array(buckets.view(np.int64).ravel())
        offsets = pa.array(np.arange(0, buckets.size + 1, forest.trees, dtype=np.int32))
        sketch = (minima & 0xFF).astype(np.uint8).reshape(len(sets), -1)
        return pa.StructArray.from_arrays(
            [pa.array([class_key(s) for s in sets], pa.binary()),
             pa.array([len(s) for s in sets], pa.int64()),
             pa.ListArray.from_arrays(offsets, flat),
             pa.array([row.tobytes() for row in sketch], pa.binary())],
            names=["key", "n_shingles", "buckets", "sketch"])

    return sign


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _candidates(left: pa.Table, right: pa.Table | None, tree: int, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of left, and of right or left) that this tree has to look at."""
    def parts(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        buckets = side["buckets"].combine_chunks().flatten().to_numpy().reshape(side.num_rows, forest.trees)
        sketch = np.frombuffer(b"".join(side["sketch"].to_pylist()), dtype=np.uint8).reshape(side.num_rows, -1)
        return buckets, sketch

    (a, a_sketch) = parts(left)
    (b, b_sketch) = parts(right) if right is not None else (a, a_sketch)
    least, rows, columns = forest.least_agreement(), [], []
    for i in range(len(a)):
        begin = 0 if right is not None else i + 1
        if begin >= len(b):
            continue
        new = np.ones(len(b) - begin, dtype=bool)
        if tree:
            new = ~(b[begin:, :tree] == a[i, :tree]).any(axis=1)
        chosen = np.flatnonzero(new) + begin
        chosen = chosen[(b_sketch[chosen] == a_sketch[i]).sum(axis=1) >= least]
        rows.append(np.full(len(chosen), i))
        columns.append(chosen)
    return (np.concatenate(rows), np.concatenate(columns)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table | None]:
    """The rows of a pair of blocks: (first, second), or (all, None) for a block with itself."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    if low == high:
        return table, None
    block = table["block"].to_numpy()
    return table.filter(pa.array(block == low)), table.filter(pa.array(block == high))


def needed(table: pa.Table, forest: Forest) -> pa.Table:
    """The classes of a pair of blocks whose texts have to be compared there."""
    left, right = _sides(table)
    keys = pa.array([], pa.binary())
    if right is None or (left.num_rows and right.num_rows):
        i, j = _candidates(left, right, table["tree"][0].as_py(), forest)
        other = left if right is None else right
        keys = pa.concat_arrays([left["key"].combine_chunks().take(pa.array(np.unique(i), pa.int64())),
                                 other["key"].combine_chunks().take(pa.array(np.unique(j), pa.int64()))]).unique()
    same = {name: pa.array([table[name][0].as_py()] * len(keys), kind)
            for name, kind in (("bucket", pa.int64()), ("tree", pa.int32()))}
    return pa.table([same["bucket"], same["tree"], keys], names=["bucket", "tree", "key"])


def verified(table: pa.Table, forest: Forest) -> pa.Table:
    """(key, linked documents, root) of the classes of a pair of blocks that are linked there."""
    sets = shingle_sets(table["text"].to_pylist(), forest.words)
    own = pa.array([class_key(s) == key for s, key in zip(sets, table["key"].to_pylist(), strict=True)])
    table = table.append_column("at", pa.array(np.arange(table.num_rows))).filter(own)
    left, right = _sides(table) if table.num_rows else (table, None)
    if not left.num_rows or (right is not None and not right.num_rows):
        return pa.table([pa.array([], pa.binary()), pa.array([], pa.int64()), pa.array([], pa.binary())],
                        names=["key", "links", "root"])
    i, j = _candidates(left, right, table["tree"][0].as_py(), forest)
    other = left if right is None else right
    place, opposite = left["at"].to_numpy(), other["at"].to_numpy()
    i, j = place[i], opposite[j]
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    present = np.zeros(int(ids.max(initial=0)) + 1, dtype=bool)
    parent = np.arange(len(sets))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    copies = np.zeros(len(sets), dtype=np.int64)
    copies[table["at"].to_numpy()] = table["copies"].to_numpy()
    links = np.zeros(len(sets), dtype=np.int64)
    for one in np.unique(i):
        partners = j[i == one]
        mine = ids[begin[one]:begin[one] + sizes[one]]
        present[mine] = True
        theirs = cp.ragged(ids, begin[partners], sizes[partners])
        common = np.add.reduceat(present[theirs].astype(np.int64), np.cumsum(sizes[partners]) - sizes[partners])
        present[mine] = False
        together = sizes[one] + sizes[partners] - common
        # In whole thousandths, so that a similarity of exactly the threshold counts.
        for partner in partners[1000 * common >= round(1000 * forest.threshold) * together]:
            links[one] += copies[partner]
            links[partner] += copies[one]
            parent[root(int(partner))] = root(int(one))
    keys = [None] * len(sets)
    for at, key in zip(table["at"].to_pylist(), table["key"].to_pylist(), strict=True):
        keys[at] = key
    linked = np.flatnonzero(links).tolist()
    return pa.table([pa.array([keys[x] for x in linked], pa.binary()), pa.array(links[linked], pa.int64()),
                     pa.array([keys[root(x)] for x in linked], pa.binary())], names=["key", "links", "root"])


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Deal the rows of each (bucket, tree) into n_blocks blocks, and repeat each row for the block pairs it is in."""
    block = F.pmod(F.xxhash64("key"), F.col("n_blocks"))
    return rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1))).withColumns({
            "low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "n_blocks")


def _by_block_pair(rows: DataFrame):
    """Grouped by pair of blocks, over all shuffle partitions: the work is in comparing, so few bytes may be many tasks' work."""
    keys = ["bucket", "low", "high"]
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).groupBy(*keys)


def _sized(members: DataFrame, forest: Forest) -> DataFrame:
    """(bucket, tree, n_blocks) of the buckets with two classes or more."""
    return members.groupBy("bucket", "tree").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).filter("n > 1").select(
            "bucket", "tree", F.greatest(
                F.ceil(F.col("n") / forest.block_rows), F.ceil(F.col("shingles") / forest.block_shingles)).alias("n_blocks"))


def sign_texts(docs: DataFrame, forest: Forest, id_col: str, text_col: str, carried: Mapping[str, Column] | None = None) -> DataFrame:
    """One stored row per document: id, text hash, class key, shingles, buckets, sketch, and what is carried along."""
    carried = carried or {}
    sign = _signed(forest, forest.prefix())
    signed = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"),
                         sign(F.col(text_col)).alias("s"), *[column.alias(name) for name, column in carried.items()])
    return materialize(signed.select("id", "text_hash", "s.*", *carried), "signed")


def class_links(signed: DataFrame, docs: DataFrame, forest: Forest, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(classes: key, copies, and id and text hash of one of them; linked: key, links, component of those with links)."""
    one = F.min(F.struct("id", "text_hash", "n_shingles", "buckets", "sketch"))
    classes = signed.groupBy("key").agg(F.count("*").alias("copies"), one.alias("one")).select("key", "copies", "one.*")
    classes = materialize(classes, "classes")
    members = classes.filter("n_shingles > 0").select("key", "n_shingles", F.posexplode("buckets").alias("tree", "bucket"))
    shared = materialize(members.join(_sized(members, forest), ["bucket", "tree"]).select(
        "bucket", "tree", "key", "n_blocks"), "shared")
    looked = _block_pairs(shared.join(classes.select("key", "buckets", "sketch"), "key"))
    wanted = _by_block_pair(looked).applyInArrow(
        lambda table: needed(table, forest), "bucket bigint, tree int, key binary").distinct()
    wanted = materialize(wanted.join(classes.select("key", "n_shingles"), "key"), "wanted")
    again = _sized(wanted, forest)
    places = wanted.join(again, ["bucket", "tree"]).groupBy("key").agg(
        F.collect_list(F.struct("bucket", "tree", "n_blocks")).alias("places"))  # one per tree at most
    asked = materialize(places.join(classes, "key"), "asked")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", text_hash(F.col("text")))
    found = texts.join(asked, texts["id"].eqNullSafe(asked["id"]) & (texts["text_hash"] == asked["text_hash"])).select(
        "key", "copies", "buckets", "sketch", "places", "text")
    placed = _block_pairs(found.withColumn("place", F.explode("places")).select(
        "key", "copies", "buckets", "sketch", "text", "place.*"))
    # A repeated row would count twice, and blocks have each class once.
    rows = _by_block_pair(placed).applyInArrow(
        lambda table: verified(_first_of_each(table), forest), "key binary, links bigint, root binary")
    rows = materialize(rows, "links")
    component = connected_components(rows.select(F.col("key").alias("a"), F.col("root").alias("b")).distinct(), "linked")
    links = rows.groupBy("key").agg(F.sum("links").alias("links"))
    return classes, links.join(component.withColumnRenamed("node", "key"), "key", "left")


def _first_of_each(table: pa.Table) -> pa.Table:
    _, first = np.unique(np.array(table["key"].to_pylist(), dtype=object), return_index=True)
    return table if len(first) == table.num_rows else table.take(pa.array(np.sort(first)))


def similarity_groups(docs: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id",
                      text_col: str = "text", carried: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per document: id, text_hash, group_key, copy_id, class_id and n_links, and the ``carried`` columns by name.

    ``group_key`` names the linked group also where ids are null.  ``copy_id``: the smallest id with the same shingles.  ``class_id``: the smallest id of the linked group.
    ``n_links``: how many other documents are similar at the threshold, copies included.
    ``carried``: columns of ``docs`` that the caller needs beside them, under names that are not used here.
    """
    signed = sign_texts(docs, forest, id_col, text_col, carried)
    classes, linked = class_links(signed, docs, forest, id_col, text_col)
    placed = classes.select("key", "copies", "id").join(linked, "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    placed = materialize(placed, "placed")
    named = placed.groupBy("component").agg(F.min("id").alias("class_id"))
    resolved = materialize(placed.join(named, "component").select(
        "key", F.col("component").alias("group_key"), F.col("id").alias("copy_id"), "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "resolved")
    return signed.select("id", "text_hash", "key", *(carried or {})).join(resolved, "key").select(
        F.col("id").alias(id_col), "text_hash", "group_key", "copy_id", "class_id", "n_links", *(carried or {}))


def keep_one_per_group(docs: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each linked group: that with the smallest (id, text hash)."""
    groups = similarity_groups(docs, forest, id_col, text_col)
    counted = groups.groupBy("group_key", F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).count()
    chosen = counted.groupBy("group_key").agg(
        F.min(F.struct("_id", "_hash", F.col("count").alias("_rows"))).alias("c")).select("c.*")
    chosen = materialize(chosen, "kept-documents")
    # Named apart from every column of the input, whatever those are called.
    own = "_own_hash"
    while own.lower() in {name.lower() for name in docs.columns}:
        own += "_"
    marked = docs.withColumn(own, text_hash(F.col(text_col)))

    def rows_of(some: DataFrame) -> DataFrame:
        same = marked[id_col].eqNullSafe(some["_id"]) & (marked[own] == some["_hash"])
        return marked.join(some, same).select(*[marked[c] for c in marked.columns])

    single, repeated = rows_of(chosen.filter("_rows = 1")), rows_of(chosen.filter("_rows > 1"))
    return single.unionByName(repeated.dropDuplicates([id_col, own])).drop(own)

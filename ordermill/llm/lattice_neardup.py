"""Near-duplicate vectors by lattice hashing: random projections, E8 cells, neighbouring cells, exact cosine.

A table projects a unit vector at random to a few blocks of eight dimensions and decodes each block to its nearest
point of the lattice E8; the points together name a cell.  A vector lies in its own cell and also probes the cells
around it that are nearest to its projection (one of the 240 shortest steps in a block, or steps in several blocks).
Two vectors meet in a table if they share a cell or one probes the other's.  Number of blocks, cell width and number
of tables follow from the number of vectors and from the wanted chance that a pair exactly at the threshold meets in
some table, by a seeded simulation; closer pairs meet sooner.

Equal vectors are one class from the start.  Classes that meet are compared by cosine in double precision, in blocks
of bounded size; a pair is counted only where it meets first, so nothing has to be remembered about pairs and no pair
leaves a task: out come each class's links and one edge per class to the smallest class it hangs together with.
Projections are rounded to binary fractions short enough that all sums are exact, so a cell is the same wherever it
is worked out.

Work: a group of n different vectors that all link costs n * n / 2 comparisons, since the links of each are asked,
dealt over blocks; copies cost nothing.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so
do rows with a null id; each is a row of the result with 0 links, its own component, kept.  Vectors of different
lengths don't link.  Repeated rows are vectors of their own.  An empty table gives an empty result.  Other columns
are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.components import connected_components
from ordermill.session import materialize

BLOCK = 8
#: Rows of one cell that are compared with each other, or with as many others, in one go.
BLOCK_ROWS = 1024
#: Binary digits after the point of unit vectors, projections and projected coordinates: all sums stay below 2**53.
VECTOR_BITS, MATRIX_BITS, COORDINATE_BITS = 22, 12, 18


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8 below the zero vector: two entries of 1 or -1, or all of one half with evenly many minus signs."""
    steps = [np.zeros(BLOCK)]
    for i, j in itertools.combinations(range(BLOCK), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(BLOCK)
            step[i], step[j] = a, b
            steps.append(step)
    halves = itertools.product((0.5, -0.5), repeat=BLOCK)
    return np.array([*steps, *[np.array(h) for h in halves if sum(x < 0 for x in h) % 2 == 0]])


STEPS = _shortest()


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: of the two cosets of D8 (whole numbers, and halves) the nearer one."""
    found = []
    for shift in (0.0, 0.5):
        moved = points - shift
        whole = np.rint(moved)
        off = moved - whole
        odd = np.flatnonzero(whole.sum(-1) % 2)
        worst = np.abs(off[odd]).argmax(-1)
        whole[odd, worst] += np.where(off[odd, worst] < 0, -1.0, 1.0)
        found.append(whole + shift)
    near, far = (((points - f) ** 2).sum(-1) for f in found)
    return np.where((near <= far)[:, None], found[0], found[1])


def probes(residual: np.ndarray, number: int) -> np.ndarray:
    """Steps per block (indices of STEPS) to the ``number`` cells around, nearest first in no particular order; the first is no step."""
    rows, blocks, _ = residual.shape
    cost, moves = np.zeros((rows, 1)), np.zeros((rows, 1, 0), np.int64)
    each = min(number, len(STEPS) - 1)
    for b in range(blocks):
        added = 2 - 2 * (residual[:, b] @ STEPS[1:].T)
        top = np.sort(np.argsort(added, 1, kind="stable")[:, :each], 1)
        choice = np.concatenate([np.zeros((rows, 1), np.int64), top + 1], 1)
        price = np.concatenate([np.zeros((rows, 1)), np.take_along_axis(added, top, 1)], 1)
        total = (cost[:, :, None] + price[:, None, :]).reshape(rows, -1)
        combined = np.concatenate([
            np.repeat(moves, each + 1, axis=1), np.tile(choice, (1, cost.shape[1]))[:, :, None]], 2)
        # The first combination takes no step at all and stays the first.
        keep = np.argsort(total[:, 1:], 1, kind="stable")[:, :number] + 1
        keep = np.concatenate([np.zeros((rows, 1), np.int64), keep], 1)
        cost, moves = np.take_along_axis(total, keep, 1), np.take_along_axis(combined, keep[:, :, None], 1)
    return moves


@dataclass(frozen=True)
class Lattice:
    """Shape of the hash: so many tables of so many blocks, cells of this width, so many cells probed besides the own."""

    tables: int
    blocks: int
    width: float
    probed: int = 8
    seed: int = 8

    @staticmethod
    def fit(rows: int, threshold: float, recall: float, probed: int = 8, most_blocks: int = 4) -> Lattice:
        """The cheapest shape for which a pair at the threshold meets with the chance ``recall``.

        In a table, unlike vectors share a cell with the chance (width**2 / 4 pi)**(4 * blocks); the width keeps it
        at one stranger for 16 cells.
        """
        stranger = 1 / (16 * max(rows, 4096))
        apart = math.sqrt(2 - 2 * threshold)
        shapes = []
        for blocks in range(1, most_blocks + 1):
            width = math.sqrt(4 * math.pi * stranger ** (1 / (4 * blocks)))
            met = _chance(blocks, width, apart, probed)
            if met > 0.01:
                tables = 1 if met >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))
                shapes.append(Lattice(tables, blocks, width, probed))
        return min(shapes, key=lambda s: s.tables)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Cells as 64-bit numbers, (rows, tables, 1 + probed); the own cell comes first."""
        matrix, shift, factors, names = _tables(self, unit.shape[1])
        exact = np.rint(unit * 2.0**VECTOR_BITS)
        found = np.empty((len(unit), self.tables, 1 + self.probed), np.int64)
        for t in range(self.tables):
            spot = np.rint(((exact @ matrix[t]) * 2.0 ** -(VECTOR_BITS + MATRIX_BITS) + shift[t]) * 2.0**COORDINATE_BITS)
            spot = (spot * 2.0**-COORDINATE_BITS).reshape(-1, BLOCK)
            cell = nearest_e8(spot)
            residual = (spot - cell).reshape(len(unit), self.blocks, BLOCK)
            factor = factors[t].reshape(self.blocks, BLOCK)
            twice = (2 * cell).astype(np.int64).view(np.uint64).reshape(len(unit), self.blocks, BLOCK)
            own = (twice * factor).sum((1, 2), dtype=np.uint64) + names[t]
            step = (2 * STEPS).astype(np.int64).view(np.uint64) @ factor.T
            moves = probes(residual, self.probed)
            around = sum(step[moves[:, :, b], b] for b in range(self.blocks))
            found[:, t] = (own[:, None] + around).view(np.int64)
        return found


@lru_cache(maxsize=4)
def _tables(shape: Lattice, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per table: the projection scaled to the cell width, its shift, the factors of the cell's number, and a number of its own."""
    random = np.random.default_rng([shape.seed, dims])
    size = shape.blocks * BLOCK
    matrix = np.rint(random.normal(size=(shape.tables, dims, size)) / shape.width * 2.0**MATRIX_BITS)
    shift = random.uniform(0, 2, size=(shape.tables, size))
    factors = random.integers(1, 2**63, size=(shape.tables, size), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return matrix, shift, factors, random.integers(0, 2**63, size=shape.tables, dtype=np.uint64)


def _chance(blocks: int, width: float, apart: float, probed: int, trials: int = 2000) -> float:
    """Share of simulated pairs at the distance ``apart`` that meet in one table."""
    random = np.random.default_rng(blocks)
    one = random.normal(size=(trials * blocks, BLOCK)) / width
    other = one + apart * random.normal(size=one.shape) / width
    cells, seen = [], []
    for points in (one, other):
        cell = nearest_e8(points).reshape(trials, blocks, BLOCK)
        moves = probes(points.reshape(cell.shape) - cell, probed)
        cells.append(cell[:, None])
        seen.append(cell[:, None] + STEPS[moves])
    meets = [(seen[i] == cells[1 - i]).all((2, 3)).any(1) for i in (0, 1)]
    return float((meets[0] | meets[1]).mean())


def _unit(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _with_keys(shape: Lattice):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            lengths = np.array(batch["dims"])
            for dims in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dims))
                for start in range(0, part.num_rows, 1024):
                    piece = part.slice(start, 1024)
                    keys = shape.keys(_unit(piece["vector"], int(dims)))
                    flat = pa.array(keys.reshape(-1))
                    ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys[0].size)
                    yield pa.RecordBatch.from_arrays(
                        [piece["node"], pa.ListArray.from_arrays(ends, flat, type=kind)], ["node", "keys"])
    return run


def first_meeting(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For pairs that meet, given by their keys: the cell in which they meet first (of two in one table the smaller)."""
    a, b = one[:, :, 0], other[:, :, 0]
    highest = np.iinfo(np.int64).max
    in_a = np.where((other == a[:, :, None]).any(2), a, highest)
    in_b = np.where((one == b[:, :, None]).any(2), b, highest)
    first = np.minimum(in_a, in_b)
    return first[np.arange(len(first)), (first != highest).argmax(1)]


def _pairs(own: np.ndarray, block: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows on the left and on the right of a pair of blocks."""
    return (np.flatnonzero(block == i), np.flatnonzero(block == j)) if i != j else (np.arange(len(own)),) * 2


def links_of_segment(shape: Lattice, threshold: float, key: int, i: int, j: int, node: np.ndarray, own: np.ndarray,
                     block: np.ndarray, weight: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, root, links) of the rows of one pair of blocks of one cell that link there for the first time."""
    left, right = _pairs(own, block, i, j)
    cosine = unit[left] @ unit[right].T
    near = cosine >= threshold - 1e-9
    near &= own[left][:, None] | own[right][None, :]
    a, b = np.nonzero(near)
    a, b = left[a], right[b]
    a, b = (x[(a < b) if i == j else (a != b)] for x in (a, b))
    # The same sum in the same order for every pair, wherever it is worked out.
    sure = (unit[a] * unit[b]).sum(1) >= threshold
    a, b = a[sure], b[sure]
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(used) == 0:
        return used, used, used
    keys = shape.keys(unit[used])
    x, y = place[: len(a)], place[len(a):]
    first = np.concatenate([
        first_meeting(keys[x[s: s + 8192]], keys[y[s: s + 8192]]) == key for s in range(0, len(x), 8192)])
    x, y = x[first], y[first]
    links = np.zeros(len(used), np.int64)
    np.add.at(links, x, weight[used[y]])
    np.add.at(links, y, weight[used[x]])
    root = node[used].copy()
    while True:
        before = root.copy()
        np.minimum.at(root, x, before[y])
        np.minimum.at(root, y, before[x])
        if (root == before).all():
            break
    linked = links > 0
    return node[used][linked], root[linked], links[linked]


def _verify(shape: Lattice, threshold: float):
    """Rows come sorted by cell and pair of blocks; such a segment is bounded, and one may go on in the next batch."""
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def segments(table: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
        where = np.stack([table[c].to_numpy() for c in ("dims", "key", "i", "j")], 1)
        cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1).tolist(), table.num_rows]
        parts = [table.slice(x, y - x) for x, y in zip(cuts, cuts[1:], strict=False)]
        return (parts, table.slice(0, 0)) if last else (parts[:-1], parts[-1])

    def judged(part: pa.Table) -> list[np.ndarray] | None:
        if part.num_rows < 2:
            return None
        head = {c: part[c][0].as_py() for c in ("dims", "key", "i", "j")}
        own, block = part["own"].to_numpy().astype(bool), part["block"].to_numpy()
        if not own.any():
            return None
        found = links_of_segment(
            shape, threshold, head["key"], head["i"], head["j"], part["node"].to_numpy(), own, block,
            part["weight"].to_numpy(), _unit(part["vector"], head["dims"]))
        return list(found) if len(found[0]) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows == 0:
                continue
            fresh = [pa.Table.from_batches([batch])] if batch is not None else []
            tables = ([waiting] if waiting is not None and waiting.num_rows else []) + fresh
            if not tables:
                continue
            parts, waiting = segments(pa.concat_tables(tables).combine_chunks(), batch is None)
            found = [f for f in map(judged, parts) if f]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)], schema=schema)
    return run


def _takes_part(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    recall: float = 0.995) -> DataFrame:
    """One row per vector: id, n_links, component_id (the smallest id reachable by links), kept (it is that one)."""
    part = F.coalesce(_takes_part(F.col(vector_col)) & F.col(id_col).isNotNull(), F.lit(False))
    vectors = rows.select(F.col(id_col).cast("bigint").alias("id"), F.when(part, F.col(vector_col)).alias("vector"))
    copies = [F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(seed), "vector")).alias(f"copy_{seed}") for seed in (1, 2)]
    rows_of = vectors.select("id", *copies)
    classes = vectors.filter("vector IS NOT NULL").select("*", *copies).groupBy("copy_1", "copy_2").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
    classes = materialize(classes.select(
        "*", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("node")), "lattice-classes")
    shape = Lattice.fit(classes.count(), threshold, recall)

    keys = materialize(classes.select("node", "vector", "dims").mapInArrow(
        _with_keys(shape), "node bigint, keys array<bigint>"), "lattice-keys")
    entries = keys.select("node", F.posexplode("keys").alias("at", "key")).select(
        "node", "key", (F.col("at") % (1 + shape.probed) == 0).alias("own"))
    # Only cells where someone lives and someone else lives or looks in.
    cells = entries.groupBy("key").agg(F.count("*").alias("n"), F.count_if("own").alias("owns")).filter("owns > 0 AND n > 1")
    cells = cells.select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    seats = entries.join(cells, "key").join(classes.select("node", "weight", "dims", "vector"), "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
    dealt = seats.select("*", partner).select(
        "dims", "key", F.least("block", "partner").alias("i"), F.greatest("block", "partner").alias("j"),
        "node", "own", "block", "weight", "vector")
    place = ["dims", "key", "i", "j"]
    found = materialize(dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(
        _verify(shape, threshold), "node bigint, root bigint, links bigint"), "lattice-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "lattice")
    joined = classes.select("node", "id", "weight", "copy_1", "copy_2").join(links, "node", "left").join(
        named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = materialize(joined, "lattice-joined")
    smallest = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    results = joined.join(smallest, "component").select(
        "copy_1", "copy_2", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    component = F.coalesce("component_id", "id")
    return rows_of.join(results, ["copy_1", "copy_2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))

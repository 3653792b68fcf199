"""Best-fit packing of documents into bins of fixed size, no two of one source or one duplicate cluster together.

Lengths are code points of the whole text.  A text longer than a bin is cut
into full pieces, each a bin of its own, and a rest.  The pieces are dealt at
random into groups of bounded size; in a group they are packed the longest
first.  Open bins are kept in the order of what is left in them, each with a
bitmap of the sources and one of the clusters in it.  The search starts at the
tightest bin that the piece fits in, and goes on to the next until a bin has
neither the piece's source nor its cluster; that is the tightest compatible
bin.  Without one a new bin is opened.

A cluster is a linked group of the n-gram Jaccard join: exact copies and near
copies, also those that only a chain of near copies links.  That join reads
texts; after it, only ids, lengths, sources and clusters are shuffled.  A hot
source falls evenly into all groups, and so do repeated rows and a large
cluster, since rows are dealt by their place.

Defined results: null and empty texts have one piece of length 0, which is
packed like others.  A null source or cluster conflicts with nothing.  Repeated
rows are packed one by one; a cluster column that is given takes the place of
the join.  Texts without words form a cluster.  An empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import jaccard_forest
from ordermill.session import materialize

PACKED = "id {id}, piece int, start bigint, n_chars bigint, bin_id bigint, place int, bin_start bigint, bin_chars bigint"


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[list[int]]:
    """Bins as lists of places in ``pieces``, which are (length, source, cluster), the longest first."""
    bins: list[list[int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    source_bits: dict[object, int] = {}
    cluster_bits: dict[object, int] = {}
    open_bins: list[tuple[int, int]] = []  # (left, bin), in order
    for at, (length, source, cluster) in enumerate(pieces):
        of_source = 0 if source is None else source_bits.setdefault(source, 1 << len(source_bits))
        of_cluster = 0 if cluster is None else cluster_bits.setdefault(cluster, 1 << len(cluster_bits))
        chosen = bisect_left(open_bins, (length, -1))
        while chosen < len(open_bins):
            number = open_bins[chosen][1]
            if not (sources[number] & of_source or clusters[number] & of_cluster):
                break
            chosen += 1
        if chosen < len(open_bins):
            left, number = open_bins.pop(chosen)
            bins[number].append(at)
            sources[number] |= of_source
            clusters[number] |= of_cluster
        else:
            left, number = capacity, len(bins)
            bins.append([at])
            sources.append(of_source)
            clusters.append(of_cluster)
        if left > length or not length:
            insort(open_bins, (left - length, number))
    return bins


def _pack_group(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("n_chars", "descending"), ("id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
    lengths = table["n_chars"].to_pylist()
    bins = best_fit(list(zip(lengths, table["source"].to_pylist(), table["cluster"].to_pylist(), strict=True)), capacity)
    first = table["group"][0].as_py() << 32
    order = [at for members in bins for at in members]
    bin_id, place, bin_start, filled = [], [], [], []
    for number, members in enumerate(bins):
        before = 0
        for position, at in enumerate(members):
            bin_id.append(first + number)
            place.append(position)
            bin_start.append(before)
            before += lengths[at]
        filled += [before] * len(members)
    taken = table.select(["id", "piece", "start", "n_chars"]).take(pa.array(order, pa.int64()))
    for name, values, kind in (("bin_id", bin_id, pa.int64()), ("place", place, pa.int32()),
                               ("bin_start", bin_start, pa.int64()), ("bin_chars", filled, pa.int64())):
        taken = taken.append_column(name, pa.array(values, kind))
    return taken


def pack(docs: DataFrame, capacity: int = 8192, group_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start and n_chars in the text; bin_id, place, bin_start and bin_chars (filled)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The place is that of the first read, so that a run deals the rows as the run before did.
    read = {"n": F.length(text).cast("bigint"), "source": F.col(source_col), "row": F.monotonically_increasing_id()}
    if cluster_col is None:
        groups = jaccard_forest.similarity_groups(docs, id_col=id_col, text_col=text_col, carried=read)
        rows = groups.select(F.col(id_col).alias("id"), "n", "source", F.col("group_key").alias("cluster"), "row")
    else:
        rows = docs.select(F.col(id_col).alias("id"), *[column.alias(name) for name, column in read.items()],
                           F.col(cluster_col).alias("cluster"))
    rows = materialize(rows, "lengths")
    size = F.lit(capacity).cast("bigint")
    last = F.greatest(F.ceil(F.col("n") / size) - 1, F.lit(0))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).select(
        "id", "source", "cluster", "row", F.col("piece").cast("int").alias("piece"), (F.col("piece") * size).alias("start"),
        F.least(size, F.col("n") - F.col("piece") * size).alias("n_chars"))
    total = rows.agg(F.sum(last + 1)).first()[0] or 0
    n_groups = max(1, math.ceil(total / group_rows))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(n_groups)))
    return dealt.groupBy("group").applyInArrow(
        lambda table: _pack_group(table, capacity), PACKED.format(id=dict(rows.dtypes)["id"])).withColumnRenamed("id", id_col)

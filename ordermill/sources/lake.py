"""Tables of the raw, clean and serving layers as folders of snapshots.

A table is ``<root>/<layer>/<table>/`` with one sub-folder per published
snapshot and a small pointer file that names the current one.  A snapshot is
complete before the pointer moves, so a failed write leaves the table as it
was, readers never see half of it, and an earlier state can be published again
by moving the pointer back.

A snapshot of a table that is laid out by one column (months) may hold only
the values that changed, and name the earlier snapshots the others are read
from.  It also carries marks: how far named loads had come when it was
published, so that a load repeated after a failure can tell.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators.dedupe import keep_one
from ordermill.operators.merge import replace_by_key
from ordermill.schemas import SERVING_TABLES
from ordermill.session import allow_unsorted_writes, brief_shuffles, hadoop_path, materialize, scratch_scope

RAW, CLEAN, SERVING = "raw", "clean", "serving"
POINTER, SCHEMA_FILE, CONTENT_FILE = "_CURRENT", "_schema.json", "_content.json"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Values of a layout column that each task may write a file of; for more, rows are brought together by value.
FEW_VALUES = 4
#: Values of a layout column that a task writes side by side, without sorting its rows by value.
SIDE_BY_SIDE = 16
#: Formats whose files are compressed by Zstandard: snapshots stay, beside those they replace.
ZSTANDARD = ("parquet", "orc")


@dataclass(frozen=True)
class TableSpec:
    """How one source table enters the raw layer: ``merge`` upserts on ``keys``, ``overwrite`` replaces."""

    name: str
    keys: tuple[str, ...]
    strategy: str = "merge"
    source: str | None = None


@dataclass(frozen=True)
class Content:
    """What a snapshot holds: the column it is laid out by, its own values (as text, None for NULL), the values read
    from earlier snapshots by their numbers, and marks."""

    column: str | None = None
    own: list[str | None] = field(default_factory=list)
    reused: dict[int, list[str | None]] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)


def _among(column: str, kind: str, values: Collection[str | None]) -> Column:
    known = [F.lit(v).cast(kind) for v in values if v is not None]
    found = F.col(column).isin(*known) if known else F.lit(False)
    return F.coalesce(found, F.lit(None in values))


class Lake:
    """Tables under ``root``; with ``keep`` only so many snapshots of a table stay, the current one included."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", keep: int | None = None) -> None:
        self.spark, self.root, self.fmt, self.keep = spark, root.rstrip("/"), fmt, keep
        allow_unsorted_writes(spark, SIDE_BY_SIDE)

    def _table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def versions(self, layer: str, table: str) -> list[int]:
        """Numbers of the complete snapshots, oldest first."""
        fs, path = hadoop_path(self.spark, self._table_path(layer, table))
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            done = hadoop_path(self.spark, f"{self._table_path(layer, table)}/{name}/_SUCCESS")[1]
            if name.startswith("snapshot-") and fs.exists(done):
                found.append(int(name.split("-")[1]))
        return sorted(found)

    def current(self, layer: str, table: str) -> int | None:
        """Number of the published snapshot, None if the table does not exist.

        Only a table without pointer and snapshots is "absent".  A pointer that
        is empty or no number, or is missing beside complete snapshots, is an
        error: a damaged table is never mistaken for a new one.
        """
        path = f"{self._table_path(layer, table)}/{POINTER}"
        fs, target = hadoop_path(self.spark, path)
        if not fs.exists(target):
            # An early write that failed before it was ever published leaves no complete snapshot with a schema.
            if any(self._has_schema(layer, table, version) for version in self.versions(layer, table)):
                raise RuntimeError(f"{layer}/{table} has snapshots but no {POINTER}: restore it with publish()")
            return None
        line = (self._read_line(path) or "").strip()
        if not line.isdigit():
            raise RuntimeError(f"{path} does not name a snapshot: {line!r}; restore it with publish()")
        return int(line)

    def _has_schema(self, layer: str, table: str, version: int) -> bool:
        fs, path = hadoop_path(self.spark, f"{self.snapshot_path(layer, table, version)}/{SCHEMA_FILE}")
        return fs.exists(path)

    def exists(self, layer: str, table: str) -> bool:
        return self.current(layer, table) is not None

    def snapshot_path(self, layer: str, table: str, version: int) -> str:
        return f"{self._table_path(layer, table)}/snapshot-{version:06d}"

    def _read_line(self, path: str) -> str | None:
        """First line of a small file, None if there is no such file."""
        fs, target = hadoop_path(self.spark, path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return stream.readLine()
        finally:
            stream.close()

    def _write_line(self, path: str, line: str) -> None:
        """Write a small file beside its place and move it there, so that readers see the old line or the new one."""
        fs, target = hadoop_path(self.spark, path)
        beside = hadoop_path(self.spark, f"{path}.{uuid.uuid4().hex}")[1]
        stream = fs.create(beside, True)
        try:
            stream.writeBytes(line + "\n")
        finally:
            stream.close()
        context, jvm = self.spark.sparkContext, self.spark.sparkContext._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = context._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.makeQualified(target).toUri(), context._jsc.hadoopConfiguration())
        files.rename(fs.makeQualified(beside), fs.makeQualified(target), options)

    def publish(self, layer: str, table: str, version: int) -> None:
        """Make a complete snapshot the current one, whatever the pointer says now."""
        if version not in self.versions(layer, table):
            raise ValueError(f"{layer}/{table} has no complete snapshot {version}")
        self._write_line(f"{self._table_path(layer, table)}/{POINTER}", str(version))

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        number = self.current(layer, table) if version is None else version
        if number is None:
            raise FileNotFoundError(f"no table {layer}/{table} under {self.root}")
        schema = StructType.fromJson(json.loads(
            self._read_line(f"{self.snapshot_path(layer, table, number)}/{SCHEMA_FILE}")))

        def stored(snapshot: int) -> DataFrame:
            return self.spark.read.format(self.fmt).schema(schema).load(self.snapshot_path(layer, table, snapshot))

        content = self.content(layer, table, number)
        # At most one scan per value of the column; columns added later are NULL in earlier snapshots.
        return reduce(DataFrame.unionByName, [stored(number), *[
            stored(snapshot).filter(_among(content.column, schema[content.column].dataType.simpleString(), values))
            for snapshot, values in sorted(content.reused.items())]])

    def content(self, layer: str, table: str, version: int | None = None) -> Content:
        number = self.current(layer, table) if version is None else version
        line = None if number is None else self._read_line(f"{self.snapshot_path(layer, table, number)}/{CONTENT_FILE}")
        if line is None:
            return Content()
        told = json.loads(line)
        return Content(**{**told, "reused": {int(k): v for k, v in told["reused"].items()}})

    def marks(self, layer: str, table: str) -> dict[str, str]:
        """Marks of the current snapshot, none if there is no table."""
        return self.content(layer, table).marks

    def _own_values(self, path: str, column: str) -> list[str | None]:
        """Values of the column a snapshot is laid out by, from the names of its folders."""
        fs, target = hadoop_path(self.spark, path)
        names = [status.getPath().getName() for status in fs.listStatus(target)]
        texts = [unquote(name.split("=", 1)[1]) for name in names if name.startswith(f"{column}=")]
        return [None if text == NULL_FOLDER else text for text in texts]

    def overwrite(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (), rebalance: bool = False,
        marks: Mapping[str, str] | None = None, reused: Mapping[int, list[str | None]] | None = None,
        lookup: str | None = None,
    ) -> int:
        """Publish ``df`` as the whole table, with whatever columns it has.

        ``rebalance`` brings the rows of a partition value together before the
        write and splits values that are too large for one task; worth its
        shuffle where there are many partition values.  ``marks`` are added to
        those of the snapshot before; ``reused`` names values of the one column
        in ``partition_by`` that stay where they are, by snapshot.  With
        ``lookup`` files carry a Bloom filter of that column; rows should come
        sorted by it in ranges, so that a value stands in few pages.
        """
        kept_marks = {**self.marks(layer, table), **(marks or {})}
        number = max([*self.versions(layer, table), self.current(layer, table) or 0], default=0) + 1
        if rebalance:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.format(self.fmt).mode("overwrite")
        if self.fmt in ZSTANDARD:
            writer = writer.option("compression", "zstd")
        if lookup is not None:
            writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        path = self.snapshot_path(layer, table, number)
        with brief_shuffles(self.spark):
            writer.save(path)
        column = partition_by[0] if len(partition_by) == 1 else None
        content = Content(column, self._own_values(path, column) if column else [], dict(reused or {}), kept_marks)
        self._write_line(f"{path}/{CONTENT_FILE}", json.dumps(asdict(content)))
        self._write_line(f"{path}/{SCHEMA_FILE}", df.schema.json())
        self.publish(layer, table, number)
        if self.keep is not None:
            self.drop_old(layer, table, self.keep)
        return number

    def drop_old(self, layer: str, table: str, keep: int) -> None:
        """Delete all but the ``keep`` newest snapshots, the current one, and those they read values from."""
        complete, current = self.versions(layer, table), self.current(layer, table)
        stay = {*complete[-max(keep, 1):], current}
        stay |= {source for version in stay for source in self.content(layer, table, version).reused}
        for version in complete:
            if version not in stay:
                fs, path = hadoop_path(self.spark, self.snapshot_path(layer, table, version))
                fs.delete(path, True)

    def upsert(
        self, df: DataFrame, layer: str, table: str, keys: Sequence[str], partition_by: Sequence[str] = (),
        marks: Mapping[str, str] | None = None, rebalance: bool = True,
    ) -> int:
        """Merge ``df`` into the table by ``keys``; the first call creates the table.

        The rows of ``df`` are stored before the merge, which reads them twice:
        the source is asked once, and a small extract is broadcast to the table
        instead of shuffling it.  In a table laid out by one column only those
        values are read and written that the extract has, or that rows it
        replaces stand in; to find the latter, the keys of the table are read.
        Without ``rebalance`` rows are written by the tasks that merged them, a
        file for each value they have: for an extract of one load date or few.
        """
        fresh = keep_one(df, keys)
        if not self.exists(layer, table):
            return self.overwrite(fresh, layer, table, partition_by, rebalance and len(partition_by) == 1, marks)
        with scratch_scope():
            return self._merge(materialize(fresh, f"{table}-extract"), layer, table, keys, partition_by, marks, rebalance)

    def _merge(
        self, fresh: DataFrame, layer: str, table: str, keys: Sequence[str], partition_by: Sequence[str],
        marks: Mapping[str, str] | None, rebalance: bool,
    ) -> int:
        """``upsert`` of a stored extract of unique keys into a table that exists."""
        if not marks and fresh.isEmpty():
            return self.current(layer, table)
        target, column = self.read(layer, table), self.content(layer, table).column
        if column is None or list(partition_by) != [column]:
            return self.overwrite(replace_by_key(target, fresh, keys), layer, table, partition_by, marks=marks)
        text = F.col(column).cast("string").alias("value")
        with brief_shuffles(self.spark):
            stood = target.select(*dict.fromkeys([*keys, column])).join(fresh.select(*keys), list(keys), "left_semi")
            touched = [row[0] for row in fresh.select(text).union(stood.select(text)).distinct().collect()]  # a line per value
        rows = replace_by_key(target.filter(_among(column, dict(target.dtypes)[column], touched)), fresh, keys)
        return self._replace(rows, layer, table, column, touched, marks, rebalance or len(touched) > FEW_VALUES)

    def _replace(
        self, rows: DataFrame, layer: str, table: str, column: str, replaced: Collection[str | None],
        marks: Mapping[str, str] | None = None, rebalance: bool = True,
    ) -> int:
        """Publish ``rows`` in place of the values ``replaced``; the others are read from where they are."""
        before = self.content(layer, table)
        held = {**before.reused, self.current(layer, table): before.own}
        reused = {snapshot: [v for v in values if v not in replaced] for snapshot, values in held.items()}
        return self.overwrite(
            rows, layer, table, [column], rebalance=rebalance, marks=marks,
            reused={snapshot: values for snapshot, values in reused.items() if values})

    def replace_partitions(
        self, df: DataFrame, layer: str, table: str, partition_by: str, replaced: Sequence[str] | None = None,
    ) -> int:
        """Publish a snapshot in which the partitions ``replaced`` hold the rows of ``df`` instead (backfills).

        Without ``replaced`` these are the partitions that ``df`` has rows of.
        One that is replaced by no rows goes; columns that one side lacks are NULL there.  The others stay where
        they are, unread, if the table is laid out by that column; else their rows are copied.
        The snapshot before stays for a rollback.
        """
        if replaced is None:
            text = F.col(partition_by).cast("string")
            replaced = [row[0] for row in df.select(text).distinct().collect() if row[0] is not None]  # one line per partition
        replaced = [str(v) for v in replaced]
        old, before = self.read(layer, table), self.content(layer, table).column
        fresh = df.filter(_among(partition_by, dict(df.dtypes)[partition_by], replaced))
        if before == partition_by:
            whole = old.limit(0).unionByName(fresh, allowMissingColumns=True)
            return self._replace(whole, layer, table, partition_by, replaced)
        kept = old.filter(~_among(partition_by, dict(old.dtypes)[partition_by], replaced))
        return self.overwrite(
            kept.unionByName(fresh, allowMissingColumns=True), layer, table, [partition_by], rebalance=True)

    def rollback(self, layer: str, table: str, version: int | None = None) -> int:
        """Publish an earlier snapshot again, the last one before the current by default."""
        number = self.current(layer, table)
        complete = self.versions(layer, table)
        earlier = [v for v in complete if number is not None and v < number]
        wanted = version if version is not None else (earlier[-1] if earlier else None)
        if wanted not in complete:
            raise ValueError(f"{layer}/{table} has no snapshot to go back to")
        self.publish(layer, table, wanted)
        return wanted

    def load(self, name: str) -> DataFrame:
        """A serving table by its name; unknown names are an error."""
        if name not in SERVING_TABLES:
            raise ValueError(f"unknown table {name!r}; known: {', '.join(SERVING_TABLES)}")
        return self.read(SERVING, name)

    def register_views(self, names: Sequence[str] = SERVING_TABLES) -> None:
        """Make serving tables readable by name in ``spark.sql``."""
        for name in names:
            self.load(name).createOrReplaceTempView(name)

    def query(self, sql: str, names: Sequence[str] = SERVING_TABLES) -> DataFrame:
        self.register_views(names)
        return self.spark.sql(sql)

"""Extracts of a source table taken into the raw layer as they arrive, each exactly once.

Extracts are folders ``<LOAD_DATE column>=<date>`` of Parquet files.  A stream reads the files it has not seen and
merges each micro-batch into the raw table by its keys.  The number of the batch is published with the snapshot it
made, in one step; a batch that comes again, because the job ended between publishing it and recording that it was
done, is told by that number and leaves the table alone.

Within a batch and against the table the later load date wins, so neither the size of batches nor the order in which
files are seen decides.  A key with a NULL equals nothing: in a stream such rows are added with each extract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermill.session import materialize
from ordermill.sources.lake import FEW_VALUES, RAW, Lake, TableSpec


def extract_stream(
    spark: SparkSession, folder: str, schema: StructType, load_date: str, files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the extracts under ``folder``, oldest files first."""
    whole = StructType([*schema.fields, StructField(load_date, StringType())])
    reader = spark.readStream.schema(whole)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def keep_latest(rows: DataFrame, keys: Sequence[str], load_date: str) -> DataFrame:
    """Of each key the rows of its last load date; copies within one load are left to the merge."""
    last = rows.groupBy(*keys).agg(F.max(load_date).alias("__last"))
    named = last.select(*[F.col(k).alias(f"__{k}") for k in keys], "__last")
    same = F.col(load_date).eqNullSafe(F.col("__last"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(named, same, "left_semi")


def publish_batch(lake: Lake, spec: TableSpec, batch: DataFrame, number: int, stream: str, load_date: str) -> bool:
    """Merge one micro-batch; False if it had been published before."""
    done = lake.marks(RAW, spec.name).get(stream)
    if done is not None and number <= int(done):
        return False
    # Up to one more than FEW_VALUES load dates, read from the names of folders; of one date all rows are the latest.
    dates = batch.select(load_date).distinct().limit(FEW_VALUES + 1).count()
    fresh = materialize(keep_latest(batch, spec.keys, load_date) if dates > 1 else batch, f"{spec.name}-batch")
    if lake.exists(RAW, spec.name):
        # Only loads later than the earliest of the batch can hold newer rows: mostly none is read.
        earliest = fresh.agg(F.min(load_date)).first()[0]
        newer = lake.read(RAW, spec.name).filter(F.col(load_date) > F.lit(earliest)).select(
            *[F.col(k).alias(f"__{k}") for k in spec.keys], F.col(load_date).alias("__load"))
        later = F.col("__load") > F.col(load_date)
        for k in spec.keys:
            later &= F.col(k) == F.col(f"__{k}")
        fresh = fresh.join(newer, later, "left_anti")
    lake.upsert(
        fresh, RAW, spec.name, spec.keys, [load_date], marks={stream: str(number)}, rebalance=dates > FEW_VALUES)
    return True


def ingest_stream(
    lake: Lake, extracts: DataFrame, spec: TableSpec, load_date: str, stream: str = "stream", checkpoint: str | None = None,
) -> None:
    """Take in everything that has arrived, then stop; the next call goes on from there.

    ``stream`` names the progress of this job in the table's marks, ``checkpoint`` the folder where Spark keeps its own,
    beside the layers by default.  The two belong together.
    """
    query = (
        extracts.writeStream.foreachBatch(lambda batch, number: publish_batch(lake, spec, batch, number, stream, load_date) and None)
        .option("checkpointLocation", checkpoint or f"{lake.root}/streams/{spec.name}-{stream}")
        .trigger(availableNow=True).start())
    query.awaitTermination()

"""The assignment and per-cluster statistics over streaming DataFrames.

Nothing here is a new operator: the nearest-centre projection (J1/J3) is
stateless, so it runs unchanged on a stream; the per-cluster statistics (A1)
are a streaming aggregation whose state is one row per centre (bounded by the
centre count), and each micro-batch turns the running statistics into the step
result (J2 + F9) with the batch operators.  Checkpoints live under the shared
folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.aggregate import apply_stats, cluster_stats
from ..operators.assign import assign, assign_rank
from ..operators.tiles import TileIndex, assign_table
from ..plans.lloyd import prepare_centers
from ..session import scratch_path
from ..sources.centers import centers_frame


def read_table_stream(spark: SparkSession, path: str, schema: StructType, base_path: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet file-stream source (``path`` may be a directory or a glob)."""
    reader = spark.readStream.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def assign_stream(stream: DataFrame, centers, x: str = "x", y: str = "y", strategy: str = "auto") -> DataFrame:
    """J1/J3 on a stream: every arriving point with its nearest centre."""
    return assign(stream, prepare_centers(centers), x, y, strategy)


def write_stream(df: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True,
                 fmt: str = "parquet") -> StreamingQuery:
    """Append a streaming DataFrame to files, checkpointed in the shared folder."""
    ck = checkpoint or scratch_path(df.sparkSession, "stream-checkpoint")
    w = df.writeStream.format(fmt).option("checkpointLocation", ck).option("path", path).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def assign_stream_table(stream: DataFrame, index_path: str, path: str, x: str = "x", y: str = "y", checkpoint: str | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """J3 on a stream against any number of centres: every micro-batch is searched through a saved ``TileIndex``.

    The index is read by path in each batch, so one that was written anew is taken up by
    the next batch.  A batch is written to its own folder of ``path``, which a repeated batch replaces.
    """
    def search(batch: DataFrame, batch_id: int) -> None:
        index = TileIndex.load(batch.sparkSession, index_path)
        assign_table(batch, index, x, y).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    ck = checkpoint or scratch_path(stream.sparkSession, "stream-checkpoint")
    w = stream.writeStream.option("checkpointLocation", ck).foreachBatch(search)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def running_step(stream: DataFrame, centers, out_path: str, mode: str = "combined", x: str = "x", y: str = "y",
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """One Lloyd step over all points seen so far, refreshed every micro-batch.

    The streaming state is the per-centre statistics (k rows).  Each batch of
    refreshed statistics is finalised against the centre list — empty clusters
    keep their centre — and written over ``out_path`` (idempotent per batch).
    """
    ranked = prepare_centers(centers)
    stats = cluster_stats(assign_rank(stream, ranked, x, y), mode, x=x, y=y)

    def publish(batch: DataFrame, _batch_id: int) -> None:
        result = apply_stats(batch, centers_frame(batch.sparkSession, ranked), mode)
        result.write.mode("overwrite").parquet(out_path)

    spark = stream.sparkSession
    ck = checkpoint or scratch_path(spark, "stream-checkpoint")
    w = stats.writeStream.outputMode("complete").option("checkpointLocation", ck).foreachBatch(publish)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

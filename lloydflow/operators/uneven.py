"""Join of rows with one record per key when a key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is hot.
HOT_ROWS = 4_000_000
_SPREAD = 1024


def join_by_size(rows: DataFrame, records: DataFrame, key: str, size: str, hot_rows: int | None = None) -> DataFrame:
    """``rows`` with the columns of their key's record (``records``: one per key, ``size`` = its rows).

    Hot keys are broadcast: there are fewer of them than rows / ``hot_rows``.  The others are
    shuffled; the rows of hot keys are spread over the same shuffle under keys that match nothing.
    A row whose key has no record fails the query.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    columns = [c for c in records.columns if c != key]
    hot = records.filter(F.col(size) > limit).select(F.col(key).alias("__hot"), F.struct(*columns).alias("__h"))
    cold = records.filter(F.col(size) <= limit).select(F.col(key).cast("string").alias("__cold"), F.struct(*columns).alias("__c"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    spread = F.concat(F.lit("hot "), F.pmod(F.monotonically_increasing_id(), F.lit(_SPREAD)).cast("string"))
    keyed = marked.withColumn("__key", F.when(F.col("__hot").isNull(), F.col(key).cast("string")).otherwise(spread))
    both = keyed.join(cold, F.col("__key") == F.col("__cold"), "left")
    lost = F.raise_error(F.concat(F.lit("no record for key "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    record = F.coalesce("__h", "__c", lost.cast(records.select(F.struct(*columns).alias("s")).schema["s"].dataType))
    return both.withColumn("__r", record).select(*rows.columns, *[F.col(f"__r.{c}").alias(c) for c in columns])

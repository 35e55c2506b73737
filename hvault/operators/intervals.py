"""Interval history operators: merge (gaps and islands), current row, close on
next version, point-in-time look-up.

All are window / join compositions partitioned by the business key, so one
exchange on the key serves the whole chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hvault.functions.keys import open_end

REFERENCE = "reference"
STRICT = "strict"


def merge_intervals(
    df: DataFrame,
    key: str,
    start: str = "create_dttm",
    end: str = "delete_dttm",
    mode: str = REFERENCE,
    first_of: Sequence[str] = (),
) -> DataFrame:
    """Merge overlapping or touching intervals per key.

    Rows without a start are dropped and a NULL end is open. ``reference``
    starts a new island when the start lies after the *previous row's* end
    (a short interval inside a long one can then open a second island);
    ``strict`` compares with the running maximum end. Output: (key, start,
    end) with the open end back to NULL; ``first_of`` columns are taken from
    the island's first row (as a struct column ``_first``).

    One exchange on the key: the island windows and the per-island aggregate
    all run on that partitioning.
    """
    base = df.filter(F.col(start).isNotNull()).select(
        F.col(key).alias("_k"), F.col(start).alias("_s"), F.coalesce(F.col(end), open_end()).alias("_e"), *first_of
    )
    ordered = Window.partitionBy("_k").orderBy(F.col("_s").asc(), F.col("_e").asc())
    if mode == REFERENCE:
        prev_end = F.lag("_e").over(ordered)
        # island id: running sum with the default RANGE frame over the start only
        island_w = Window.partitionBy("_k").orderBy(F.col("_s").asc())
    else:
        prev_end = F.max("_e").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        island_w = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flagged = base.withColumn("_gap", F.when(F.col("_s") > prev_end, 1).otherwise(0))
    islands = flagged.withColumn("_island", F.sum("_gap").over(island_w))
    aggs = [F.min("_s").alias(start), F.max("_e").alias("_max")]
    if first_of:
        aggs.append(F.min(F.struct("_s", *first_of)).alias("_first"))
    return islands.groupBy("_k", "_island").agg(*aggs).select(
        F.col("_k").alias(key), F.col(start), F.nullif(F.col("_max"), open_end()).alias(end), *(["_first"] if first_of else [])
    )


def current_rows(df: DataFrame, to: str = "effective_to_dttm") -> DataFrame:
    return df.filter(F.col(to) == open_end())


def close_on_next(
    df: DataFrame,
    key: str,
    start: str = "effective_from_dttm",
    out: str = "effective_to_dttm",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Each row ends where the next row of its key starts; the last one stays open."""
    w = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break])
    return df.withColumn(out, F.coalesce(F.lead(start).over(w), open_end()))

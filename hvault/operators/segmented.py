"""Ordered per-key scans that stay parallel when one key is hot.

A window ``partitionBy(key).orderBy(t)`` sends all rows of a key to one task.
When one key may hold a large share of all rows, the rows are instead
range-partitioned on (key, t): a hot key's history is cut into consecutive
segments that land in different tasks. Each scan runs inside its segment, and
a small per-(key, segment) summary carries what a segment needs from the
segments before (or after) it -- the last end, the running maximum, the count
of island starts, the last state, the next start. Summaries have one row per
segment, so a hot key contributes at most as many rows as there are
partitions, and the carry windows over them are small.

Results equal the plain window versions (``hvault.operators.intervals``,
``hvault.plans.mart.as_of``). Bounds are cut on the whole order of a scan, so
rows of one (key, instant) are spread, too; what cannot be told apart by it is
combined first (strict merge) or told apart by a hash of the row (as-of probes).
Only the merge by reference rules is cut on the start alone: rows of one start
are peers of its RANGE frame and stay in one segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hvault.functions.keys import open_end

SEG = "_seg"


def segment(df: DataFrame, key: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition on (key, order) and tag each row with its segment (partition) number.

    Range bounds are sampled per exchange, so two plan branches over the same
    range exchange could cut segments differently; the tagged rows are
    therefore checkpointed (reliably, in the session's checkpoint folder) and
    every branch reads the same segment numbers.
    """
    from hvault.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = df.repartitionByRange(n, F.col(key), *[F.col(c) for c in order]).withColumn(SEG, F.spark_partition_id().cast("long"))
    return tagged.checkpoint(eager=True)


def _null_flags(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a flag per order column, and the columns that order NULLs last in every comparison."""
    flags = [f"_null_{i}" for i in range(len(order))]
    df = df.withColumns({f: F.col(c).isNull() for f, c in zip(flags, order)})
    return df, [x for pair in zip(flags, order) for x in pair]


def _over_segments(key: str) -> Window:
    return Window.partitionBy(key).orderBy(SEG)


def merge_intervals_segmented(
    df: DataFrame,
    key: str,
    start: str = "create_dttm",
    end: str = "delete_dttm",
    mode: str = "reference",
    partitions: int | None = None,
    first_of: Sequence[str] = (),
) -> DataFrame:
    """Same result as ``merge_intervals`` (including ``first_of``) with hot keys split over tasks."""
    base = df.filter(F.col(start).isNotNull()).select(
        F.col(key).alias("_k"), F.col(start).alias("_s"), F.coalesce(F.col(end), open_end()).alias("_e"), *first_of
    )
    if mode != "reference":
        # equal intervals change no island: one of each is left (a partial aggregate), with the least ``first_of``
        least = [F.min(F.struct(*first_of)).alias("_f")] if first_of else []
        base = base.groupBy("_k", "_s", "_e").agg(*least) if least else base.distinct()
        base = base.select("_k", "_s", "_e", *[F.col(f"_f.{c}").alias(c) for c in first_of])
    seg = segment(base, "_k", ["_s"] if mode == "reference" else ["_s", "_e"], partitions)
    local = Window.partitionBy("_k", SEG).orderBy(F.col("_s").asc(), F.col("_e").asc())
    if mode == "reference":
        # previous row's end; the first row of a segment takes the last end of
        # the segments before it
        rows = seg.withColumn("_lp", F.lag("_e").over(local))
        summ = seg.groupBy("_k", SEG).agg(F.max(F.struct("_s", "_e")).alias("_last"))
        carry = summ.select("_k", SEG, F.lag("_last._e").over(_over_segments("_k")).alias("_carry"))
        rows = rows.join(carry, ["_k", SEG], "left").withColumn("_prev", F.coalesce("_lp", "_carry"))
        island_local = Window.partitionBy("_k", SEG).orderBy(F.col("_s").asc())  # RANGE frame over the start
    else:
        # running maximum of the ends before the row, across segments
        rows = seg.withColumn("_lp", F.max("_e").over(local.rowsBetween(Window.unboundedPreceding, -1)))
        summ = seg.groupBy("_k", SEG).agg(F.max("_e").alias("_segmax"))
        carry = summ.select(
            "_k", SEG, F.max("_segmax").over(_over_segments("_k").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry")
        )
        rows = rows.join(carry, ["_k", SEG], "left").withColumn("_prev", F.greatest("_lp", "_carry"))
        island_local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_gap", F.when(F.col("_s") > F.col("_prev"), 1).otherwise(0))
    rows = rows.withColumn("_local_island", F.sum("_gap").over(island_local))
    gaps = rows.groupBy("_k", SEG).agg(F.sum("_gap").alias("_n"))
    before = gaps.select(
        "_k", SEG, F.coalesce(F.sum("_n").over(_over_segments("_k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    )
    rows = rows.join(before, ["_k", SEG], "left").withColumn("_island", F.col("_before") + F.col("_local_island"))
    # one row per island; the aggregate is partial, so a long island is combined map-side
    aggs = [F.min("_s").alias(start), F.max("_e").alias("_max")]
    if first_of:
        aggs.append(F.min(F.struct("_s", *first_of)).alias("_first"))
    return rows.groupBy("_k", "_island").agg(*aggs).select(
        F.col("_k").alias(key), F.col(start), F.nullif(F.col("_max"), open_end()).alias(end), *(["_first"] if first_of else [])
    )


def next_value_segmented(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """``lead(value)`` over (key ordered by ``order``), with hot keys split over tasks.

    ``order`` must order a key's rows totally (add a unique tie-break)."""
    df, places = _null_flags(df, order)
    seg = segment(df, key, places, partitions)
    local = Window.partitionBy(key, SEG).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    rows = seg.withColumn("_ln", F.lead(value).over(local))
    summ = seg.groupBy(key, SEG).agg(F.min(F.struct(*[F.col(c) for c in places], F.col(value).alias("_v"))).alias("_first"))
    nxt = summ.select(key, SEG, F.lead("_first._v").over(_over_segments(key)).alias("_carry"))
    is_last = F.row_number().over(local.orderBy(*[F.col(c).desc_nulls_first() for c in order])) == 1
    rows = rows.withColumn("_is_last", is_last).join(nxt, [key, SEG], "left")
    return rows.withColumn(out, F.when(F.col("_is_last"), F.col("_carry")).otherwise(F.col("_ln"))).drop("_ln", "_carry", "_is_last", SEG, *places[::2])


def as_of_segmented(
    probes: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    start: str = "effective_from_dttm",
    end: str = "effective_to_dttm",
    order: tuple[str, ...] = (),
    carry: tuple[str, ...] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``mart.as_of`` with hot keys split over tasks: the last history row of the
    segments before a segment is carried into it."""
    pcols = probes.columns
    h = history.select(
        F.col(key),
        F.col(start).alias("_t"),
        F.lit(0).alias("_probe"),
        *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(order)],
        F.struct(F.col(end).alias("_end"), *[F.col(c) for c in carry]).alias("_h"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in pcols if c != key],
    )
    p = probes.select(
        F.col(key),
        F.col(at).alias("_t"),
        F.lit(1).alias("_probe"),
        *[F.lit(None).cast(history.schema[c].dataType).alias(f"_o_{i}") for i, c in enumerate(order)],
        F.lit(None).cast(h.schema["_h"].dataType).alias("_h"),
        *[F.col(c) for c in pcols if c != key],
    )
    # NULLs are last in the segments, between them and in the summaries; probes of one instant are spread by a hash
    h, p = h.withColumn("_tie", F.lit(0).cast("long")), p.withColumn("_tie", F.xxhash64(*pcols))
    u, ordcols = _null_flags(h.unionByName(p), ["_t", "_probe", *[f"_o_{i}" for i in range(len(order))]])
    u = segment(u, key, [*ordcols, "_tie"], partitions)
    local = Window.partitionBy(key, SEG).orderBy(*[F.col(c).asc_nulls_last() for c in ordcols]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_last", F.last("_h", ignorenulls=True).over(local))
    # every segment gets a summary (NULL when it holds no history row)
    summ = u.groupBy(key, SEG).agg(
        F.max(F.when(F.col("_probe") == 0, F.struct(*[F.col(c) for c in ordcols], F.col("_h").alias("_lh")))).alias("_m")
    )
    carried = summ.select(
        key, SEG, F.last("_m._lh", ignorenulls=True).over(_over_segments(key).rowsBetween(Window.unboundedPreceding, -1)).alias("_carry")
    )
    probes_out = u.filter(F.col("_probe") == 1).join(carried, [key, SEG], "left").withColumn("_eff", F.coalesce("_last", "_carry"))
    valid = F.col("_t").isNotNull() & (F.col("_t") < F.col("_eff._end"))
    return probes_out.select(*[F.col(c) for c in pcols], *[F.when(valid, F.col(f"_eff.{c}")).alias(c) for c in carry])



def prev_value_segmented(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """``lag(value)`` over (key ordered by ``order``), with hot keys split over tasks.

    ``order`` must order a key's rows totally (add a unique tie-break)."""
    df, places = _null_flags(df, order)
    seg = segment(df, key, places, partitions)
    local = Window.partitionBy(key, SEG).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    rows = seg.withColumn("_lp", F.lag(value).over(local))
    summ = seg.groupBy(key, SEG).agg(F.max(F.struct(*[F.col(c) for c in places], F.col(value).alias("_v"))).alias("_last"))
    prv = summ.select(key, SEG, F.lag("_last._v").over(_over_segments(key)).alias("_carry"))
    rows = rows.withColumn("_is_first", F.row_number().over(local) == 1).join(prv, [key, SEG], "left")
    return rows.withColumn(out, F.when(F.col("_is_first"), F.col("_carry")).otherwise(F.col("_lp"))).drop("_lp", "_carry", "_is_first", SEG, *places[::2])


def row_number_segmented(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    out: str,
    descending: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``row_number()`` over (key ordered by ``order``), with hot keys split over tasks:
    the local number plus the rows of the key in the segments before (or, when
    ``descending``, after) the row's segment. ``order`` must order a key's rows
    totally; NULLs sort last ascending and first descending, as in the plain window."""
    seg = segment(df.withColumn("_null_o", F.col(order[0]).isNull()), key, ["_null_o", *order], partitions)
    cols = [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in order]
    rows = seg.withColumn("_rn", F.row_number().over(Window.partitionBy(key, SEG).orderBy(*cols)))
    counts = seg.groupBy(key, SEG).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy(F.col(SEG).desc() if descending else F.col(SEG).asc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = counts.select(key, SEG, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = rows.join(carry, [key, SEG], "left")
    return rows.withColumn(out, (F.col("_before") + F.col("_rn")).cast("int")).drop("_rn", "_before", "_null_o", SEG)

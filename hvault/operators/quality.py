"""Data-quality checks over interval history. Each check returns the failing
rows as (bk_value, version_id, effective_from_dttm, effective_to_dttm); an
empty result is a pass. ``results`` runs a check set over many tables as one
Spark plan (a union of aggregates), not one job per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import Window

from hvault.functions import open_end, ratio, to_ts, ts_lit
from hvault.functions.keys import pack, unpacked
from hvault.plans.sizing import broadcast_if_small

FROM = "effective_from_dttm"
TO = "effective_to_dttm"


def _out(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("bk_value"), F.col("version_id").cast("long").alias("version_id"), F.col(FROM), F.col(TO))


def _slim(sat: DataFrame, key: str, *more) -> DataFrame:
    """What the checks take of a satellite, the key packed: all that their exchanges move."""
    return sat.select(pack(F.col(key).cast("string")).alias(key), F.col("version_id").cast("long").alias("version_id"), FROM, TO, *more)


def _repeated(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` (none of them NULL) occur more than once.

    Hashes of eight bytes are counted first. Only rows of a hash that occurs twice, few in a sound history, are compared
    by their columns; they are told by a broadcast when the hashes are counted to be few."""
    from hvault.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(rows.sparkSession)
    h = F.xxhash64(*cols)
    twice = rows.select(h.alias("_h")).groupBy("_h").count().filter(F.col("count") > 1).select("_h").checkpoint(eager=True)
    suspects = rows.withColumn("_h", h).join(broadcast_if_small(twice), "_h", "left_semi").drop("_h")
    dup = suspects.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*cols)
    return suspects.join(dup, list(cols), "left_semi")


def _asc(key: str) -> Window:
    """Row order of a key's history; ties on the start are broken by end, then version."""
    return Window.partitionBy(key).orderBy(F.col(FROM).asc_nulls_last(), F.col(TO).asc_nulls_last(), F.col("version_id").asc_nulls_last())


def _desc(key: str) -> Window:
    return Window.partitionBy(key).orderBy(F.col(FROM).desc_nulls_first(), F.col(TO).desc_nulls_first(), F.col("version_id").desc_nulls_first())


def history_flags(sat: DataFrame, key: str, hot_keys: bool = False, partitions: int | None = None) -> DataFrame:
    """The satellite with the per-row facts the history checks need:

    * ``_next``: start of the next row of the key (rows ordered by start, end, version);
    * ``_next_closed``: start of the next closed row of the key;
    * ``_n_open``: open rows of the key; ``_n_start``: rows of the key with this start.

    ``hot_keys``: the same facts without any window over a whole key. Rows are
    range-partitioned on (key, start) into segments (equal starts never split),
    the scans run inside each segment and a per-(key, segment) summary --
    first start, smallest closed start, open rows -- carries across segment
    boundaries, so a key holding a third of all rows is spread over many tasks.
    """
    closed = F.col(TO) != open_end()
    is_open = F.col(TO) == open_end()
    if not hot_keys:
        return sat.select(
            "*",
            F.lead(FROM).over(_asc(key)).alias("_next"),
            # next closed start: a growing frame in descending order (linear);
            # a "following .. unbounded" frame would be recomputed for every row
            F.last(F.when(closed, F.col(FROM)), ignorenulls=True).over(_desc(key).rowsBetween(Window.unboundedPreceding, -1)).alias("_next_closed"),
            F.sum(is_open.cast("int")).over(Window.partitionBy(key)).alias("_n_open"),
            F.count(F.lit(1)).over(Window.partitionBy(key, FROM)).alias("_n_start"),
        )
    from hvault.operators.segmented import SEG, segment

    cols = sat.columns
    # NULL starts sort last, as in the plain windows
    seg = segment(sat.withColumn("_null_from", F.col(FROM).isNull()), key, ["_null_from", FROM], partitions)
    order = [FROM, TO, "version_id"]
    asc = Window.partitionBy(key, SEG).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    desc = Window.partitionBy(key, SEG).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    rows = seg.select(
        "*",
        F.lead(FROM).over(asc).alias("_ln"),
        (F.row_number().over(desc) == 1).alias("_is_last"),
        F.last(F.when(closed, F.col(FROM)), ignorenulls=True).over(desc.rowsBetween(Window.unboundedPreceding, -1)).alias("_nc"),
        F.count(F.lit(1)).over(Window.partitionBy(key, SEG, FROM)).alias("_n_start"),
    )
    summ = seg.groupBy(key, SEG).agg(
        F.min(FROM).alias("_first_from"), F.min(F.when(closed, F.col(FROM))).alias("_min_closed"), F.sum(is_open.cast("int")).alias("_open")
    )
    by_seg = Window.partitionBy(key).orderBy(F.col(SEG).asc())
    later = Window.partitionBy(key).orderBy(F.col(SEG).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(
        key,
        SEG,
        F.lead("_first_from").over(by_seg).alias("_c_next"),
        F.min("_min_closed").over(later).alias("_c_closed"),
        F.sum("_open").over(Window.partitionBy(key)).alias("_n_open"),
    )
    rows = rows.join(carry, [key, SEG], "left")
    return rows.select(
        *cols,
        F.when(F.col("_is_last"), F.col("_c_next")).otherwise(F.col("_ln")).alias("_next"),
        F.coalesce("_nc", "_c_closed").alias("_next_closed"),
        "_n_open",
        "_n_start",
    )


def overlapping_intervals(sat: DataFrame, key: str, hot_keys: bool = False) -> DataFrame:
    """A closed row ends after the next closed row of its key starts (open rows are left out first)."""
    rows = history_flags(_slim(sat, key), key, hot_keys)
    return _out(unpacked(rows.filter((F.col(TO) != open_end()) & (F.col(TO) > F.col("_next_closed"))), key), key)


def explicit_deletion(sat: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """The staged batch has a deletion for (key, start) but the satellite's end differs."""
    s = staged.select(
        F.col(key).alias("_k"),
        to_ts(F.trim("create_dttm")).alias("_from"),
        to_ts(F.trim("delete_dttm")).alias("_del"),
    ).filter(F.col("_del").isNotNull())
    # the batch's deletions may be few however large it is: then the satellite is read where it lies
    s = broadcast_if_small(s.withColumn("_k", pack(F.col("_k").cast("string"))))
    j = _slim(sat, key).join(s, (F.col(key) == F.col("_k")) & (F.col(FROM) == F.col("_from")))
    return _out(unpacked(j.filter(F.col(TO) != F.col("_del")), key), key)


def multiple_current_records(sat: DataFrame, key: str) -> DataFrame:
    """D3: more than one open row per key (all of them are reported)."""
    return _out(_repeated(sat.filter(F.col(TO) == open_end()), [key]), key)


def gaps_in_history(sat: DataFrame, key: str, hot_keys: bool = False) -> DataFrame:
    """A closed row whose next row of the key starts after it ends."""
    n = history_flags(_slim(sat, key), key, hot_keys)
    return _out(unpacked(n.filter((F.col(TO) != open_end()) & F.col("_next").isNotNull() & (F.col("_next") > F.col(TO))), key), key)


def referential_integrity(sat: DataFrame, hub: DataFrame, key: str) -> DataFrame:
    """Satellite rows whose key is missing in the hub (distinct)."""
    keys = hub.select(pack(F.col(key).cast("string")).alias(key))
    return _out(unpacked(_slim(sat, key).join(keys, key, "left_anti"), key), key).distinct()


def invalid_intervals(sat: DataFrame, key: str) -> DataFrame:
    """The interval starts after it ends."""
    return _out(sat.filter(F.col(FROM) > F.col(TO)), key)


def duplicate_keys(sat: DataFrame, key: str) -> DataFrame:
    """More than one row per (key, start) -- the primary key check."""
    return _out(_repeated(sat, [key, FROM]), key)


def null_required_field(sat: DataFrame, key: str, column: str) -> DataFrame:
    """NULL in a required column."""
    return _out(sat.filter(F.col(column).isNull()), key)


# Check names of the result view, in its order.
CHECK_NAMES = [
    "check_overlapping_intervals",
    "check_explicit_deletion",
    "check_multiple_current_records",
    "check_gaps_in_history",
    "check_referential_integrity",
    "check_invalid_intervals",
    "check_duplicate_keys",
    "check_null_hash_diff",
]


def checks_for(sat: DataFrame, key: str, hub: DataFrame, staged: DataFrame, hash_col: str = "hash_diff") -> dict[str, DataFrame]:
    return {
        "check_overlapping_intervals": overlapping_intervals(sat, key),
        "check_explicit_deletion": explicit_deletion(sat, staged, key),
        "check_multiple_current_records": multiple_current_records(sat, key),
        "check_gaps_in_history": gaps_in_history(sat, key),
        "check_referential_integrity": referential_integrity(sat, hub, key),
        "check_invalid_intervals": invalid_intervals(sat, key),
        "check_duplicate_keys": duplicate_keys(sat, key),
        "check_null_hash_diff": null_required_field(sat, key, hash_col),
    }


def summarize_check(table: str, test: str, failures: DataFrame, check_ts: str) -> DataFrame:
    """One result row: PASS/FAIL, the distinct failing versions joined by '#' (sorted, NULL when none), the count."""
    versions = F.array_join(F.array_sort(F.collect_set(F.col("version_id").cast("string"))), "#")
    return failures.agg(
        F.lit(table).alias("table_name"),
        F.lit(test).alias("test_name"),
        F.when(F.count(F.lit(1)) == 0, "PASS").otherwise("FAIL").alias("result"),
        F.nullif(versions, F.lit("")).alias("versions"),
        F.count(F.lit(1)).alias("error_count"),
        ts_lit(check_ts).alias("check_timestamp"),
    )


def results(per_table: Mapping[str, Mapping[str, DataFrame]], check_ts: str) -> DataFrame:
    """Every check of every table as one table of results."""
    parts = [summarize_check(t, c, df, check_ts) for t, checks in per_table.items() for c, df in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def summary(res: DataFrame) -> DataFrame:
    """Per table: tests, passed, failed, pass rate in percent (2 decimals)."""
    g = res.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_tests"),
        F.count_if(F.col("result") == "PASS").cast("long").alias("passed_tests"),
        F.count_if(F.col("result") == "FAIL").cast("long").alias("failed_tests"),
    )
    return g.withColumn("pass_rate_percent", ratio(F.col("passed_tests") * 100, F.col("total_tests"), 2).cast(DecimalType(18, 2)))


def failures(res: DataFrame) -> DataFrame:
    """Failed checks with the versions that fail them."""
    return res.filter(F.col("result") == "FAIL").select("table_name", "test_name", "versions")


def table_results(
    sat: DataFrame, key: str, hub: DataFrame, staged: DataFrame, table: str, check_ts: str, hash_col: str = "hash_diff", hot_keys: bool = False
) -> DataFrame:
    """The eight result rows of one table from one pass over it.

    Seven checks become row flags from ``history_flags`` (windows over one
    partitioning of the satellite by key, or its segmented form for hot keys;
    the hub look-up is a left join on the hub's unique key); one aggregate then yields
    result, versions and count per check. Only the
    explicit-deletion check, which joins the staged batch on (key, start),
    runs as its own branch. Same results as running ``checks_for`` one by one.
    """
    closed = F.col(TO) != open_end()
    is_open = F.col(TO) == open_end()
    hub_keys = hub.select(pack(F.col(key).cast("string")).alias(key), F.lit(True).alias("_in_hub"))
    slim = _slim(sat, key, F.col(hash_col).isNull().alias("_no_hash"))
    rows = history_flags(slim.join(hub_keys, key, "left"), key, hot_keys)
    flags = {
        "check_overlapping_intervals": closed & (F.col(TO) > F.col("_next_closed")),
        "check_multiple_current_records": is_open & (F.col("_n_open") > 1),
        "check_gaps_in_history": closed & F.col("_next").isNotNull() & (F.col("_next") > F.col(TO)),
        "check_referential_integrity": F.col("_in_hub").isNull(),
        "check_invalid_intervals": F.col(FROM) > F.col(TO),
        "check_duplicate_keys": F.col("_n_start") > 1,
        "check_null_hash_diff": F.col("_no_hash"),
    }
    row_id = F.struct(F.col(key), "version_id", FROM, TO)
    aggs = []
    for name, flag in flags.items():
        flag = F.coalesce(flag, F.lit(False))
        n = F.count_distinct(F.when(flag, row_id)) if name == "check_referential_integrity" else F.count_if(flag)
        versions = F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(flag, F.col("version_id").cast("string")))), "#"), F.lit(""))
        aggs.append(F.struct(F.lit(name).alias("test_name"), versions.alias("versions"), n.cast("long").alias("error_count")).alias(name))
    per_check = rows.agg(*aggs).select(F.inline(F.array(*[F.col(n) for n in flags])))
    one_pass = per_check.select(
        F.lit(table).alias("table_name"),
        "test_name",
        F.when(F.col("error_count") == 0, "PASS").otherwise("FAIL").alias("result"),
        "versions",
        "error_count",
        ts_lit(check_ts).alias("check_timestamp"),
    )
    return one_pass.unionByName(summarize_check(table, "check_explicit_deletion", explicit_deletion(sat, staged, key), check_ts))

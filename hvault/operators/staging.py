"""Staging: windowed incremental extract, hash keys, look-ups, load registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from hvault.functions.keys import LOW_END, OPEN_END, composite_hash, hash_key, optional_hash_key, pack, to_ts, ts_lit
from hvault.plans.sizing import broadcast_if_small


@dataclass(frozen=True)
class Lookup:
    """Left join of a reference list by code, bringing its name column in."""

    ref: str
    code: str
    name: str


@dataclass(frozen=True)
class StageSpec:
    entity: str
    keys: Mapping[str, str] = field(default_factory=dict)  # hash column -> id column
    links: Mapping[str, Sequence[str]] = field(default_factory=dict)  # link hash -> id columns
    optional_keys: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # hash -> (ref id, own id)
    hash_diffs: Mapping[str, Sequence[str]] = field(default_factory=dict)  # hash column -> attribute columns
    lookups: Sequence[Lookup] = ()


def extract_window(df: DataFrame, start: str | None = None, end: str | None = None, column: str = "last_update") -> DataFrame:
    """Rows with ``start <= column < end``; NULL bounds mean the low / open end, NULL values drop out."""
    ts = to_ts(column)
    return df.filter((ts >= ts_lit(start or LOW_END)) & (ts < ts_lit(end or OPEN_END)))


def with_lookups(df: DataFrame, lookups: Sequence[Lookup], refs: Mapping[str, DataFrame]) -> DataFrame:
    for lk in lookups:
        ref = refs[lk.ref].select(lk.code, lk.name)
        df = df.join(broadcast_if_small(ref, counted=refs[lk.ref]), on=lk.code, how="left")
    return df


def extract(spec: StageSpec, source: DataFrame, refs: Mapping[str, DataFrame], start: str | None = None, end: str | None = None) -> DataFrame:
    """The window of the extract with the looked-up names: what a staging batch has to store."""
    return with_lookups(extract_window(source, start, end), spec.lookups, refs)


def key_expr(spec: StageSpec, key: str) -> Column:
    """A hash key column of the staged entity, over its ``extract``."""
    if key in spec.keys:
        return hash_key(spec.keys[key])
    if key in spec.optional_keys:
        return optional_hash_key(*spec.optional_keys[key])
    return composite_hash(list(spec.links[key]))


def placed(spec: StageSpec, df: DataFrame, src_cols: Sequence[str], key: str) -> DataFrame:
    """``with_hashes`` whose rows are exchanged by the packed ``key`` before they get their hashes: the ids that these are
    made of are shorter, and a codec shrinks them."""
    return with_hashes(spec, df.repartition(pack(key_expr(spec, key))), src_cols)


def with_hashes(spec: StageSpec, df: DataFrame, src_cols: Sequence[str]) -> DataFrame:
    """Keys and hash diffs over an ``extract``: a projection, so a reader computes only the hashes that it takes."""
    hashes = [key_expr(spec, h).alias(h) for h in (*spec.keys, *spec.optional_keys, *spec.links)]
    diffs = [composite_hash(list(cols)).alias(h) for h, cols in spec.hash_diffs.items()]
    names = [lk.name for lk in spec.lookups]
    return df.select(*hashes, *src_cols, *diffs, *names)


def stage(spec: StageSpec, source: DataFrame, refs: Mapping[str, DataFrame], start: str | None = None, end: str | None = None) -> DataFrame:
    """One staging batch: the window of the extract with keys and hash diffs.

    Output = hash columns, then the source columns, then the looked-up names.
    """
    return with_hashes(spec, extract(spec, source, refs, start, end), source.columns)


def stage_batch(specs: Mapping[str, StageSpec], sources: Mapping[str, DataFrame], refs: Mapping[str, DataFrame], start: str | None, end: str | None) -> dict[str, DataFrame]:
    """All fact entities for one window (reference lists are read whole)."""
    return {name: stage(spec, sources[name], refs, start, end) for name, spec in specs.items()}


# --- load registry ---------------------------------------------------------

REGISTRY_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("load_dttm", TimestampNTZType(), True),
        StructField("version_id", LongType(), True),
    ]
)


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def last_load(registry: DataFrame, table: str) -> DataFrame:
    """One row: (table_name, last_load_dttm) with 1900-01-01 when the table was never loaded."""
    return registry.filter(F.col("table_name") == table).agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.max("load_dttm"), ts_lit(LOW_END)).alias("last_load_dttm"),
    )


def next_version(registry: DataFrame, table: str) -> DataFrame:
    """One row: (table_name, last_load_dttm, next_version); the first version is 1."""
    return registry.filter(F.col("table_name") == table).agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.max("load_dttm"), ts_lit(LOW_END)).alias("last_load_dttm"),
        (F.coalesce(F.max("version_id"), F.lit(0)) + 1).cast("long").alias("next_version"),
    )


def record_load(registry: DataFrame, table: str, load_ts: str, rows: DataFrame | None = None, version: int | None = None) -> DataFrame:
    """Append (table, load_ts, version); with ``rows`` given, only when that batch is not empty."""
    if rows is None:
        rows = registry.sparkSession.range(1)
    entry = (
        rows.agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 0)
        .select(F.lit(table).alias("table_name"), ts_lit(load_ts).alias("load_dttm"), F.lit(version).cast("long").alias("version_id"))
    )
    return registry.unionByName(entry)


def batch_counts(batch: Mapping[str, DataFrame], load_ts: str) -> DataFrame:
    """Rows per staged entity and whether the load would be registered (rows > 0)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows_loaded")).select(F.lit(name).alias("table_name"), "rows_loaded")
        for name, df in batch.items()
    ]
    return reduce(DataFrame.unionByName, parts).select(
        "table_name",
        "rows_loaded",
        (F.col("rows_loaded") > 0).alias("registered"),
        F.when(F.col("rows_loaded") > 0, ts_lit(load_ts)).alias("load_dttm"),
    )

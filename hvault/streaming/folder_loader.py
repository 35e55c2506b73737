"""Incremental load of CSV drops with Structured Streaming.

Extracts arrive as new CSV files in ``<drop>/<entity>/``. A file stream over
all entity folders picks up each new file once (the stream's checkpoint
remembers what was read); every micro-batch is split by entity, parsed with
the catalogue's schema, staged (hash keys, look-ups) and loaded into the
vault by ``run_batch``.

The vault is a ``BucketStore``: a batch reads and rewrites only the buckets that
its keys are in, and its manifest, written last, makes it visible. When a failed
batch is replayed (same id, same files) it writes the same folders again, so
every batch takes effect exactly once and the latest committed state is always
readable. Manifests and buckets of old batches are dropped after ``keep``
batches. Reference lists are full refreshes: the newest drop wins, otherwise the
list stays as it was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hvault.operators.intervals import STRICT
from hvault.operators.staging import stage
from hvault.plans.model import STAGING
from hvault.plans.bucket_store import BUCKETS, BucketStore
from hvault.plans.pipeline import (
    HOT_KEY_ROWS, Vault, as_ts, batch_profiles, entity_rows, history_tables, hot_history, run_batch, table_sources, table_specs, touched_buckets, touched_vault,
)
from hvault.plans.sizing import DEFAULT_MAX_BROADCAST_ROWS
from hvault.sources.catalogue import CATALOGUE, REFERENCE_LISTS, SourceSpec
from hvault.sources.csv_folder import parse_lines

KEEP = 10  # committed batches whose state stays readable
COMPACT = 100  # batches between compactions of the log


def _parse(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    return parse_lines(lines.filter(F.col("entity") == spec.entity).select("value"), spec)


def read_snapshot(spark: SparkSession, vault_root: str, batch_id: int | None = None, buckets: int = BUCKETS) -> tuple[Vault, dict[str, DataFrame]]:
    """The vault and reference lists after a batch (the last committed one by default); empty before the first (id -1).

    A batch without a complete manifest is an error: going on without it
    would write a new latest state without any history."""
    store = BucketStore(spark, vault_root, buckets)
    if batch_id is None:
        batch_id = max(store.commits(), default=-1)
    manifest = store.manifest(batch_id)
    tables = {n: store.read(n, schema, batch_id) for n, (schema, _) in table_specs().items()}
    refs = {n: _stored_list(store, n, batch_id) for n in REFERENCE_LISTS if f"ref_{n}" in manifest}
    return Vault(tables), refs


def _stored_list(store: BucketStore, name: str, batch_id: int) -> DataFrame:
    return store.spark.read.parquet(store.folder(f"ref_{name}", store.manifest(batch_id)[f"ref_{name}"][0][-1], 0))


def load_micro_batch(
    lines: DataFrame,
    batch_id: int,
    vault_root: str,
    mode: str = STRICT,
    load_ts: Callable[[int], str] | None = None,
    buckets: int = BUCKETS,
    keep: int = KEEP,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> None:
    spark = lines.sparkSession
    store = BucketStore(spark, vault_root, buckets)
    before = store.manifest(batch_id - 1)
    staging = f"{store.root}/_staging/b={batch_id}"
    lines = lines.persist()
    try:
        refs, written = {}, {}
        for n in REFERENCE_LISTS:
            fresh = _parse(lines, CATALOGUE[n])
            if f"ref_{n}" in before and fresh.isEmpty():
                refs[n] = _stored_list(store, n, batch_id - 1)
            else:
                written[f"ref_{n}"] = store.write_whole(f"ref_{n}", batch_id, fresh)
                refs[n] = spark.read.schema(fresh.schema).parquet(store.folder(f"ref_{n}", batch_id, 0))
        staged = {}
        for e, spec in STAGING.items():
            df = stage(spec, _parse(lines, CATALOGUE[e]), refs)
            df.write.mode("overwrite").parquet(f"{staging}/{e}")
            staged[e] = spark.read.schema(df.schema).parquet(f"{staging}/{e}")
        profiles = batch_profiles(staged, buckets)
        rows = entity_rows(staged, profiles)
        small = {e: n <= DEFAULT_MAX_BROADCAST_ROWS for e, n in rows.items()}
        names = {t for t in table_specs() if touched_buckets(t, profiles)}
        prev = touched_vault(store, batch_id - 1, profiles, names)
        bounds = {t: r["top_bound"] or 0 for t, r in store.latest(batch_id - 1).items()}
        sources, hot, top = table_sources(), {}, {}

        def write_hot(name, df):
            df.write.mode("overwrite").parquet(f"{staging}/{name}")
            return spark.read.schema(df.schema).parquet(f"{staging}/{name}")

        for t in names & set(history_tables()):
            hot[t], top[t] = hot_history(prev[t], staged[sources[t][0][0]], t, bounds.get(t, 0), profiles[sources[t][0]].top, write_hot, hot_key_rows)
        text = (load_ts or (lambda _: dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")))(batch_id)
        vault = run_batch(prev, staged, text, mode, names, small, hot)
        specs = table_specs()
        written |= store.write_all(batch_id, {n: (vault.tables[n], specs[n][1]) for n in names})
        ts = as_ts(text)
        log = [(f"staging_{e}", ts, None, n, None, None) for e, n in rows.items() if n]
        log += [(t, ts, v, rows[sources[t][0][0]], None, top.get(t)) for t, _, v in vault.versions]
        store.record(batch_id, "batch", log)
        store.commit(batch_id, written)
        if batch_id and batch_id % COMPACT == 0:
            store.compact_log(batch_id)
        store.expire(keep)
        store.drop(staging)
    finally:
        lines.unpersist()


def start(
    spark: SparkSession,
    drop_root: str,
    vault_root: str,
    checkpoint: str,
    mode: str = STRICT,
    available_now: bool = True,
    load_ts: Callable[[int], str] | None = None,
    buckets: int = BUCKETS,
    keep: int = KEEP,
) -> StreamingQuery:
    """Start the incremental loader; ``available_now`` processes what is there and stops."""
    lines = (
        spark.readStream.format("text")
        .option("pathGlobFilter", "*.csv")
        .load(f"{drop_root.rstrip('/')}/*")
        .select("value", F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+$", 1).alias("entity"))
    )
    writer = lines.writeStream.foreachBatch(lambda df, bid: load_micro_batch(df, bid, vault_root, mode, load_ts, buckets, keep)).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

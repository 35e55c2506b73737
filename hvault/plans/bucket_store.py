"""Vault tables kept in buckets of the key's hash; a batch rewrites the buckets it touches.

Layout below ``root`` (a shared folder), all plain parquet:

* ``<table>/v=<batch>/_bucket=<n>`` -- one bucket as batch ``batch`` left it
* ``_log/b=<batch>/<part>`` (``_log/upto=<batch>`` once compacted) -- what the batch loaded: table, load time, version, rows,
  the end of its extract window (the mark the next window starts from) and an upper
  bound on the table's largest key group
* ``_manifest/b=<batch>`` -- for each table and bucket, the batches whose folders hold it (its parts)
* ``_layout`` -- the number of buckets

A batch writes data, then its log, then its manifest. The manifest is the commit:
readers go by the newest one that is complete, so what a failed batch left is never
read, and its replay writes the same folders again. Buckets that a batch does not
touch stay where they are; only their manifest rows are repeated. A bucket may also
keep its parts while a batch adds one: tables that only grow, and histories in whose
part no key of the batch lies (``touched_parts``). The rows of a key are all in one
part. The manifest has at most tables x buckets x ``MAX_PARTS`` rows and is the only
thing the driver holds.

The bucket of a key comes from the same hash that Spark's shuffle uses. When the
number of shuffle partitions is a multiple of the number of buckets, a task of a
load's last shuffle writes one bucket, so no extra shuffle is made for the write.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hvault.plans.sizing import shuffled

BUCKETS = 64
MAX_PARTS = 8  # a bucket of as many parts is written anew as one
CELLS = 1 << 16  # a multiple of every allowed number of buckets
LOG = "table_name string, load_dttm timestamp_ntz, version_id long, rows_loaded long, mark timestamp_ntz, top_bound long"
MANIFEST = "table_name string, bucket int, batch long"

Parts = dict[int, tuple[int, ...]]  # bucket -> batches whose folders hold it
Manifest = dict[str, Parts]  # of each table


def cell(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(CELLS))


@dataclass(frozen=True)
class KeyProfile:
    """Of one key column of a batch: rows, an upper bound on the largest key group, and the buckets its keys are in."""

    rows: int
    top: int
    buckets: frozenset[int]


def key_profiles(df: DataFrame, keys: Sequence[str], buckets: int) -> dict[str, KeyProfile]:
    """Profiles of some key columns from one pass: at most ``CELLS`` groups a column, whatever the number of keys; a
    cell's rows bound those of its keys."""
    pairs = [F.struct(F.lit(i).alias("k"), F.when(F.col(k).isNotNull(), cell(F.col(k))).alias("c")) for i, k in enumerate(keys)]
    cells = df.select(F.inline(F.array(*pairs))).groupBy("k", "c").count()
    rows = cells.groupBy("k").agg(
        F.sum("count").alias("rows"),
        F.max(F.when(F.col("c").isNotNull(), F.col("count"))).alias("top"),
        F.collect_set(F.pmod("c", F.lit(buckets))).alias("buckets"),
    ).collect()
    found = {keys[r["k"]]: KeyProfile(r["rows"], r["top"] or 0, frozenset(r["buckets"])) for r in rows}
    return {k: found.get(k, KeyProfile(0, 0, frozenset())) for k in keys}


class BucketStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, first: int = 0):
        if CELLS % buckets:
            raise ValueError(f"the number of buckets must divide {CELLS}")
        self.spark, self.root, self.buckets, self.first = spark, root.rstrip("/"), buckets, first
        self._manifests: dict[int, Manifest] = {}
        if self._exists(f"{self.root}/_layout/_SUCCESS"):
            stored = spark.read.schema("buckets int").parquet(f"{self.root}/_layout").first()["buckets"]
            if stored != buckets:
                raise ValueError(f"{root} has {stored} buckets, not {buckets}")

    # --- files

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def folder(self, table: str, batch: int, bucket: int | None = None) -> str:
        path = f"{self.root}/{table}/v={batch}"
        return path if bucket is None else f"{path}/_bucket={bucket}"

    # --- commits

    def commits(self) -> list[int]:
        """Batches with a complete manifest."""
        found = [int(n[2:]) for n in self._names(f"{self.root}/_manifest") if n.startswith("b=")]
        return sorted(b for b in found if self._exists(f"{self.root}/_manifest/b={b}/_SUCCESS"))

    def manifest(self, batch: int) -> Manifest:
        """Where each bucket is after ``batch``; nothing before the first batch, an error if the batch is not committed."""
        if batch < self.first:
            return {}
        if batch not in self._manifests:
            path = f"{self.root}/_manifest/b={batch}"
            if not self._exists(f"{path}/_SUCCESS"):
                raise RuntimeError(f"manifest {path} is missing or incomplete; restore it or start a new vault folder")
            out: Manifest = {}
            for r in self.spark.read.schema(MANIFEST).parquet(path).collect():  # tables x buckets x parts rows
                of = out.setdefault(r["table_name"], {})
                of[r["bucket"]] = tuple(sorted((*of.get(r["bucket"], ()), r["batch"])))
            self._manifests[batch] = out
        return self._manifests[batch]

    def commit(self, batch: int, written: Mapping[str, Iterable[int]], whole: bool = True, kept: Mapping[str, Parts] | None = None) -> Manifest:
        """Point the written buckets at ``batch``. ``whole``: the batch is loaded, so tables it did not touch stay as they
        were; otherwise (tables are loaded on first use) only tables that were written are part of it so far. ``kept``: the
        parts of a table that stay, beside what the batch wrote; without it the written buckets are replaced."""
        before = self.manifest(batch - 1)
        now: Manifest = {t: dict(b) for t, b in before.items()} if whole else {t: dict(b) for t, b in self._manifests.get(batch, {}).items()}
        for table, buckets in written.items():
            if kept is not None and table in kept:
                stay = kept[table]
            else:
                stay = {b: v for b, v in before.get(table, {}).items() if b not in set(buckets)}
            now[table] = stay | {b: (*stay.get(b, ()), batch) for b in buckets}
        if not self._exists(f"{self.root}/_layout/_SUCCESS"):
            self.spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_layout")
        rows = [(t, b, v) for t, of in sorted(now.items()) for b, vs in sorted(of.items()) for v in vs]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_manifest/b={batch}")
        self._manifests[batch] = now
        return now

    # --- tables

    def write(self, table: str, batch: int, df: DataFrame, key: str) -> list[int]:
        """Write the buckets that ``df`` holds as this batch's; visible once the batch is committed."""
        path = self.folder(table, batch)
        bucket = F.pmod(cell(F.col(key)), F.lit(self.buckets)).cast("int")
        df.withColumn("_bucket", bucket).write.mode("overwrite").option("compression", "zstd").partitionBy("_bucket").parquet(path)
        return [int(n.split("=")[1]) for n in self._names(path) if n.startswith("_bucket=")]

    def write_whole(self, table: str, batch: int, df: DataFrame) -> list[int]:
        """Write a small table that each batch replaces as a whole: it is its own bucket 0."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.folder(table, batch, 0))
        return [0]

    def write_all(self, batch: int, frames: Mapping[str, tuple[DataFrame, str]], parallel: int = 8) -> dict[str, list[int]]:
        """``write`` of independent tables as concurrent jobs: small stages leave cores idle."""
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            jobs = {t: pool.submit(self.write, t, batch, df, key) for t, (df, key) in frames.items()}
            return {t: j.result() for t, j in jobs.items()}

    def read(self, table: str, schema: StructType, batch: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table after ``batch``, or only the given buckets of it: other buckets' files are not even listed."""
        return self.read_parts(table, schema, self.parts(table, batch, buckets))

    def parts(self, table: str, batch: int, buckets: Iterable[int] | None = None) -> Parts:
        """The parts of the table after ``batch``, or only those of the given buckets."""
        where = self.manifest(batch).get(table, {})
        return {b: where[b] for b in (where if buckets is None else sorted(buckets)) if b in where}

    def read_parts(self, table: str, schema: StructType, parts: Parts) -> DataFrame:
        paths = [self.folder(table, v, b) for b, of in parts.items() for v in of]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def touched_parts(self, table: str, schema: StructType, batch: int, keys: DataFrame, key: str, buckets: Iterable[int]) -> Parts:
        """The parts after ``batch`` of the given buckets that a load of ``keys`` has to write anew: those that hold one of
        the keys, maybe more.

        One bucket is looked at first: when each of its parts holds such a key, all parts are taken to; otherwise the keys of
        the other buckets are compared, too. Only hashes of the keys (eight bytes) are exchanged: a part whose key has the
        hash of another key is written anew without need."""
        parts = self.parts(table, batch, buckets)
        if not parts:
            return {}
        bucket = lambda c: F.pmod(cell(c), F.lit(self.buckets))

        def holding(some: list[int]) -> set[tuple[int, int]]:
            frames = []
            for v in sorted({v for b in some for v in parts[b]}):
                own = self.read_parts(table, schema, {b: (v,) for b in some if v in parts[b]})
                own = own.filter(F.col(key).isNotNull())
                frames.append(own.select(F.xxhash64(key).alias("_k"), bucket(F.col(key)).alias("b"), F.lit(v).alias("_v")))
            wanted = keys.filter(F.col(key).isNotNull() & bucket(F.col(key)).isin(some)).select(F.xxhash64(key).alias("_k"))
            met = reduce(DataFrame.unionByName, frames).join(shuffled(wanted), "_k", "left_semi")
            return {(r["b"], r["_v"]) for r in met.select("b", "_v").distinct().collect()}

        first, *rest = parts
        found = holding([first])
        if not rest or found >= {(first, v) for v in parts[first]}:
            found |= {(b, v) for b in rest for v in parts[b]}
        else:
            found |= holding(rest)
        full = {b for b, of in parts.items() if len(of) >= MAX_PARTS}
        chosen = {b: tuple(v for v in of if b in full or (b, v) in found) for b, of in parts.items()}
        return {b: of for b, of in chosen.items() if of}

    def read_keys(self, table: str, schema: StructType, batch: int, keys: DataFrame, key: str) -> DataFrame:
        """Rows of the keys in ``keys`` (any number): only their buckets are scanned, then a semi join on the key."""
        k = keys.select(key).where(F.col(key).isNotNull()).distinct()
        buckets = {r["b"] for r in k.select(F.pmod(cell(F.col(key)), F.lit(self.buckets)).alias("b")).distinct().collect()}
        return self.read(table, schema, batch, buckets).join(k, key, "left_semi")

    # --- log

    def record(self, batch: int, part: str, rows: Sequence[tuple]) -> None:
        """Write one part of the batch's log (rows of ``LOG``); a replay writes the same part again."""
        self.spark.createDataFrame(list(rows), LOG).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_log/b={batch}/{part}")

    def _log_parts(self, batch: int) -> tuple[list[str], list[str]]:
        """(complete parts that make up the log up to ``batch``, parts that a compaction has replaced)."""
        base = f"{self.root}/_log"
        names = self._names(base)
        upto = max((int(n[5:]) for n in names if n.startswith("upto=") and int(n[5:]) <= batch and self._exists(f"{base}/{n}/_SUCCESS")), default=-1)
        parts, replaced = [f"{base}/upto={upto}"] if upto >= 0 else [], []
        for n in names:
            if n.startswith("upto=") and int(n[5:]) < upto:
                replaced.append(f"{base}/{n}")
            elif n.startswith("b=") and int(n[2:]) <= upto:
                replaced.append(f"{base}/{n}")
            elif n.startswith("b=") and int(n[2:]) <= batch:
                parts += [f"{base}/{n}/{p}" for p in self._names(f"{base}/{n}") if self._exists(f"{base}/{n}/{p}/_SUCCESS")]
        return parts, replaced

    def log(self, batch: int) -> DataFrame:
        """What was loaded up to ``batch``, one row per table and load."""
        parts, _ = self._log_parts(batch)
        return self.spark.read.schema(LOG).parquet(*parts) if parts else self.spark.createDataFrame([], LOG)

    def latest(self, batch: int) -> dict[str, dict]:
        """The newest load of each table up to ``batch``: one row a table."""
        newest = F.max(F.struct(F.coalesce("version_id", F.lit(0)).alias("v"), "load_dttm", "rows_loaded", "mark", "top_bound")).alias("n")
        return {r["table_name"]: r.asDict() for r in self.log(batch).groupBy("table_name").agg(newest).select("table_name", "n.*").collect()}

    def compact_log(self, batch: int) -> None:
        """Put the log up to ``batch`` into one part. Once that part is complete it counts instead of those it was made
        of, which are dropped then; cut off before, it does not count."""
        self.log(batch).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_log/upto={batch}")
        for path in self._log_parts(batch)[1]:
            self.drop(path)

    # --- clearing up

    def expire(self, keep: int = 2) -> list[str]:
        """Drop manifests but the newest ``keep`` and the bucket folders that none of those uses; returns the folders dropped."""
        commits = self.commits()
        gone, kept = commits[:-keep], commits[-keep:]
        used = {(t, v, b) for c in kept for t, of in self.manifest(c).items() for b, vs in of.items() for v in vs}
        newest = max(kept, default=-1)
        dropped = []
        for table in {t for c in commits for t in self.manifest(c)}:
            for v in (int(n[2:]) for n in self._names(f"{self.root}/{table}") if n.startswith("v=")):
                for b in (int(n.split("=")[1]) for n in self._names(self.folder(table, v)) if n.startswith("_bucket=")):
                    if (table, v, b) not in used and v <= newest:
                        dropped.append(self.folder(table, v, b))
        for c in gone:  # manifests first: a folder goes only when none names it any more
            self.drop(f"{self.root}/_manifest/b={c}")
            self._manifests.pop(c, None)
        for path in dropped:
            self.drop(path)
        return sorted(dropped)

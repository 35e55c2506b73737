"""Helpers shared by the operators: stored intermediate tables, connected components, column handling."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hvault.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor re-reads stored files instead of recomputing
    the steps before. Returns the stored frame and its path; with ``by``, each
    value of that column has a folder of its own below it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return store(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table made by ``store`` that nothing reads any more."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): each node of ``edges`` with the smallest node reachable from it.

    Alternating large-star and small-star rounds. A round is two aggregates
    (partial sums before the shuffle) and two equi joins, all linear in the
    edges; the edge table is stored between rounds, and nothing is collected
    but one checksum row. Ends when a round changes no edge; raises if
    ``max_rounds`` is not enough (rounds grow with the logarithm of the nodes).
    """
    spark = edges.sparkSession
    hi, lo = F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    cur, path = store(edges.where(F.col(a) != F.col(b)).select(hi, lo).distinct(), "edges")

    def mark(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    old = mark(cur)
    for _ in range(max_rounds):
        if not old[0]:
            break
        both = cur.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(cur.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # u's own link to the smallest neighbour is kept too
        own = least.where("u <> m").select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        large = large.unionByName(own).distinct()
        mins = large.groupBy("hi").agg(F.min("lo").alias("m"))
        links = large.join(mins, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = links.unionByName(mins.select("hi", F.col("m").alias("lo"))).distinct()
        nxt, nxt_path = store(small, "edges")
        new = mark(nxt)
        discard(spark, path)
        cur, path = nxt, nxt_path
        if new == old:
            break
        old = new
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        cur.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )

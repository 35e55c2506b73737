"""Batches whose key sets are too large to broadcast, and what a query's store writes for it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hvault.operators.intervals import REFERENCE, STRICT
from hvault.operators.vault import load_hsat, load_hub, load_link

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


@pytest.fixture
def plain_joins(spark):
    """Neither size-based broadcasts nor adaptive plans: the plan of large tables."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def ts(*cols):
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in cols]


@pytest.mark.parametrize("mode", [STRICT, REFERENCE])
def test_hsat_large_batch_is_one_exchange_with_equal_rows(spark, plain_joins, mode):
    """Untouched keys stay as they are: equal starts, a missing start and a NULL key among them."""
    target = spark.createDataFrame(
        [("a", 1, "h1", "2000-01-05", "2999-12-31", "S", "x"), ("b", 1, "h2", "2000-01-01", "2999-12-31", "S", "y"), ("b", 2, "h3", "2000-01-01", None, "S", "z"),
         ("b", 1, "h3", None, "2000-02-01", "S", "z"), (None, 1, "h4", "2000-01-01", "2000-03-01", "S", "n"), ("c", 1, "h5", "2000-01-01", "2999-12-31", "S", "c")],
        "k string, version_id long, h string, effective_from_dttm string, effective_to_dttm string, src_cd string, v string",
    ).select("k", "version_id", "h", *ts("effective_from_dttm", "effective_to_dttm"), "src_cd", "v")
    batch = spark.createDataFrame(
        [("a", "h6", "2000-01-10", None, "q", "2000-01-10"), ("a", "h7", "2000-01-01", None, "r", "2000-01-11"), ("c", "h8", "2000-01-01", "2000-02-02", "s", "2000-01-01"),
         ("d", "h9", "2000-01-01", None, "t", "2000-01-01"), (None, "h0", "2000-01-01", None, "u", "2000-01-01")],
        "k string, h string, create_dttm string, delete_dttm string, v string, last_update string",
    ).select("k", "h", *ts("create_dttm", "delete_dttm"), "v", *ts("last_update"))
    small, large = (load_hsat(target, batch, "k", "h", ["v"], "S", 3, mode, s) for s in (True, False))
    assert rows(small) == rows(large)
    assert exchanges(large) == 1


def test_link_and_hub_large_batch_equal_small(spark, plain_joins):
    link = spark.createDataFrame([("k1", "a", "x", "2000-01-01", "C")], "k string, h1 string, h2 string, load_dttm string, src_cd string").select("k", "h1", "h2", *ts("load_dttm"), "src_cd")
    lsat = spark.createDataFrame(
        [("k1", 1, "2000-01-05", "2999-12-31", "C"), ("k2", 1, "2000-01-01", "2000-02-01", "C"), ("k2", 1, "2000-01-15", "2000-03-01", "C"), ("k2", 2, "2000-01-15", "2000-03-01", "C"),
         ("k3", 1, None, "2000-03-01", "C"), (None, 1, "2000-01-01", "2999-12-31", "C")],
        "k string, version_id long, effective_from_dttm string, effective_to_dttm string, src_cd string",
    ).select("k", "version_id", *ts("effective_from_dttm", "effective_to_dttm"), "src_cd")
    staged = spark.createDataFrame(
        [("k1", "a", "x", "2000-01-05", "2000-01-09"), ("k1", "a", "x", "2000-01-07", None), ("k4", "b", "y", "2000-01-01", None), (None, "b", "y", "2000-01-01", None)],
        "k string, h1 string, h2 string, create_dttm string, delete_dttm string",
    ).select("k", "h1", "h2", *ts("create_dttm", "delete_dttm"))
    for mode in (STRICT, REFERENCE):
        small, large = (load_link(link, lsat, staged, "k", ("h1", "h2"), "C", 3, "2000-05-01 00:00:00", mode, s) for s in (True, False))
        assert rows(small.link) == rows(large.link) and rows(small.lsat) == rows(large.lsat)
    hub = spark.createDataFrame([("k1", "1")], "k string, id string").withColumn("load_dttm", F.lit("2000-01-01").cast("timestamp_ntz")).withColumn("src_cd", F.lit("C"))
    cand = spark.createDataFrame([("k1", "1"), ("k2", "2"), ("k2", "02"), (None, "3")], "k string, id string")
    small, large = (load_hub(hub, [cand, cand], "k", "id", "C", "2000-05-01 00:00:00", s)[0] for s in (True, False))
    assert rows(small) == rows(large)
    # the candidates are grouped by one exchange, the stored keys take another one
    assert exchanges(large) == 2


@pytest.mark.parametrize("mode", [STRICT, REFERENCE])
def test_store_of_large_batches_equals_plain_store(spark, mode):
    from hvault.plans.pipeline import VaultStore
    from hvault.sources.adaptor import derive_sources

    src = derive_sources(spark, SF)
    plain, large = VaultStore(spark, src, mode), VaultStore(spark, src, mode, max_broadcast_rows=0)
    for name in ["hub_application", "hsat_account", "lsat_acc_x_app"]:
        assert rows(plain.table(name)) == rows(large.table(name))


def test_a_query_pays_for_what_it_reads(spark, tmp_path):
    """One entity's rows stage that entity only, without its hashes; a link's rows leave its satellite unwritten."""
    from hvault.plans.pipeline import VaultStore, table_writer
    from hvault.sources.adaptor import derive_sources

    written, write = {}, table_writer(spark, str(tmp_path))

    def keep(name, df):
        written[name] = df.columns
        return write(name, df)

    store = VaultStore(spark, derive_sources(spark, SF), materialize=keep)
    whole = VaultStore(spark, derive_sources(spark, SF))
    for batch in (1, 2):
        assert rows(store.staged(batch, ["crm_account"])["crm_account"]) == rows(whole.staged(batch)["crm_account"])
    assert set(written) == {"crm_account", "crm_account_status", "crm_account_status_type"}
    assert not [c for c in written["crm_account"] if "hash" in c]
    assert rows(store.table("link_acc_x_app")) == rows(whole.table("link_acc_x_app"))
    assert store.tables._names(f"{store.tables.root}/lsat_acc_x_app") == []
    # what was left out so far is loaded when it is asked for, and logged then
    assert rows(store.table("lsat_acc_x_app")) == rows(whole.table("lsat_acc_x_app"))
    logged = [rows(s.tables.log(2).where("table_name in ('lsat_acc_x_app', 'staging_crm_account')")) for s in (store, whole)]
    assert logged[0] == logged[1] and len(logged[0]) == 4


def test_a_large_key_set_is_not_broadcast_whatever_spark_takes_its_size_for(spark, tmp_path):
    """Staged rows hold ids, their keys are hashes: the files are small enough for Spark's own broadcast, the keys are not."""
    from hvault.functions.keys import hash_key
    from hvault.operators.vault import split_by_keys, upsert_interval
    from hvault.plans.sizing import broadcast_if_small

    spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("2000-01-01").alias("at")).write.parquet(f"{tmp_path}/ids")
    came = spark.read.parquet(f"{tmp_path}/ids").select(hash_key("id").alias("k"), *[F.col("at").cast("timestamp_ntz").alias(c) for c in ("effective_from_dttm", "effective_to_dttm")])
    target = came.where("k > '8'")
    joined = lambda df: df._jdf.queryExecution().executedPlan().toString()
    touched, untouched = split_by_keys(target, came, "k", small=False)
    kept = target.join(broadcast_if_small(came.select("k"), max_rows=999), "k", "left_semi")
    upserted = upsert_interval(target, came, "k", small=False)
    for df in (touched, untouched, kept, upserted):
        assert "Broadcast" not in joined(df)
    assert "Broadcast" in joined(target.join(broadcast_if_small(came.select("k"), max_rows=1000), "k", "left_semi"))
    assert upserted.count() == 1000 and untouched.count() == 0 and touched.count() == kept.count() == target.count()


def test_row_counts_load_all_tables_together(spark, monkeypatch):
    """One load of all tables before any is counted: an entity is profiled once, not once a table."""
    from hvault.plans import queries

    class Store:
        _done, calls = {0: {"hub_a", "link_b", "hsat_c"}}, []

        def vault(self, batch, names):
            self.calls.append((batch, set(names)))

        def table(self, name):
            self.calls.append(name)
            return spark.range(3)

    monkeypatch.setattr(queries, "_store", lambda *_: Store())
    got = queries.QUERIES["pipeline_row_counts"](spark, SF)
    assert Store.calls[0] == (2, {"hub_a", "link_b", "hsat_c"}) and rows(got) == rows(spark.createDataFrame([(n, 3) for n in Store._done[0]], "table_name string, row_count long"))

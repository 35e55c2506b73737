"""What first loads, shared extracts and the history checks move and store."""

from __future__ import annotations

import pytest
from conftest import OPEN, day
from pyspark.sql import functions as F

from hvault.functions.keys import hash_key
from hvault.operators import quality as dq
from hvault.operators.intervals import REFERENCE, STRICT
from hvault.operators.vault import load_hsat, load_link
from test_large_batches import SF, exchanges, plain_joins, rows, ts  # noqa: F401
from test_packed_keys import exchanged

SAT = "k string, version_id long, hash_diff string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz"


def sat(spark):
    found = [("a", 1, "h", 1, 4), ("a", 2, "h", 4, None), ("b", 1, "h", 1, None), ("b", 2, None, 1, None), ("c", 1, "h", 1, 3), ("c", 1, "h", 5, None), (None, 1, "h", 1, None), (None, 2, "h", 1, None)]
    df = spark.createDataFrame([(k, v, h, day(s), OPEN if e is None else day(e)) for k, v, h, s, e in found], SAT)
    return df.withColumn("k", F.when(F.col("k").isNotNull(), hash_key("k")))


@pytest.mark.parametrize("check", [dq.multiple_current_records, dq.duplicate_keys])
def test_repeated_rows_are_told_by_hashes_before_rows_move(spark, plain_joins, check):  # noqa: F811
    s = sat(spark)
    res = check(s, "k")
    b = s.filter("version_id = 2 and hash_diff is null").first().k
    assert sorted((r.bk_value, r.version_id) for r in res.collect()) == [(b, 1), (b, 2)]
    assert "BroadcastHashJoin [_h" in res._jdf.queryExecution().executedPlan().toString()


def test_equal_hashes_of_different_keys_are_no_repetition(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(dq.F, "xxhash64", lambda *cols: real(*cols) % 2)
    s = sat(spark)
    b = s.filter("version_id = 2 and hash_diff is null").first().k
    for check in (dq.multiple_current_records, dq.duplicate_keys):
        assert sorted((r.bk_value, r.version_id) for r in check(s, "k").collect()) == [(b, 1), (b, 2)]


def test_checks_move_no_hash_text(spark, plain_joins):  # noqa: F811
    s = sat(spark)
    hub = s.select("k").filter("k is not null").distinct().localCheckpoint().limit(2).localCheckpoint()
    staged = s.select("k", F.lit("2000-01-02 00:00:00").alias("create_dttm"), F.lit("2000-01-03 00:00:00").alias("delete_dttm"))
    orphans = dq.referential_integrity(s, hub, "k")
    # the anti join's two sides; the distinct after it meets orphans only
    moved = [of for of in exchanged(orphans) if "bk_value" not in {c for c, _ in of}]
    assert len(moved) == 2 and not [c for of in moved for c in of if c[1] == "string"]
    assert orphans.filter("bk_value is null").count() == 2
    for df in (dq.gaps_in_history(s, "k"), dq.overlapping_intervals(s, "k"), dq.explicit_deletion(s, staged, "k"), dq.table_results(s, "k", hub, staged, "t", "2001-01-01 00:00:00")):
        assert not [c for of in exchanged(df) for c in of if c[0] in ("k", "hash_diff") and c[1] == "string"]
    assert [(r.version_id, r.bk_value) for r in dq.gaps_in_history(s, "k").collect()] == [(1, s.filter("version_id = 1").groupBy("k").count().filter("count = 2").first().k)]


@pytest.mark.parametrize("mode", [STRICT, REFERENCE])
def test_a_first_large_load_splits_nothing(spark, plain_joins, mode):  # noqa: F811
    target = spark.createDataFrame([], "k string, version_id long, h string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, src_cd string, v string")
    batch = spark.createDataFrame(
        [("a", "h1", "2000-01-09", None, "z", "2000-01-09"), ("a", "h2", "2000-01-09", "2000-02-01", "y", "2000-01-10"), ("c", "h1", "2000-01-09", None, "z", "2000-01-09")],
        "k string, h string, create_dttm string, delete_dttm string, v string, last_update string",
    ).select("k", "h", *ts("create_dttm", "delete_dttm"), "v", *ts("last_update"))
    small, large = (load_hsat(target, batch, "k", "h", ["v"], "S", 1, mode, s) for s in (True, False))
    assert rows(small) == rows(large) and exchanges(large) == 1
    link = spark.createDataFrame([], "k string, h1 string, load_dttm timestamp_ntz, src_cd string")
    lsat = target.select("k", "version_id", "effective_from_dttm", "effective_to_dttm", "src_cd")
    staged = batch.select("k", F.col("h").alias("h1"), "create_dttm", "delete_dttm")
    small, large = (load_link(link, lsat, staged, "k", ("h1",), "S", 1, "2000-05-01 00:00:00", mode, s) for s in (True, False))
    assert rows(small.lsat) == rows(large.lsat) and rows(small.link) == rows(large.link)
    assert exchanges(large.lsat) <= (1 if mode == STRICT else 3)


def test_windows_of_a_shared_extract_are_not_stored_again(spark, tmp_path):
    from hvault.plans.pipeline import VaultStore, table_writer
    from hvault.sources.adaptor import derive_sources

    written, write = [], table_writer(spark, str(tmp_path))
    src = derive_sources(spark, SF)
    store = VaultStore(spark, src, materialize=lambda name, df: (written.append(name), write(name, df))[1])
    n = [store.staged(b, ["crm_transaction"])["crm_transaction"].count() for b in (1, 2)]
    assert min(n) > 0 and sum(n) == src["crm_transaction"].count()
    assert sorted(written) == ["crm_transaction_type", "extract_crm_transaction"]


def test_transactions_without_hot_orders_take_one_exchange(spark, plain_joins):  # noqa: F811
    from hvault.sources.adaptor import crm_transaction, profiled_transactions

    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    lineitem = lineitem.unionByName(lineitem.limit(3).withColumn("l_orderkey", F.lit(None).cast("bigint")))
    plain, lean = crm_transaction(lineitem), crm_transaction(lineitem, hot_orders=False)
    assert rows(plain) == rows(lean) and exchanges(plain) > 1 and exchanges(lean) == 1
    assert exchanges(profiled_transactions(spark, SF, 1_000_000)) == 1
    assert exchanges(profiled_transactions(spark, SF, 1)) > 1

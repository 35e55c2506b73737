"""The bucketed vault store: touched buckets only, commits by manifest, replays, log, retention."""

import os

import pytest
from conftest import day

from hvault.operators.vault import load_hsat
from hvault.plans.bucket_store import BucketStore, cell, key_profiles
from pyspark.sql import functions as F

SAT = ("k string, version_id long, hash_diff string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, src_cd string, a string")
BATCH = "k string, hash_diff string, create_dttm timestamp_ntz, delete_dttm timestamp_ntz, a string, last_update timestamp_ntz"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def load(spark, store, batch, rows):
    """One satellite load into the store, as the loaders do it."""
    df = spark.createDataFrame(rows, BATCH)
    touched = key_profiles(df, ["k"], store.buckets)["k"].buckets
    target = store.read("sat", SAT, batch - 1, touched)
    out = load_hsat(target, df, "k", "hash_diff", ["a"], "CRM", batch, small=True)
    return {"sat": store.write("sat", batch, out, "k")}


def first(n=400):
    return [(f"key{i}", "h", day(1), None, "x", day(1)) for i in range(n)]


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs}


def test_batch_writes_only_its_buckets(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "vault"), 64, first=1)
    store.commit(1, load(spark, store, 1, first()))
    assert len(store.manifest(1)["sat"]) > 55
    before = files(tmp_path / "vault" / "sat")
    one = [("key7", "h2", day(5), None, "y", day(5))]
    written = load(spark, store, 2, one)
    assert len(written["sat"]) == 1
    store.commit(2, written)
    now = files(tmp_path / "vault" / "sat")
    assert all(now[f] == t for f, t in before.items()) and {f.split("/v=")[1].split("/")[1] for f in set(now) - set(before) if "_bucket" in f} == {f"_bucket={written['sat'][0]}"}
    # the whole table is what a load of the whole table gives
    whole = load_hsat(store.read("sat", SAT, 1), spark.createDataFrame(one, BATCH), "k", "hash_diff", ["a"], "CRM", 2, small=True)
    got = store.read("sat", SAT, 2)
    assert same(got, whole) and got.count() == 401
    # the batch before stays readable
    assert store.read("sat", SAT, 1).count() == 400


def test_failed_batch_is_not_seen_and_its_replay_is_equal(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), 8, first=1)
    store.commit(1, load(spark, store, 1, first(50)))
    rows = [(f"key{i}", "h2", day(4), None, "y", day(4)) for i in range(0, 60, 3)]
    load(spark, store, 2, rows)  # data, but no manifest: the batch failed here
    again = BucketStore(spark, str(tmp_path), 8, first=1)
    assert again.commits() == [1] and again.read("sat", SAT, 1).count() == 50
    with pytest.raises(RuntimeError, match="missing or incomplete"):
        again.read("sat", SAT, 2)
    a = again.commit(2, load(spark, again, 2, rows))
    once = sorted(again.read("sat", SAT, 2).collect())
    b = again.commit(2, load(spark, again, 2, rows))  # replay of a committed batch
    assert a == b == BucketStore(spark, str(tmp_path), 8, first=1).manifest(2)
    assert once == sorted(again.read("sat", SAT, 2).collect())


def test_scans_prune_columns_push_filters_and_skip_buckets(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), 16, first=1)
    store.commit(1, load(spark, store, 1, first()))
    plan = store.read("sat", SAT, 1).where("a = 'x'").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string,a:string>" in plan and "EqualTo(a,x)" in plan
    keys = spark.createDataFrame([("key3",), ("key3",), (None,), ("none",)], "k string")
    got = store.read_keys("sat", SAT, 1, keys, "k")
    wanted = {r.b for r in keys.where("k IS NOT NULL").select(F.pmod(cell(F.col("k")), F.lit(16)).alias("b")).collect()}
    read = {int(p.split("_bucket=")[1].split("/")[0]) for p in got.inputFiles()}
    assert [r.k for r in got.collect()] == ["key3"] and read <= wanted
    assert store.read_keys("sat", SAT, 1, keys.where("false"), "k").count() == 0


def test_key_profile_bounds_the_largest_group(spark):
    rows = [("hot",)] * 300 + [(f"k{i}",) for i in range(500)] + [(None,)] * 20
    df = spark.createDataFrame(rows, "k string").withColumn("j", F.lit("x")).repartition(5)
    p = key_profiles(df, ["k", "j"], 8)
    assert p["k"].rows == 820 and 300 <= p["k"].top < 320 and p["k"].buckets == frozenset(range(8))
    assert p["j"].top == 820 and len(p["j"].buckets) == 1
    empty = key_profiles(df.where("false"), ["k"], 8)["k"]
    assert (empty.rows, empty.top, empty.buckets) == (0, 0, frozenset())


def test_log_and_its_compaction(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), 8)
    assert store.latest(9) == {}
    for b in range(4):
        store.record(b, "batch", [("hub", day(b), b + 1, 10 * b, None, None), ("staging_x", day(b), None, 5, day(b + 1), None)])
    store.record(3, "batch", [("hub", day(3), 4, 30, None, 7), ("staging_x", day(3), None, 5, day(4), None)])  # a replay
    assert store.log(2).count() == 6 and store.log(3).count() == 8
    rows = store.log(3).toPandas()
    store.compact_log(3)
    assert os.listdir(tmp_path / "_log") == ["upto=3"]
    after = store.log(3).toPandas()
    order = ["table_name", "load_dttm"]
    assert rows.sort_values(order, ignore_index=True).equals(after.sort_values(order, ignore_index=True))
    store.record(4, "batch", [("hub", day(4), 5, 1, None, 9)])
    assert store.log(4).count() == 9 and store.latest(4)["hub"]["v"] == 5
    # a compaction that was cut off changes nothing
    os.makedirs(tmp_path / "_log" / "upto=4")
    assert store.log(4).count() == 9
    newest = store.latest(3)
    assert newest["hub"]["v"] == 4 and newest["hub"]["top_bound"] == 7 and newest["staging_x"]["mark"] == day(4)


def test_old_buckets_expire(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), 4, first=1)
    store.commit(1, load(spark, store, 1, first(40)))
    for b in (2, 3, 4):
        store.commit(b, load(spark, store, b, [("key1", f"h{b}", day(b), None, "y", day(b))]))
    bucket = next(iter(set(store.manifest(4)["sat"].items()) - set(store.manifest(1)["sat"].items())))[0]
    dropped = store.expire(2)
    assert store.commits() == [3, 4] and dropped == sorted(store.folder("sat", b, bucket) for b in (1, 2))
    assert store.read("sat", SAT, 4).count() == 43 and store.read("sat", SAT, 3).count() == 42
    assert store.expire(2) == []


def test_number_of_buckets_is_kept(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), 4)
    store.commit(0, {"ref": store.write_whole("ref", 0, spark.range(3))})
    with pytest.raises(ValueError, match="has 4 buckets"):
        BucketStore(spark, str(tmp_path), 8)
    with pytest.raises(ValueError, match="divide"):
        BucketStore(spark, str(tmp_path), 7)


def test_window_starts_at_the_stored_mark(spark):
    """Staging again after a crash between data and mark gives the same windows; the second window starts where the log says."""
    from hvault.plans.pipeline import ENDS, VaultStore, as_ts
    from hvault.sources.adaptor import derive_sources

    src = derive_sources(spark, "/root/testdata/sf0.001")
    store = VaultStore(spark, src)
    failing = store.tables.record
    store.tables.record = lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        store.staged(1)
    store.tables.record = failing
    store._staged.clear()
    assert store.mark(1) == str(as_ts(ENDS[0]))
    both = store.staged(1)["crm_transaction"].unionByName(store.staged(2)["crm_transaction"])
    assert both.count() == src["crm_transaction"].where("last_update IS NOT NULL").count()
    # a later mark moves the next window
    late = VaultStore(spark, src)
    late.staged(1)
    late.tables.record(1, "staging", [("staging_crm_transaction", as_ts("1998-01-01"), None, 1, as_ts("2100-01-01"), None)])
    assert late.staged(2)["crm_transaction"].count() == 0

"""Segmented (hot-key safe) scans equal the plain per-key windows, also when
one key is split over many segments."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hvault.operators.intervals import close_on_next, merge_intervals
from hvault.operators.segmented import as_of_segmented, merge_intervals_segmented, next_value_segmented
from hvault.plans.mart import as_of

T0 = dt.datetime(2024, 1, 1)


def _intervals(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):  # key "hot" holds most rows
        k = "hot" if i % 5 else f"k{i % 17}"
        s = T0 + dt.timedelta(minutes=rnd.randrange(0, 20000))
        e = None if rnd.random() < 0.02 else s + dt.timedelta(minutes=rnd.choice([0, 5, 30, 120, 600]))
        if rnd.random() < 0.03:
            e = s - dt.timedelta(minutes=3)  # invalid interval
        rows.append((k, s, e))
    rows.append(("hot", None, T0))
    return spark.createDataFrame(rows, "k string, create_dttm timestamp_ntz, delete_dttm timestamp_ntz")


@pytest.mark.parametrize("mode", ["reference", "strict"])
def test_merge_segmented_equals_plain(spark, mode):
    df = _intervals(spark)
    plain = merge_intervals(df, "k", mode=mode)
    seg = merge_intervals_segmented(df, "k", mode=mode, partitions=13)
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0
    assert plain.count() > 10


def test_next_value_segmented_equals_plain(spark):
    df = _intervals(spark).filter(F.col("create_dttm").isNotNull()).withColumn("id", F.monotonically_increasing_id()).withColumnRenamed(
        "create_dttm", "effective_from_dttm"
    )
    plain = close_on_next(df.select("k", "id", "effective_from_dttm"), "k", tie_break=("id",))
    seg = next_value_segmented(df.select("k", "id", "effective_from_dttm"), "k", ["effective_from_dttm", "id"], "effective_from_dttm", "effective_to_dttm", 11)
    seg = seg.withColumn("effective_to_dttm", F.coalesce("effective_to_dttm", F.lit(dt.datetime(2999, 12, 31))))
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0


def test_as_of_segmented_equals_plain(spark):
    states = (
        _intervals(spark)
        .filter(F.col("create_dttm").isNotNull())
        .withColumn("id", F.monotonically_increasing_id())
        .select("k", "id", F.col("create_dttm").alias("effective_from_dttm"), (F.col("id") % 3).cast("string").alias("state"))
    )
    states = close_on_next(states, "k", tie_break=("id",))
    rnd = random.Random(3)
    probes = spark.createDataFrame(
        [("hot" if i % 4 else f"k{i % 19}", i, T0 + dt.timedelta(minutes=rnd.randrange(-100, 21000))) for i in range(1500)],
        "k string, pid int, at timestamp_ntz",
    )
    plain = as_of(probes, states, "k", "at", order=("id",), carry=("state", "effective_from_dttm"))
    seg = as_of_segmented(probes, states, "k", "at", order=("id",), carry=("state", "effective_from_dttm"), partitions=9)
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0
    assert plain.filter(F.col("state").isNotNull()).count() > 1000


@pytest.fixture
def segments(monkeypatch):
    """Number of segments that hold rows of the hot key's busiest instant, for each ``segment`` call."""
    from hvault.operators import segmented

    plain, out = segmented.segment, []

    def spy(df, key, order, partitions=None):
        seg = plain(df, key, order, partitions)
        t = "_s" if "_s" in df.columns else "_t"
        busy = seg.filter(F.col(key) == "hot").groupBy(t).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(segmented.SEG).alias("s"))
        out.append(busy.orderBy(F.col("n").desc()).first()["s"])
        return seg

    monkeypatch.setattr(segmented, "segment", spy)
    return out


def test_merge_spreads_rows_of_one_instant(spark, segments):
    rnd = random.Random(3)
    rows = [("hot", T0 + dt.timedelta(hours=50 if i % 5 else i % 97), T0 + dt.timedelta(hours=50, minutes=i % 1300 if i % 5 else -i), i % 7) for i in range(2600)]
    rows += [("hot", T0 + dt.timedelta(hours=50), None, 5)] * 40 + [(f"k{rnd.randrange(9)}", T0 + dt.timedelta(hours=rnd.randrange(400)), T0 + dt.timedelta(hours=rnd.randrange(400)), 1) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, create_dttm timestamp_ntz, delete_dttm timestamp_ntz, v int")
    for first_of in ([], ["v"]):
        plain = merge_intervals(df, "k", mode="strict", first_of=first_of)
        seg = merge_intervals_segmented(df, "k", mode="strict", partitions=9, first_of=first_of)
        if first_of:
            plain, seg = (x.select("k", "create_dttm", "delete_dttm", F.col("_first.v")) for x in (plain, seg))
        assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0
    assert len(segments) == 2 and min(segments) > 2


def test_as_of_spreads_probes_of_one_instant(spark, segments):
    at = T0 + dt.timedelta(hours=5)
    hist = [("hot", T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i + 1), f"s{i}") for i in range(12)] + [("hot", at, at + dt.timedelta(hours=1), "t"), ("hot", None, at + dt.timedelta(days=9), "null start"), ("n", None, None, "x")]
    states = spark.createDataFrame(hist, "k string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, state string")
    probes = spark.createDataFrame([("hot", i, at if i % 5 else T0 + dt.timedelta(minutes=i)) for i in range(1200)] + [("n", 1, at), ("hot", 7, None)], "k string, pid int, at timestamp_ntz")
    plain = as_of(probes, states, "k", "at", order=("state",), carry=("state", "effective_from_dttm"))
    seg = as_of_segmented(probes, states, "k", "at", order=("state",), carry=("state", "effective_from_dttm"), partitions=9)
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0
    assert segments[0] > 2


def test_prev_value_segmented_equals_lag(spark):
    from pyspark.sql.window import Window

    from hvault.operators.segmented import prev_value_segmented

    df = _intervals(spark).filter(F.col("create_dttm").isNotNull()).withColumn("id", F.monotonically_increasing_id())
    df = df.select("k", "id", "create_dttm", (F.col("id") % 4).cast("string").alias("v")).cache()
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("create_dttm", "id")))
    seg = prev_value_segmented(df, "k", ["create_dttm", "id"], "v", "p", 7)
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0


def test_mart_hot_key_paths_equal_window_paths(spark):
    import os

    from hvault.plans import mart
    from hvault.plans.pipeline import vault_store

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    t = vault_store(spark, sf).table
    args = (t("link_cust_x_req"), t("hsat_request"), t("hsat_request_status"))
    ti, ti_hot = mart.tail_info(*args), mart.tail_info(*args, hot_keys=True)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(ti, ti_hot)
    assert same(mart.with_previous_type(ti), mart.with_previous_type(ti, hot_keys=True))
    assert same(mart.activation_grid(ti, step_days=7), mart.activation_grid(ti, step_days=7, hot_keys=True))
    kop = (t("hsat_cab_customer"), t("hub_customer"), *args)
    assert same(mart.kopylka_monthly(*kop), mart.kopylka_monthly(*kop, hot_keys=True))
    tx = (t("hub_transaction"), t("hsat_transaction"), t("link_trans_x_orig_trans"), t("link_acc_x_trans"), t("link_acc_x_app"), t("link_cust_x_app"), ti)
    assert same(mart.transaction_info(*tx), mart.transaction_info(*tx, hot_keys=True))


@pytest.mark.parametrize("descending", [False, True])
def test_row_number_segmented_equals_plain(spark, descending):
    from pyspark.sql.window import Window

    from hvault.operators.segmented import row_number_segmented

    df = _intervals(spark).select("k", "create_dttm").distinct()
    o = F.col("create_dttm").desc_nulls_first() if descending else F.col("create_dttm").asc_nulls_last()
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(o)))
    seg = row_number_segmented(df, "k", ["create_dttm"], "rn", descending, partitions=9)
    assert plain.exceptAll(seg.select(plain.columns)).count() == 0 and seg.select(plain.columns).exceptAll(plain).count() == 0
    assert seg.filter(F.col("k") == "hot").agg(F.max("rn")).first()[0] > 2000


def test_key_history_hot_path_equals_plain(spark):
    from hvault.plans.mart import key_history

    # one row per (key, start), as the satellite's primary key guarantees
    rows = _intervals(spark).filter(F.col("create_dttm").isNotNull()).groupBy("k", F.col("create_dttm").alias("effective_from_dttm")).agg(
        F.max("delete_dttm").alias("effective_to_dttm")
    )
    hub = rows.select("k").distinct().withColumn("id", F.upper("k"))
    a = key_history(rows, hub, "k", "id")
    b = key_history(rows, hub, "k", "id", hot_keys=True).select(a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("which", ["next", "prev"])
def test_null_order_values_equal_plain(spark, which):
    """NULL order values sort last in the segments, between them and in the plain window."""
    from pyspark.sql.window import Window

    from hvault.operators.segmented import prev_value_segmented

    rows = [("hot" if i % 25 else f"k{i % 3}", None if i % 3 == 0 else (i * 7) % 60, i) for i in range(399)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    fn, segmented = (F.lead, next_value_segmented) if which == "next" else (F.lag, prev_value_segmented)
    plain = df.withColumn("out", fn("id").over(w))
    seg = segmented(df, "k", ["t", "id"], "id", "out", 4)
    assert seg.columns == plain.columns
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0

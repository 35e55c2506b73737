"""Hash columns move packed through exchanges and come back as the same text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hvault.functions.keys import hash_key, pack, unpack
from hvault.operators.intervals import REFERENCE, STRICT
from hvault.operators.vault import load_hsat, load_hub, load_link
from hvault.plans import mart
from test_large_batches import plain_joins, rows, ts  # noqa: F401

MD5 = ["0" * 32, "12" * 16, "F" * 32, "1A" * 16, "9B" * 16]


def exchanged(df):
    """(name, type) of each column that a hash exchange of the plan moves."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString().split("\n")[0]:
            found.append([(a.name(), a.dataType().simpleString()) for a in (node.output().apply(i) for i in range(node.output().size()))])
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_pack_is_one_to_one_and_keeps_the_order_of_a_kind(spark):
    other = ["", "a", "b", "ab", "b c", "A ", None, "fF" * 16, "g" * 32, "1" * 31, "1" * 33, "é" * 16, "ab" * 8, "x\0", "\0" * 32]
    texts = MD5 + [t.lower() for t in MD5] + other
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pack("t").alias("p"))
    assert all(r.t == r.u for r in df.select("t", unpack("p").alias("u")).collect())
    assert df.filter("t is not null").select("p").distinct().count() == len({t for t in texts if t is not None})
    assert all(len(r.p) == 16 for r in df.filter(F.col("t").isin(*MD5)).collect())
    for kind in (MD5, [t.lower() for t in MD5], ["b", "ab", "a", "", "b c"]):
        of = df.filter(F.col("t").isin(*kind)).distinct()
        assert [r.t for r in of.orderBy("p").collect()] == sorted(kind)


def hsat(spark):
    target = spark.createDataFrame([("a", 1, "h", "2000-01-01", "2999-12-31", "S", "x"), ("b", 1, "h", "2000-01-01", "2999-12-31", "S", "y")], "k string, version_id long, h string, effective_from_dttm string, effective_to_dttm string, src_cd string, v string")
    target = target.select(hash_key("k").alias("k"), "version_id", hash_key("h").alias("h"), *ts("effective_from_dttm", "effective_to_dttm"), "src_cd", "v")
    batch = spark.createDataFrame([("a", "i", "2000-01-09", None, "z", "2000-01-09"), ("c", "i", "2000-01-09", None, "z", "2000-01-09")], "k string, h string, create_dttm string, delete_dttm string, v string, last_update string")
    return target, batch.select(hash_key("k").alias("k"), hash_key("h").alias("h"), *ts("create_dttm", "delete_dttm"), "v", *ts("last_update"))


@pytest.mark.parametrize("mode", [STRICT, REFERENCE])
def test_loads_exchange_no_hash_text(spark, plain_joins, mode):  # noqa: F811
    loads = [load_hsat(*hsat(spark), "k", "h", ["v"], "S", 2, mode, False)]
    assert {r.k for r in loads[0].collect()} == {r.k for r in spark.sql("select upper(md5(k)) k from values ('A'), ('B'), ('C') t(k)").collect()}
    link = spark.createDataFrame([("A", "X", "Y", "2000-01-01", "C")], "k string, h1 string, h2 string, load_dttm string, src_cd string")
    link = link.select(*[hash_key(c).alias(c) for c in ("k", "h1", "h2")], *ts("load_dttm"), "src_cd")
    lsat = spark.createDataFrame([("A", 1, "2000-01-01", "2999-12-31", "C")], "k string, version_id long, effective_from_dttm string, effective_to_dttm string, src_cd string")
    lsat = lsat.select(hash_key("k").alias("k"), "version_id", *ts("effective_from_dttm", "effective_to_dttm"), "src_cd")
    staged = spark.createDataFrame([("A", "X", "Y", "2000-01-05", None), ("B", "X", "Z", "2000-01-05", None)], "k string, h1 string, h2 string, create_dttm string, delete_dttm string")
    staged = staged.select(*[hash_key(c).alias(c) for c in ("k", "h1", "h2")], *ts("create_dttm", "delete_dttm"))
    res = load_link(link, lsat, staged, "k", ("h1", "h2"), "C", 2, "2000-02-01 00:00:00", mode, False)
    hub = spark.createDataFrame([("A", "A")], "k string, id string").select(hash_key("k").alias("k"), "id", F.lit("2000-01-01").cast("timestamp_ntz").alias("load_dttm"), F.lit("C").alias("src_cd"))
    loads += [res.link, res.lsat, load_hub(hub, [staged.select("k", F.lit("B").alias("id"))], "k", "id", "C", "2000-02-01 00:00:00", False)[0]]
    assert sorted(r.k for r in res.link.collect()) == sorted(r.k for r in staged.collect())
    for df in loads:
        moved = exchanged(df)
        assert moved and not [c for of in moved for c in of if c[0] in ("k", "h", "h1", "h2") and c[1] == "string"]


def test_transaction_view_exchanges_wide_rows_by_customer_only(spark, plain_joins):  # noqa: F811
    from hvault.plans.pipeline import VaultStore
    from hvault.sources.adaptor import derive_sources

    t = VaultStore(spark, derive_sources(spark, "/root/testdata/sf0.001")).table
    ti = mart.tail_info(t("link_cust_x_req"), t("hsat_request"), t("hsat_request_status"))
    view = mart.transaction_info(t("hub_transaction"), t("hsat_transaction"), t("link_trans_x_orig_trans"), t("link_acc_x_trans"), t("link_acc_x_app"), t("link_cust_x_app"), ti)
    moved = exchanged(view)
    assert not [c for of in moved for c in of if c[0].endswith("hash_key") and c[1] == "string"]
    wide = [of for of in moved if {"transaction_amt", "account_hash_key"} <= {c for c, _ in of}]
    assert len(wide) == 1
    assert all(len(r[0]) == 32 for r in view.select("customer_hash_key").limit(5).collect())

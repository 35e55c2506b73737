"""Views whose keys stay packed between the mart's steps, and what the loads' look-ups exchange."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hvault.functions.keys import unpacked
from hvault.plans import mart, queries
from hvault.plans.pipeline import vault_store

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("hot", [False, True])
def test_packed_views_equal_text(spark, hot):
    t = vault_store(spark, SF).table
    ti = [mart.tail_info(t("link_cust_x_req"), t("hsat_request"), t("hsat_request_status"), hot, text=text) for text in (True, False)]
    assert rows(ti[0]) == rows(unpacked(ti[1], "customer_hash_key", "request_hash_key"))
    names = ("hub_transaction", "hsat_transaction", "link_trans_x_orig_trans", "link_acc_x_trans", "link_acc_x_app", "link_cust_x_app")
    txi = [mart.transaction_info(*map(t, names), i, hot_keys=hot, text=text) for i, text in zip(ti, (True, False))]
    keys = [c for c in txi[0].columns if c.endswith("_hash_key")]
    assert len(keys) == 4 and rows(txi[0]) == rows(unpacked(txi[1], *keys))
    broken = [mart.limit_violations(x, t("hsat_transaction"), text=text) for x, text in zip(txi, (True, False))]
    assert rows(broken[0]) == rows(unpacked(broken[1], *keys[:2])) != []


def test_violations_read_the_transaction_view_from_a_table(spark):
    """The view is read three times; its windows and joins run once."""
    for name in ("transaction_drill_down_violations", "state_drill_down_violations"):
        text = plan(queries.QUERIES[name](spark, SF))
        assert text.count("hub_transaction") == 0 and "transaction_info" in str(vault_store(spark, SF).view("transaction_info", None).inputFiles())
    assert "Window" not in plan(queries.QUERIES["transaction_drill_down_violations"](spark, SF))


def test_hot_customers_are_bounded_from_eight_byte_hashes(spark, monkeypatch):
    st, seen = vault_store(spark, SF), []
    monkeypatch.setattr(st, "key_hot", lambda name, frame, key, weight=None: seen.append((frame(), key, weight)) or False)
    assert queries._hot_transaction_customers(spark, SF) is False
    (frame, key, weight), = seen
    assert dict(frame.dtypes) == {key: "bigint", weight: "bigint"}
    most = frame.groupBy(key).agg(F.sum(weight).alias("n")).agg(F.max("n")).first()[0]
    monkeypatch.undo()
    exact = queries._txi(spark, SF).groupBy("customer_hash_key").count().agg(F.max("count")).first()[0]
    assert most >= exact > 0


def test_source_variants_stay_compiled(spark):
    """Neither array nor function over it for one unconditional variant; no interpreted filter for several."""
    sources = vault_store(spark, SF).sources
    assert "Generate" not in plan(sources["application"]) and "lambda" not in plan(sources["crm_account"]) + plan(sources["cab_customer"])

"""Registered queries against their DuckDB oracles on the smallest test tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"
FAST = [
    "hash_key", "link_hash_key", "stage_crm_transaction", "hub_customer", "lsat_acc_x_app", "lsat_two_batches",
    "hsat_cab_customer", "hsat_two_batches", "hsat_late_rows", "merge_intervals_lag", "merge_intervals_max",
    "asof_state", "state_intervals", "transaction_enriched", "activation_30d", "retention_monthly",
    "user_activity_monthly", "metrics_unified", "churn_monthly", "ltv_monthly", "dq_results", "dq_results_ref",
]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    import duckdb

    import __spark_entry__ as E
    from tools.compare_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, drows)


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and "retention_rate" in df.columns

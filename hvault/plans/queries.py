"""Registered queries: every operator run over the test tables.

Each query is ``(spark, sf_dir) -> DataFrame``. The vault of the two-batch
scenario is built once per (session, folder, mode) by ``vault_store`` and its
tables are materialised on first use, so queries over the same vault share
them (as mart views share stored core tables in production).

Output convention: an open interval end (2999-12-31) is shown as NULL, since
that sentinel does not fit a pandas timestamp.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from hvault.functions import composite_hash, hash_key, md5_coalesce, md5_concat_ws, open_as_null, roundup_amount, to_money, to_ts
from hvault.operators import quality as dq
from hvault.functions import open_end
from hvault.functions.keys import packed, unpacked
from hvault.operators.intervals import REFERENCE, STRICT
from hvault.operators.segmented import as_of_segmented, merge_intervals_segmented, next_value_segmented
from hvault.operators.staging import batch_counts, extract_window, last_load
from hvault.plans import mart
from hvault.plans.model import DQ_TABLES, HUBS, LINKS, SATS
from hvault.plans.pipeline import LOAD_TS, vault_store
from hvault.sources import csv_folder
from hvault.sources.adaptor import read_tables
from hvault.sources.catalogue import CATALOGUE, REFERENCE_LISTS, catalogue_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def present(df: DataFrame) -> DataFrame:
    """Show open interval ends as NULL in every timestamp column."""
    return df.select(
        *[open_as_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, TimestampNTZType) else F.col(f.name) for f in df.schema.fields]
    )


def shown(view: DataFrame) -> DataFrame:
    """A view with packed keys as a query gives it."""
    return present(unpacked(view, *[c for c in view.columns if c.endswith("_hash_key")]))


def _store(spark, sf_dir, mode=STRICT):
    return vault_store(spark, sf_dir, mode)


# --- sources ---------------------------------------------------------------


@query("source_catalogue")
def q_source_catalogue(spark, sf_dir):
    src = _store(spark, sf_dir).sources
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("source_rows")).select(F.lit(n).alias("entity_name"), "source_rows") for n, df in src.items()],
    )
    return catalogue_frame(spark).join(counts, "entity_name", "left")


def _csv_root(spark: SparkSession) -> str:
    from hvault.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"


@query("csv_folder_scan")
def q_csv_folder_scan(spark, sf_dir):
    src = _store(spark, sf_dir).sources
    root = _csv_root(spark)
    csv_folder.write_folder(src["cab_customer"], root, CATALOGUE["cab_customer"])
    return csv_folder.scan_folder(spark, root, CATALOGUE["cab_customer"])


@query("register_sources")
def q_register_sources(spark, sf_dir):
    src = _store(spark, sf_dir).sources
    root = _csv_root(spark)
    for name, df in src.items():
        csv_folder.write_folder(df, root, CATALOGUE[name])
    _, report = csv_folder.register_all(spark, root, CATALOGUE.values())
    return report


@query("incremental_window")
def q_incremental_window(spark, sf_dir):
    src = _store(spark, sf_dir).sources
    return extract_window(src["crm_transaction"], "1998-01-01 00:00:00", "1999-01-01 00:00:00")


@query("ref_refresh")
def q_ref_refresh(spark, sf_dir):
    src = _store(spark, sf_dir).sources
    parts = [src[n].select(F.lit(n).alias("entity_name"), F.col(src[n].columns[0]).alias("code"), F.col(src[n].columns[1]).alias("name")) for n in REFERENCE_LISTS]
    return reduce(DataFrame.unionByName, parts)


def _staged(spark, sf_dir, batch=1, entities=None):
    return _store(spark, sf_dir).staged(batch, entities)


def _all_staged(spark, sf_dir, entity):
    """The entity's staged rows of both windows."""
    return _staged(spark, sf_dir, 1, [entity])[entity].unionByName(_staged(spark, sf_dir, 2, [entity])[entity])


for _entity in ("advert_source", "application", "cab_customer", "crm_account", "crm_customer", "crm_transaction", "service_request"):
    QUERIES[f"stage_{_entity}"] = (lambda e: lambda spark, sf_dir: _all_staged(spark, sf_dir, e))(_entity)


@query("typed_staging")
def q_typed_staging(spark, sf_dir):
    s = _all_staged(spark, sf_dir, "crm_transaction")
    return s.select(
        "transaction_hash_key",
        to_money("transaction_amt").alias("transaction_amt"),
        to_ts("transaction_dttm").alias("transaction_dttm"),
        to_ts("create_dttm").alias("create_dttm"),
        to_ts("delete_dttm").alias("delete_dttm"),
    )


@query("staging_batch_counts")
def q_staging_batch_counts(spark, sf_dir):
    parts = [batch_counts(_staged(spark, sf_dir, b), LOAD_TS[b - 1]).withColumn("batch", F.lit(b)) for b in (1, 2)]
    return reduce(DataFrame.unionByName, parts)


@query("registry_last_load")
def q_registry_last_load(spark, sf_dir):
    st = _store(spark, sf_dir)
    names = [f"staging_{n}" for n in st.staged(2)]
    reg = st.tables.log(2).select("table_name", "load_dttm", "version_id")
    return reduce(DataFrame.unionByName, [last_load(reg, n) for n in names])


def _registry(spark, sf_dir, mode=STRICT) -> DataFrame:
    """The version registry: loads of history tables in the store's log."""
    log = _store(spark, sf_dir, mode).log()
    return log.filter(F.col("version_id").isNotNull()).select("table_name", "load_dttm", "version_id")


def _next_versions(spark, sf_dir, mode=STRICT) -> DataFrame:
    return _registry(spark, sf_dir, mode).groupBy("table_name").agg(F.max("load_dttm").alias("last_load_dttm"), (F.max("version_id") + 1).alias("next_version"))


QUERIES["registry_next_version"] = lambda spark, sf_dir: _next_versions(spark, sf_dir)
QUERIES["registry_next_version_ref"] = lambda spark, sf_dir: _next_versions(spark, sf_dir, REFERENCE)


@query("registry_epoch")
def q_registry_epoch(spark, sf_dir):
    return _registry(spark, sf_dir).withColumn("epoch_seconds", F.unix_timestamp(F.col("load_dttm").cast("timestamp")))


@query("hash_key")
def q_hash_key(spark, sf_dir):
    c = read_tables(spark, sf_dir, ["customer"])["customer"]
    return c.select("c_custkey", hash_key("c_custkey").alias("customer_hash_key"), hash_key("c_name").alias("name_hash_key"))


@query("link_hash_key")
def q_link_hash_key(spark, sf_dir):
    o = read_tables(spark, sf_dir, ["orders"])["orders"]
    return o.select("o_orderkey", composite_hash(["o_custkey", "o_orderkey"]).alias("cust_x_app_hash_key"))


@query("hash_diff")
def q_hash_diff(spark, sf_dir):
    return _all_staged(spark, sf_dir, "application").select("application_id", "product_type_nm", "hash_diff")


@query("hash_diff_variants")
def q_hash_diff_variants(spark, sf_dir):
    s = _all_staged(spark, sf_dir, "crm_customer")
    return s.select(
        "customer_id",
        "create_dttm",
        "hash_diff_con",
        md5_concat_ws(["phone_num", "email"]).alias("contact_md5"),
        md5_coalesce("first_nm").alias("first_nm_md5"),
    )


@query("self_link_key")
def q_self_link_key(spark, sf_dir):
    s = _all_staged(spark, sf_dir, "crm_transaction")
    return s.select("transaction_id", "orig_id", "orig_transaction_hash_key", "trans_x_orig_trans_hash_key")


# --- vault tables ----------------------------------------------------------


def _table_query(name: str, mode: str = STRICT) -> Query:
    return lambda spark, sf_dir: present(_store(spark, sf_dir, mode).table(name))


for _n in list(HUBS) + [x for ln in LINKS.values() for x in (ln.name, ln.lsat)] + list(SATS):
    QUERIES[_n] = _table_query(_n)

for _n in [x for ln in LINKS.values() for x in (ln.name, ln.lsat)] + list(SATS):
    QUERIES[f"{_n}_ref"] = _table_query(_n, REFERENCE)

QUERIES["lsat_two_batches"] = _table_query("lsat_acc_x_app", REFERENCE)
QUERIES["hsat_two_batches"] = _table_query("hsat_cab_customer", REFERENCE)
QUERIES["hsat_late_rows"] = _table_query("hsat_crm_customer", REFERENCE)


@query("hub_incremental")
def q_hub_incremental(spark, sf_dir):
    st = _store(spark, sf_dir)
    parts = [
        st.table(h.name).filter(F.col("load_dttm") == F.lit(LOAD_TS[1]).cast(TimestampNTZType())).select(
            F.lit(h.name).alias("hub_name"), F.col(h.key).alias("hash_key"), F.col(h.id_col).alias("business_id"), "load_dttm"
        )
        for h in HUBS.values()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("pipeline_row_counts")
def q_pipeline_row_counts(spark, sf_dir):
    st = _store(spark, sf_dir)
    names = sorted(st._done[0])
    st.vault(2, set(names))  # together: an entity is profiled once and independent tables are written at once
    return reduce(
        DataFrame.unionByName,
        [st.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in names],
    )


@query("hsat_current")
def q_hsat_current(spark, sf_dir):
    from hvault.operators.intervals import current_rows

    return present(current_rows(_store(spark, sf_dir).table("hsat_request")))


# --- history operators on the raw events table ------------------------------


def _events(spark, sf_dir):
    return read_tables(spark, sf_dir, ["events"])["events"]


def _event_intervals(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select("user_id", F.col("ts").alias("create_dttm"), (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("delete_dttm"))


# Raw events: one user may hold a large share of all rows, so the ordered
# per-user scans use the segmented (hot-key safe) forms; results equal the
# plain per-key windows (``merge_intervals``, ``close_on_next``, ``mart.as_of``).


@query("merge_intervals_lag")
def q_merge_lag(spark, sf_dir):
    return merge_intervals_segmented(_event_intervals(spark, sf_dir), "user_id", mode=REFERENCE)


@query("merge_intervals_max")
def q_merge_max(spark, sf_dir):
    return merge_intervals_segmented(_event_intervals(spark, sf_dir), "user_id", mode=STRICT)


STATE_EVENTS = ("signup", "click", "error")


def _event_states(spark, sf_dir):
    e = _events(spark, sf_dir).filter(F.col("event_type").isin(*STATE_EVENTS))
    states = next_value_segmented(
        e.select("user_id", "event_id", F.col("event_type").alias("state"), F.col("ts").alias("effective_from_dttm")),
        "user_id",
        ["effective_from_dttm", "event_id"],
        "effective_from_dttm",
        "effective_to_dttm",
    )
    return states.withColumn("effective_to_dttm", F.coalesce("effective_to_dttm", open_end()))


@query("scd2_lead")
def q_scd2_lead(spark, sf_dir):
    return present(_event_states(spark, sf_dir))


@query("asof_state")
def q_asof_state(spark, sf_dir):
    probes = _events(spark, sf_dir).filter(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")
    states = _event_states(spark, sf_dir).withColumnRenamed("event_id", "state_event_id").withColumn("state_from", F.col("effective_from_dttm"))
    return as_of_segmented(probes, states, "user_id", "ts", order=("state_event_id",), carry=("state", "state_from"))


# --- mart ------------------------------------------------------------------


def _hot_customers(spark, sf_dir, mode=STRICT) -> bool:
    """Does one customer hold a hot share of the requests (decides segmented scans)?"""
    st = _store(spark, sf_dir, mode)
    return st.key_hot("link_cust_x_req", lambda: st.table("link_cust_x_req"), "customer_hash_key")


def _ti(spark, sf_dir, mode=STRICT):
    """State intervals, keys packed: what reads them goes on joining and grouping by these."""
    st = _store(spark, sf_dir, mode)
    hot = _hot_customers(spark, sf_dir, mode)
    return mart.tail_info(st.table("link_cust_x_req"), st.table("hsat_request"), st.table("hsat_request_status"), hot, text=False)


@query("state_intervals")
def q_state_intervals(spark, sf_dir):
    return shown(_ti(spark, sf_dir))


def _txi(spark, sf_dir, mode=STRICT):
    """The transaction view, keys packed."""
    st = _store(spark, sf_dir, mode)
    st.vault(2, {"hub_transaction", "hsat_transaction", *(ln.name for ln in LINKS.values()), "hsat_request", "hsat_request_status"})
    t = st.table
    lsats = {n: t(n) for n in ("lsat_acc_x_trans", "lsat_acc_x_app", "lsat_cust_x_app")} if mode == REFERENCE else None
    return mart.transaction_info(
        t("hub_transaction"), t("hsat_transaction"), t("link_trans_x_orig_trans"), t("link_acc_x_trans"), t("link_acc_x_app"), t("link_cust_x_app"),
        _ti(spark, sf_dir, mode), lsats, mode, _hot_transaction_customers(spark, sf_dir, mode), text=False,
    )


def _hot_transaction_customers(spark, sf_dir, mode=STRICT) -> bool:
    """Does one customer hold a hot share of the transactions? (accounts per
    customer x transactions per account, from the two links)

    Keys are told apart by eight bytes: keys of one hash are counted together, so
    the largest count is never below that of a customer."""
    st = _store(spark, sf_dir, mode)

    def hashed(table, *keys):
        return st.table(table).select(*[F.xxhash64(k).alias(k) for k in keys])

    def frame():
        acc = hashed("link_acc_x_trans", "account_hash_key").groupBy("account_hash_key").agg(F.count(F.lit(1)).alias("n"))
        cust = hashed("link_acc_x_app", "account_hash_key", "application_hash_key").join(
            hashed("link_cust_x_app", "application_hash_key", "customer_hash_key"), "application_hash_key"
        ).select("account_hash_key", "customer_hash_key")
        return acc.join(cust, "account_hash_key").select("customer_hash_key", "n")

    return st.key_hot("transactions_per_customer", frame, "customer_hash_key", weight="n")


@query("transaction_enriched")
def q_transaction_enriched(spark, sf_dir):
    return shown(_txi(spark, sf_dir))


@query("transaction_enriched_ref")
def q_transaction_enriched_ref(spark, sf_dir):
    return shown(_txi(spark, sf_dir, REFERENCE))


def _one_customer(spark, sf_dir) -> DataFrame:
    """One row: the smallest customer hash key (packed) that has a request."""
    return packed(_store(spark, sf_dir).table("link_cust_x_req").agg(F.min("customer_hash_key").alias("customer_hash_key")), "customer_hash_key")


@query("state_drill_down")
def q_state_drill_down(spark, sf_dir):
    return shown(mart.drill_down(_ti(spark, sf_dir), _one_customer(spark, sf_dir)))


@query("transaction_drill_down")
def q_transaction_drill_down(spark, sf_dir):
    return shown(mart.drill_down(_txi(spark, sf_dir), _one_customer(spark, sf_dir)))


def _stored_txi(spark, sf_dir) -> DataFrame:
    """The transaction view as a table, for queries that read it more than once."""
    return _store(spark, sf_dir).view("transaction_info", lambda: _txi(spark, sf_dir))


def _violating_customers(spark, sf_dir) -> DataFrame:
    """Customers with a round-up posting above its limit (keys packed): a look-up set that grows with the data."""
    txi = _stored_txi(spark, sf_dir)
    broken = mart.limit_violations(txi, _store(spark, sf_dir).table("hsat_transaction"), text=False).select("transaction_hash_key").distinct()
    return txi.filter((F.col("transaction_type_nm") == mart.ROUND_UP_TYPE) & (F.abs("transaction_amt") > F.col("tail_limit"))).join(
        broken, "transaction_hash_key", "left_semi"
    ).select("customer_hash_key").distinct()


@query("state_drill_down_violations")
def q_state_drill_down_violations(spark, sf_dir):
    return shown(mart.drill_down(_ti(spark, sf_dir), _violating_customers(spark, sf_dir)))


@query("transaction_drill_down_violations")
def q_transaction_drill_down_violations(spark, sf_dir):
    return shown(mart.drill_down(_stored_txi(spark, sf_dir), _violating_customers(spark, sf_dir)))


@query("activation_at_date")
def q_activation_at_date(spark, sf_dir):
    return mart.activation_at_date(_ti(spark, sf_dir), "1999-06-30", 2000, hot_keys=_hot_customers(spark, sf_dir))


@query("activation_30d")
def q_activation_30d(spark, sf_dir):
    return mart.activation_grid(_ti(spark, sf_dir), step_days=30, hot_keys=_hot_customers(spark, sf_dir))


@query("activation_7d")
def q_activation_7d(spark, sf_dir):
    return mart.activation_grid(_ti(spark, sf_dir), step_days=7, hot_keys=_hot_customers(spark, sf_dir))


@query("retention_monthly")
def q_retention(spark, sf_dir):
    return mart.retention(_ti(spark, sf_dir))


def _kopylka(spark, sf_dir):
    t = _store(spark, sf_dir).table
    return mart.kopylka_monthly(
        t("hsat_cab_customer"), t("hub_customer"), t("link_cust_x_req"), t("hsat_request"), t("hsat_request_status"), hot_keys=_hot_customers(spark, sf_dir)
    )


@query("user_activity_monthly")
def q_user_activity(spark, sf_dir):
    return _kopylka(spark, sf_dir)


@query("metrics_unified")
def q_metrics_unified(spark, sf_dir):
    return mart.metrics_unified(_ti(spark, sf_dir), _kopylka(spark, sf_dir), hot_keys=_hot_customers(spark, sf_dir))


def _revenue(spark, sf_dir, mode=STRICT):
    t = _store(spark, sf_dir).table
    return mart.customer_revenue(t("hub_transaction"), t("hsat_transaction"), t("link_acc_x_trans"), t("link_acc_x_app"), t("link_cust_x_app"), t("link_cust_x_req"), mode)


@query("customer_revenue")
def q_customer_revenue(spark, sf_dir):
    return _revenue(spark, sf_dir)


@query("customer_revenue_ref")
def q_customer_revenue_ref(spark, sf_dir):
    return _revenue(spark, sf_dir, REFERENCE)


@query("revenue_by_month")
def q_revenue_by_month(spark, sf_dir):
    return mart.revenue_by_month(_revenue(spark, sf_dir))


def _churn(spark, sf_dir):
    t = _store(spark, sf_dir).table
    return mart.churn(t("link_cust_x_req"), t("hsat_request"))


def _arpu(spark, sf_dir):
    t = _store(spark, sf_dir).table
    return mart.arpu(t("hub_transaction"), t("hsat_transaction"), t("link_acc_x_trans"), t("link_acc_x_app"), t("link_cust_x_app"))


@query("churn_monthly")
def q_churn(spark, sf_dir):
    return _churn(spark, sf_dir)


@query("arpu_monthly")
def q_arpu(spark, sf_dir):
    return _arpu(spark, sf_dir)


@query("ltv_monthly")
def q_ltv(spark, sf_dir):
    return mart.ltv(_arpu(spark, sf_dir), _churn(spark, sf_dir))


@query("unbalanced_customers")
def q_unbalanced(spark, sf_dir):
    return shown(mart.unbalanced_customers(_txi(spark, sf_dir)))


@query("limit_violations")
def q_limit_violations(spark, sf_dir):
    return shown(mart.limit_violations(_txi(spark, sf_dir), _store(spark, sf_dir).table("hsat_transaction"), text=False))


@query("duplicate_versions")
def q_duplicate_versions(spark, sf_dir):
    return mart.duplicate_versions(_all_staged(spark, sf_dir, "crm_account"), "account_id")


@query("key_history")
def q_key_history(spark, sf_dir):
    st = _store(spark, sf_dir)
    hot = st.key_hot("hsat_account", lambda: st.table("hsat_account"), "account_hash_key")
    return present(mart.key_history(st.table("hsat_account"), st.table("hub_account"), "account_hash_key", "account_id", hot_keys=hot))


@query("key_history_one")
def q_key_history_one(spark, sf_dir):
    st = _store(spark, sf_dir)
    st.vault(2, {"hsat_account", "hub_account"})
    one = st.table("hub_account").orderBy("account_id").limit(1)
    return present(mart.key_history_of(st.tables, 2, "hsat_account", "hub_account", "account_id", one))


@query("key_history_resent")
def q_key_history_resent(spark, sf_dir):
    """The history of every account that the source sent more than once: only those keys' buckets are scanned."""
    st = _store(spark, sf_dir)
    st.vault(2, {"hsat_account", "hub_account"})
    resent = _all_staged(spark, sf_dir, "crm_account").groupBy("account_hash_key").count().filter(F.col("count") > 1)
    return present(mart.key_history_of(st.tables, 2, "hsat_account", "hub_account", "account_id", resent))


@query("interval_epoch")
def q_interval_epoch(spark, sf_dir):
    return mart.interval_epoch(_store(spark, sf_dir).table("hsat_account"), "account_hash_key")


@query("positive_roundups")
def q_positive_roundups(spark, sf_dir):
    t = _store(spark, sf_dir).table
    return present(mart.positive_roundups(t("hub_transaction"), t("hsat_transaction")))


@query("load_epoch")
def q_load_epoch(spark, sf_dir):
    st = _store(spark, sf_dir)
    return mart.load_epoch({h: st.table(h) for h in HUBS})


@query("roundup_amount")
def q_roundup_amount(spark, sf_dir):
    txi = _txi(spark, sf_dir)
    rows = txi.filter((F.col("tail_limit") > 0) & (F.col("transaction_amt") > 0)).select(
        "transaction_hash_key", "transaction_amt", "tail_limit", roundup_amount(F.col("transaction_amt"), F.col("tail_limit")).alias("roundup_amt")
    )
    return shown(rows)


# --- data quality ----------------------------------------------------------


def _dq_inputs(spark, sf_dir, mode=STRICT, hub=True, batch=True):
    """Per checked satellite: (table, key, hub, staged batch, hash column, hot).

    ``hub``, ``batch``: does the check read the hubs, the staged batch? (None otherwise)
    ``hot``: one key group holds more than the store's hot-key bounds (one
    memoised aggregate per table); the checks then use segmented scans."""
    from concurrent.futures import ThreadPoolExecutor

    st = _store(spark, sf_dir, mode)
    vault = st.vault(2, set(DQ_TABLES) | ({SATS[n].hub for n in DQ_TABLES} if hub else set()))
    sats = {n: vault[n] for n in DQ_TABLES}
    staged = st.staged(2, {SATS[n].staging for n in DQ_TABLES}) if batch else {}
    # the per-table profiles are small independent jobs: run them concurrently
    with ThreadPoolExecutor(max_workers=len(sats)) as pool:
        hot = dict(zip(sats, pool.map(lambda n: st.key_hot(n, lambda: sats[n], SATS[n].key), sats)))
    return {n: (sats[n], SATS[n].key, vault[SATS[n].hub] if hub else None, staged.get(SATS[n].staging), SATS[n].hash_col, hot[n]) for n in sats}


def _dq_union(spark, sf_dir, fn, hub=False, batch=False) -> DataFrame:
    from concurrent.futures import ThreadPoolExecutor

    inputs = _dq_inputs(spark, sf_dir, hub=hub, batch=batch)
    # some checks run a small job for their plan: those of all tables at once
    with ThreadPoolExecutor(max_workers=len(inputs)) as pool:
        parts = list(pool.map(lambda n: fn(*inputs[n]).withColumn("table_name", F.lit(n)), inputs))
    return present(reduce(DataFrame.unionByName, parts))


QUERIES["dq_overlap"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.overlapping_intervals(s, k, hot))
QUERIES["dq_explicit_deletion"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.explicit_deletion(s, g, k), batch=True)
QUERIES["dq_multiple_current"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.multiple_current_records(s, k))
QUERIES["dq_gaps"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.gaps_in_history(s, k, hot))
QUERIES["dq_orphans"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.referential_integrity(s, h, k), hub=True)
QUERIES["dq_invalid_interval"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.invalid_intervals(s, k))
QUERIES["dq_duplicate_keys"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.duplicate_keys(s, k))
QUERIES["dq_null_required"] = lambda spark, sf_dir: _dq_union(spark, sf_dir, lambda s, k, h, g, c, hot: dq.null_required_field(s, k, c))


def _dq_results(spark, sf_dir, mode=STRICT):
    from concurrent.futures import ThreadPoolExecutor

    inputs = _dq_inputs(spark, sf_dir, mode)
    one = lambda n, sat, key, hub, stg, h, hot: dq.table_results(sat, key, hub, stg, n, LOAD_TS[1], h, hot)
    with ThreadPoolExecutor(max_workers=len(inputs)) as pool:
        parts = list(pool.map(lambda n: one(n, *inputs[n]), inputs))
    return reduce(DataFrame.unionByName, parts)


QUERIES["dq_results"] = lambda spark, sf_dir: _dq_results(spark, sf_dir)
QUERIES["dq_results_ref"] = lambda spark, sf_dir: _dq_results(spark, sf_dir, REFERENCE)
QUERIES["dq_summary"] = lambda spark, sf_dir: dq.summary(_dq_results(spark, sf_dir))
QUERIES["dq_failures"] = lambda spark, sf_dir: dq.failures(_dq_results(spark, sf_dir, REFERENCE))



@query("upsert_interval")
def q_upsert_interval(spark, sf_dir):
    """Batch-2 account/application intervals upserted into the batch-1 link satellite (end only)."""
    from hvault.functions import open_end
    from hvault.operators.vault import upsert_interval

    st = _store(spark, sf_dir)
    target = st.vault(1, {"lsat_acc_x_app"})["lsat_acc_x_app"]
    rows = (
        st.staged(2, ["crm_account"])["crm_account"]
        .select(
            "acc_x_app_hash_key",
            to_ts("create_dttm").alias("effective_from_dttm"),
            F.coalesce(to_ts("delete_dttm"), open_end()).alias("effective_to_dttm"),
        )
        .groupBy("acc_x_app_hash_key", "effective_from_dttm")
        .agg(F.min("effective_to_dttm").alias("effective_to_dttm"))
        .select("*", F.lit(2).cast("long").alias("version_id"), F.lit("CRM").alias("src_cd"))
    )
    return present(upsert_interval(target, rows, "acc_x_app_hash_key"))

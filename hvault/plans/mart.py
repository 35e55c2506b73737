"""Mart metrics over the vault: request state intervals, activation,
retention, churn, revenue, ARPU, LTV and the balance / limit checks.

Design notes for scale:

* Date grids are parameters (bounded), never joined by range: each history
  row is mapped arithmetically to the grid points whose window contains it
  (one point when the look-back equals the step), so activation over a grid
  is one aggregate, not a per-date query or a grid x rows join.
* "present in month T and T+1" is computed without a self join: every
  (customer, month) row also emits a marker for month - 1, and one aggregate
  on (customer, month) combines them -- one shuffle, partial aggregation.
* Joins and windows exchange hash keys packed (``pack``: 16 bytes instead of
  32 characters) and give their results as text again, unless the caller takes
  them packed for its own joins (``text=False``).
* Point-in-time look-ups use ``as_of`` (union + ordered window carrying the
  latest state forward), linear per key instead of all pairs within a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType
from pyspark.sql.window import Window

from hvault.functions import MONEY, half_up_units, money_units, open_end, ratio, ts_lit, units_to_decimal
from hvault.functions.keys import FAR_END, pack, packed, unpacked

# Fixed values the mart depends on.
ACTIVE_TYPES = ("chg_round", "enable")
DISABLE = "disable"
DONE = "done"
ROUND_UP_TYPE = "kopylka"
COMMISSION = "0.01"

# Grid parameters of the test runs (the extracts span 1995-2001).
GRID_START = "1995-01-01"
GRID_END = "2001-12-31"

TI_ORDER = ("effective_from_dttm", "request_hash_key", "status_from_dttm")


def _month(c: Column) -> Column:
    return F.date_trunc("month", c).cast(DateType())


def done_requests(link_cust_x_req: DataFrame, hsat_request: DataFrame, hsat_request_status: DataFrame) -> DataFrame:
    """Request versions of each customer whose status is 'done' (every request
    version x every 'done' status version; the status is not time-matched). Keys are packed."""
    st = hsat_request_status.filter(F.col("service_request_status_nm") == DONE).select(
        pack("request_hash_key").alias("request_hash_key"), F.col("effective_from_dttm").alias("status_from_dttm")
    )
    hr = hsat_request.select(pack("request_hash_key").alias("request_hash_key"), "effective_from_dttm", "tail_limit", "service_request_type_nm")
    link = packed(link_cust_x_req.select("customer_hash_key", "request_hash_key"), "customer_hash_key", "request_hash_key")
    return link.join(hr, "request_hash_key").join(st, "request_hash_key")


def _ti_window() -> Window:
    return Window.partitionBy("customer_hash_key").orderBy(*[F.col(c).asc_nulls_last() for c in TI_ORDER])


def tail_info(link_cust_x_req: DataFrame, hsat_request: DataFrame, hsat_request_status: DataFrame, hot_keys: bool = False, text: bool = True) -> DataFrame:
    """M1: a customer's round-up setting valid from one done request to the next,
    with the previous request type. Ties on the start are ordered by request key.

    ``hot_keys``: next start and previous type come from segmented scans (no
    window over all requests of one customer)."""
    if hot_keys:
        from hvault.operators.segmented import next_value_segmented, prev_value_segmented

        dr = done_requests(link_cust_x_req, hsat_request, hsat_request_status)
        dr = next_value_segmented(dr, "customer_hash_key", TI_ORDER, "effective_from_dttm", "_next")
        dr = prev_value_segmented(dr, "customer_hash_key", TI_ORDER, "service_request_type_nm", "prev_status")
        rows = dr.select(
            "customer_hash_key",
            "request_hash_key",
            "status_from_dttm",
            "effective_from_dttm",
            F.coalesce(F.col("_next"), open_end()).alias("effective_to_dttm"),
            "tail_limit",
            "service_request_type_nm",
            "prev_status",
        )
        return unpacked(rows, "customer_hash_key", "request_hash_key") if text else rows
    w = _ti_window()
    rows = done_requests(link_cust_x_req, hsat_request, hsat_request_status).select(
        "customer_hash_key",
        "request_hash_key",
        "status_from_dttm",
        "effective_from_dttm",
        F.coalesce(F.lead("effective_from_dttm").over(w), open_end()).alias("effective_to_dttm"),
        "tail_limit",
        "service_request_type_nm",
        F.lag("service_request_type_nm").over(w).alias("prev_status"),
    )
    return unpacked(rows, "customer_hash_key", "request_hash_key") if text else rows


def with_previous_type(ti: DataFrame, hot_keys: bool = False) -> DataFrame:
    """Previous request type by end descending (computed over all rows, before any date filter).

    LEAD over (end, start, request, status start) descending is LAG over the
    same columns ascending, which the segmented scan computes for hot keys."""
    if hot_keys:
        from hvault.operators.segmented import prev_value_segmented

        return prev_value_segmented(ti, "customer_hash_key", ("effective_to_dttm", *TI_ORDER), "service_request_type_nm", "prev_type")
    w = Window.partitionBy("customer_hash_key").orderBy(
        F.col("effective_to_dttm").desc_nulls_first(), *[F.col(c).desc_nulls_first() for c in TI_ORDER]
    )
    return ti.withColumn("prev_type", F.lead("service_request_type_nm").over(w))


def _activation_flags(df: DataFrame) -> DataFrame:
    t, p = F.col("service_request_type_nm"), F.col("prev_type")
    return df.select(
        "*",
        (t.isin(*ACTIVE_TYPES) & ((p == DISABLE) | p.isNull())).alias("_act"),
        ((t == DISABLE) & p.isin(*ACTIVE_TYPES)).alias("_deact"),
    )


def activation_at_date(ti: DataFrame, calc_date: str, lookback_days: int = 2000, hot_keys: bool = False) -> DataFrame:
    """M3: activations and deactivations with a start in (date - look-back, date]."""
    d = F.lit(calc_date).cast(DateType()).cast("timestamp_ntz")
    rows = _activation_flags(with_previous_type(ti, hot_keys)).filter(
        (F.col("effective_from_dttm") <= d) & (F.col("effective_from_dttm") > d - F.make_dt_interval(F.lit(lookback_days)))
    )
    return rows.agg(
        F.lit(calc_date).cast(DateType()).alias("calc_date"),
        F.count_if("_act").cast("long").alias("activation"),
        F.count_if("_deact").cast("long").alias("deactivation"),
    )


def day_grid(spark: SparkSession, start: str, end: str, step_days: int) -> DataFrame:
    """Grid dates start, start + step, ... <= end (bounded by its parameters)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast(DateType()), F.lit(end).cast(DateType()), F.expr(f"INTERVAL {step_days} DAYS"))).alias("to_date")
    )


def activation_grid(
    ti: DataFrame, start: str = GRID_START, end: str = GRID_END, step_days: int = 30, lookback_days: int | None = None, hot_keys: bool = False
) -> DataFrame:
    """M4/M5: activation per grid date d over starts in (d - look-back, d].

    A row at time t belongs to grid index k when start + k*step >= t and
    start + k*step - look-back < t: a short range of k computed per row.
    """
    lookback_days = lookback_days or step_days
    spark = ti.sparkSession
    step_s, back_s = step_days * 86400, lookback_days * 86400
    base = F.unix_timestamp(F.lit(start).cast(DateType()).cast("timestamp"))
    diff = F.unix_timestamp(F.col("effective_from_dttm").cast("timestamp")) - base
    k_lo = F.greatest(F.ceil(diff / step_s), F.lit(0)).cast("long")
    k_hi = (F.ceil((diff + back_s) / step_s) - 1).cast("long")
    flagged = _activation_flags(with_previous_type(ti, hot_keys)).filter(F.col("_act") | F.col("_deact"))
    hits = flagged.filter(k_hi >= k_lo).select(F.explode(F.sequence(k_lo, k_hi)).alias("_k"), "_act", "_deact")
    counts = hits.groupBy("_k").agg(F.count_if("_act").alias("activation"), F.count_if("_deact").alias("deactivation"))
    grid = day_grid(spark, start, end, step_days).select(
        "to_date", F.floor(F.datediff("to_date", F.lit(start).cast(DateType())) / step_days).cast("long").alias("_k")
    )
    steps = F.floor(F.datediff(F.lit(end).cast(DateType()), F.lit(start).cast(DateType())) / step_days)
    # one row per grid date at most, bounded by the grid's parameters
    out = grid.join(F.broadcast(counts.filter(F.col("_k") <= steps)), "_k", "left")
    act = F.coalesce("activation", F.lit(0)).cast("long")
    deact = F.coalesce("deactivation", F.lit(0)).cast("long")
    return out.select(
        "to_date",
        F.date_sub("to_date", lookback_days).alias("from_date"),
        act.alias("activation"),
        deact.alias("deactivation"),
        (act - deact).alias("net_change"),
    )


def _monthly_presence(rows: DataFrame, flag: Column | None = None) -> DataFrame:
    """(customer, month, flag, next_flag): flag of the month and of the month after (NULL when absent).

    One aggregate on (customer, month) over the rows and their markers shifted one month back.
    """
    f = (flag if flag is not None else F.lit(1)).cast("int")
    cur = rows.select("customer_hash_key", "month", f.alias("_cur"), F.lit(None).cast("int").alias("_nxt"))
    nxt = rows.select(
        "customer_hash_key", F.add_months("month", -1).alias("month"), F.lit(None).cast("int").alias("_cur"), f.alias("_nxt")
    )
    return cur.unionByName(nxt).groupBy("customer_hash_key", "month").agg(F.max("_cur").alias("flag"), F.max("_nxt").alias("next_flag"))


def retention(ti: DataFrame, scale: int = 4) -> DataFrame:
    """M6: share of customers active (a non-disable request) in a month who are active the month after."""
    active = ti.filter(F.col("service_request_type_nm") != DISABLE).select(
        "customer_hash_key", _month(F.col("effective_from_dttm")).alias("month")
    )
    p = _monthly_presence(active).filter(F.col("flag").isNotNull())
    m = p.groupBy("month").agg(
        F.count(F.lit(1)).alias("total_users"), F.count_if(F.col("next_flag").isNotNull()).cast("long").alias("retained_users")
    )
    return m.select(
        F.col("month").alias("current_month"),
        "total_users",
        "retained_users",
        ratio(F.col("retained_users"), F.col("total_users"), scale).alias("retention_rate"),
    )


def month_grid(spark: SparkSession, start: str = GRID_START, end: str = GRID_END) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast(DateType()), F.lit(end).cast(DateType()), F.expr("INTERVAL 1 MONTH"))).alias("month_dt")
    ).select(_month(F.col("month_dt")).alias("month_dt"))


def _month_masks(start: Column, end: Column, lo_incl: bool, grid_start: str, grid_end: str) -> list[Column]:
    """The grid months m with start < m (or <= when lo_incl) and m < end, as bits of one or more longs (62 months each)."""
    first = _month(start)
    first = F.when((first.cast("timestamp_ntz") >= start) if lo_incl else (first.cast("timestamp_ntz") > start), first).otherwise(F.add_months(first, 1))
    last_m = _month(end)
    last = F.when(last_m.cast("timestamp_ntz") < end, last_m).otherwise(F.add_months(last_m, -1))
    year, month = int(grid_start[:4]), int(grid_start[5:7])
    place = lambda d: (F.year(d) - year) * 12 + F.month(d) - month
    one = F.lit(1).cast("long")
    out = []
    for word in range(0, _grid_months(grid_start, grid_end), WORD):
        size = min(WORD, _grid_months(grid_start, grid_end) - word)
        lo = F.least(F.greatest(place(first) - word, F.lit(0)), F.lit(size))
        hi = F.least(F.greatest(place(last) + 1 - word, F.lit(0)), F.lit(size))
        out.append(F.when(lo < hi, F.call_function("shiftleft", one, hi) - F.call_function("shiftleft", one, lo)).otherwise(F.lit(0).cast("long")))
    return out


WORD = 62  # months in one long


def _grid_months(grid_start: str, grid_end: str) -> int:
    return (int(grid_end[:4]) - int(grid_start[:4])) * 12 + int(grid_end[5:7]) - int(grid_start[5:7]) + 1


def kopylka_monthly(
    hsat_cab_customer: DataFrame,
    hub_customer: DataFrame,
    link_cust_x_req: DataFrame,
    hsat_request: DataFrame,
    hsat_request_status: DataFrame,
    grid_start: str = GRID_START,
    grid_end: str = GRID_END,
    hot_keys: bool = False,
) -> DataFrame:
    """M7: customers with a satellite version spanning the month start (strictly)
    and, among them, those whose done request valid at the month start has tail_limit > 0.

    A customer's months are bits, so a history row stays one row: one partial
    aggregate (bit_or) per side, one join on the customer, one row of counts."""
    far = ts_lit(FAR_END)
    words = range(len(range(0, _grid_months(grid_start, grid_end), WORD)))
    spans = _month_masks(F.col("effective_from_dttm"), F.coalesce(F.col("effective_to_dttm"), far), False, grid_start, grid_end)
    cab = hsat_cab_customer.select("customer_hash_key", "effective_from_dttm", "effective_to_dttm")
    active = packed(cab, "customer_hash_key").groupBy("customer_hash_key").agg(*[F.bit_or(spans[w]).alias(f"_a{w}") for w in words])
    active = active.join(packed(hub_customer.select("customer_hash_key"), "customer_hash_key"), "customer_hash_key", "left_semi")
    dr = done_requests(link_cust_x_req, hsat_request, hsat_request_status)
    if hot_keys:
        from hvault.operators.segmented import next_value_segmented

        nxt = next_value_segmented(dr, "customer_hash_key", TI_ORDER, "effective_from_dttm", "_next")
    else:
        nxt = dr.withColumn("_next", F.lead("effective_from_dttm").over(_ti_window()))
    holds = _month_masks(F.col("effective_from_dttm"), F.coalesce(F.col("_next"), open_end()), True, grid_start, grid_end)
    limited = nxt.filter(F.col("tail_limit") > 0).groupBy("customer_hash_key").agg(*[F.bit_or(holds[w]).alias(f"_l{w}") for w in words])
    both = active.join(limited, "customer_hash_key", "left")
    # customers with the same months are one row from here on; the months are laid out over that small table
    places = [f"_a{w}" for w in words]
    shapes = both.groupBy(*places, *[F.coalesce(F.col(f"_l{w}"), F.lit(0).cast("long")).alias(f"_l{w}") for w in words]).agg(F.count(F.lit(1)).alias("_n"))
    shapes = shapes.withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(_grid_months(grid_start, grid_end) - 1))))
    word = lambda side: f"element_at(array({', '.join(f'{side}{w}' for w in words)}), int(_m div {WORD}) + 1)"
    here = lambda mask: F.sum(F.expr(f"_n * (shiftright({mask}, _m % {WORD}) & 1)"))
    m = shapes.groupBy("_m").agg(here(word("_a")).alias("total_active_users"), here(f"({word('_a')} & {word('_l')})").alias("kopylka_users"))
    m = m.withColumn("month_dt", F.add_months(F.lit(grid_start).cast(DateType()), F.col("_m"))).filter(F.col("total_active_users") > 0)
    pct = (ratio(F.col("kopylka_users"), F.col("total_active_users"), 4) * 100).cast(DecimalType(18, 4))
    return m.select(
        "month_dt",
        "total_active_users",
        "kopylka_users",
        (F.col("total_active_users") - F.col("kopylka_users")).alias("not_active_user"),
        pct.alias("kopylka_usage_pct"),
    )


def activation_monthly(ti: DataFrame, hot_keys: bool = False) -> DataFrame:
    """Activation per month start d over starts in (d - 1 month, d]: each start falls in exactly one."""
    t = F.col("effective_from_dttm")
    m = _month(t)
    bucket = F.when(m.cast("timestamp_ntz") == t, m).otherwise(F.add_months(m, 1))
    flagged = _activation_flags(with_previous_type(ti, hot_keys))
    return flagged.groupBy(bucket.alias("month_dt")).agg(
        F.count_if("_act").cast("long").alias("activation"), F.count_if("_deact").cast("long").alias("deactivation")
    )


def metrics_unified(ti: DataFrame, kopylka: DataFrame, grid_start: str = GRID_START, grid_end: str = GRID_END, hot_keys: bool = False) -> DataFrame:
    """M8: month grid with activation (1-month look-back), retention (3 decimals) and round-up usage; missing = 0."""
    grid = month_grid(ti.sparkSession, grid_start, grid_end)
    lo, hi = F.lit(grid_start).cast(DateType()), F.lit(grid_end).cast(DateType())
    act = activation_monthly(ti, hot_keys)
    ret = retention(ti, 3).withColumnRenamed("current_month", "month_dt")
    out = grid
    for side in (act, ret, kopylka.select("month_dt", "kopylka_users", "kopylka_usage_pct")):
        # one row per grid month at most, bounded by the grid's parameters
        out = out.join(F.broadcast(side.filter(F.col("month_dt").between(lo, hi))), "month_dt", "left")
    z = lambda c, t="long": F.coalesce(F.col(c), F.lit(0).cast(t))
    return out.select(
        "month_dt",
        z("activation").alias("activation"),
        z("deactivation").alias("deactivation"),
        (z("activation") - z("deactivation")).alias("net_change"),
        z("total_users").alias("total_users"),
        z("retained_users").alias("retained_users"),
        z("retention_rate", "decimal(18,3)").alias("retention_rate"),
        z("kopylka_users").alias("kopylka_users"),
        z("kopylka_usage_pct", "decimal(18,4)").alias("kopylka_usage_pct"),
    )


def _account_customers(link_acc_x_app: DataFrame, link_cust_x_app: DataFrame) -> DataFrame:
    """Accounts with their customers: the two links meet before the transactions do, which then are exchanged by account only."""
    app = _keys(link_acc_x_app, "account_hash_key", "application_hash_key", "acc_x_app_hash_key")
    return app.join(_keys(link_cust_x_app, "application_hash_key", "customer_hash_key", "cust_x_app_hash_key"), "application_hash_key")


def _keys(df: DataFrame, *cols: str) -> DataFrame:
    """Hash columns of ``df``, packed."""
    return df.select(*[pack(c).alias(c) for c in cols])


def _revenue_rows(hub_transaction, hsat_transaction, link_acc_x_trans, link_acc_x_app, link_cust_x_app) -> DataFrame:
    """The commission of each positive round-up posting with its customer, keys packed.

    The postings are chosen before they meet a link, so that the links are exchanged once and few rows by account."""
    postings = hsat_transaction.filter(
        (F.col("transaction_type_nm") == ROUND_UP_TYPE)
        & (F.col("transaction_amt") > 0)
        & (F.col("transaction_dttm") >= F.col("effective_from_dttm"))
        & (F.col("transaction_dttm") < F.col("effective_to_dttm"))
    ).select(
        pack("transaction_hash_key").alias("transaction_hash_key"),
        _month(F.col("transaction_dttm")).alias("revenue_month"),
        F.round(F.col("transaction_amt") * F.lit(COMMISSION).cast(DecimalType(3, 2)), 2).cast(MONEY).alias("_rev"),
    )
    rows = postings.join(_keys(hub_transaction, "transaction_hash_key"), "transaction_hash_key").join(
        _keys(link_acc_x_trans, "transaction_hash_key", "account_hash_key"), "transaction_hash_key"
    )
    accounts = _account_customers(link_acc_x_app, link_cust_x_app).select("account_hash_key", "customer_hash_key")
    return rows.select("account_hash_key", "revenue_month", "_rev").join(accounts, "account_hash_key").select("customer_hash_key", "revenue_month", "_rev")


def customer_revenue(hub_transaction, hsat_transaction, link_acc_x_trans, link_acc_x_app, link_cust_x_app, link_cust_x_req, mode: str = "strict") -> DataFrame:
    """M9: 1 % commission on positive round-up postings per customer and month.

    reference: revenue times the customer's number of requests; strict: once.
    Requests are counted per customer, so a posting never meets each request."""
    rows = _revenue_rows(hub_transaction, hsat_transaction, link_acc_x_trans, link_acc_x_app, link_cust_x_app)
    monthly = rows.groupBy("customer_hash_key", "revenue_month").agg(F.sum("_rev").alias("_sum"))
    reqs = _keys(link_cust_x_req, "customer_hash_key").groupBy("customer_hash_key").agg(F.count(F.lit(1)).alias("_requests"))
    times = F.col("_requests").cast("decimal(18,0)") if mode == "reference" else F.lit(1).cast("decimal(18,0)")
    rows = unpacked(monthly.join(reqs, "customer_hash_key"), "customer_hash_key")
    return rows.select("customer_hash_key", "revenue_month", (F.col("_sum") * times).cast(MONEY).alias("monthly_revenue"))


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    """M13."""
    return revenue.groupBy("revenue_month").agg(F.sum("monthly_revenue").cast(MONEY).alias("revenue"))


def churn(link_cust_x_req: DataFrame, hsat_request: DataFrame) -> DataFrame:
    """Of customers active in month T (current request versions), the share
    present and inactive in T+1; absent in T+1 is not lost."""
    rows = _keys(link_cust_x_req, "customer_hash_key", "request_hash_key").join(
        packed(hsat_request.filter(F.col("effective_to_dttm") == open_end()), "request_hash_key"), "request_hash_key"
    ).select(
        "customer_hash_key",
        _month(F.col("effective_from_dttm")).alias("month"),
        F.coalesce(F.col("service_request_type_nm") != DISABLE, F.lit(False)).cast("int").alias("_a"),
    )
    p = _monthly_presence(rows, F.col("_a")).filter(F.col("flag") == 1)
    m = p.groupBy("month").agg(
        F.count(F.lit(1)).alias("customers_start"), F.count_if(F.col("next_flag") == 0).cast("long").alias("customers_lost")
    )
    rate = ratio(F.col("customers_lost"), F.col("customers_start"), 4)
    return m.select(
        F.col("month").alias("report_date"),
        "customers_start",
        "customers_lost",
        rate.alias("churn_rate"),
        F.round(rate * 100, 2).cast(DecimalType(18, 2)).alias("churn_rate_percent"),
    )


def arpu(hub_transaction, hsat_transaction, link_acc_x_trans, link_acc_x_app, link_cust_x_app) -> DataFrame:
    """Revenue per paying customer and month (no fan-out by requests)."""
    rows = _revenue_rows(hub_transaction, hsat_transaction, link_acc_x_trans, link_acc_x_app, link_cust_x_app)
    per_customer = rows.groupBy("customer_hash_key", "revenue_month").agg(F.sum("_rev").alias("_r"))
    m = per_customer.groupBy("revenue_month").agg(
        F.count(F.lit(1)).alias("paying_customers"), F.sum("_r").cast(MONEY).alias("total_revenue")
    )
    return m.select(
        F.col("revenue_month").alias("report_date"),
        "paying_customers",
        "total_revenue",
        units_to_decimal(half_up_units(money_units(F.col("total_revenue")), F.col("paying_customers"), 0), 2).alias("arpu"),
    )


def ltv(arpu_df: DataFrame, churn_df: DataFrame) -> DataFrame:
    """ARPU / running average churn over the months that have a churn rate.

    The running window has no partition key: it runs over one row per month
    (a handful), so one task is right. Ratios are exact (integer units)."""
    j = arpu_df.join(churn_df, "report_date").filter(F.col("churn_rate").isNotNull())
    w = Window.orderBy("report_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = F.sum(money_units(F.col("churn_rate"), 4)).over(w)
    n = F.count(F.lit(1)).over(w)
    a = money_units(F.col("arpu"), 2)
    return j.select(
        "report_date",
        "arpu",
        "churn_rate",
        "churn_rate_percent",
        "paying_customers",
        "total_revenue",
        "customers_start",
        "customers_lost",
        units_to_decimal(half_up_units(s * 100, n, 0), 6).alias("avg_churn_rate"),
        F.when(s > 0, units_to_decimal(half_up_units(a * n * 10000, s, 0), 2)).alias("ltv_estimate"),
    )


def transaction_info(
    hub_transaction,
    hsat_transaction,
    link_trans_x_orig_trans,
    link_acc_x_trans,
    link_acc_x_app,
    link_cust_x_app,
    ti: DataFrame,
    lsats: dict[str, DataFrame] | None = None,
    mode: str = "strict",
    hot_keys: bool = False,
    text: bool = True,
) -> DataFrame:
    """M2: transaction -> account -> application -> customer, its original
    transaction and the round-up setting valid at the transaction time.

    ``text``: have ``ti`` and the result their keys as text (else packed)?

    reference: the three link satellites are joined without a time filter and
    multiply rows; strict: they are left out (a left join matching at most one
    valid interval adds nothing)."""
    # the link satellites hang on the links, which are narrower than the transactions: they meet there
    accounts = _keys(link_acc_x_trans, "transaction_hash_key", "account_hash_key", "acc_x_trans_hash_key")
    customers = _account_customers(link_acc_x_app, link_cust_x_app)
    if mode == "reference" and lsats:
        accounts = accounts.join(_keys(lsats["lsat_acc_x_trans"], "acc_x_trans_hash_key"), "acc_x_trans_hash_key", "left")
        for name, k in (("lsat_acc_x_app", "acc_x_app_hash_key"), ("lsat_cust_x_app", "cust_x_app_hash_key")):
            customers = customers.join(_keys(lsats[name], k), k, "left")
    # accounts bring their customers along, so the wide rows are exchanged by customer only
    accounts = accounts.select("transaction_hash_key", "account_hash_key").join(customers.select("account_hash_key", "customer_hash_key"), "account_hash_key")
    df = (
        _keys(hub_transaction, "transaction_hash_key")
        .join(packed(hsat_transaction, "transaction_hash_key"), "transaction_hash_key", "left")
        .join(_keys(link_trans_x_orig_trans, "transaction_hash_key", "orig_transaction_hash_key"), "transaction_hash_key", "left")
        .join(accounts, "transaction_hash_key")
    )
    df = df.select(
        "transaction_hash_key",
        "orig_transaction_hash_key",
        "account_hash_key",
        "customer_hash_key",
        "transaction_amt",
        "transaction_type_nm",
        "transaction_dttm",
        "effective_from_dttm",
        "effective_to_dttm",
    )
    hist = ti.select(
        "customer_hash_key", "effective_from_dttm", "effective_to_dttm", "request_hash_key", "status_from_dttm", "tail_limit", "service_request_type_nm"
    )
    hist = packed(hist, "customer_hash_key", "request_hash_key") if text else hist
    look_up = as_of
    if hot_keys:
        # one customer holds a large share of the transactions: segmented scan
        from hvault.operators.segmented import as_of_segmented as look_up

    rows = look_up(df, hist, "customer_hash_key", "transaction_dttm", order=TI_ORDER[1:], carry=("tail_limit", "service_request_type_nm"))
    return unpacked(rows, "transaction_hash_key", "orig_transaction_hash_key", "account_hash_key", "customer_hash_key") if text else rows


def as_of(
    probes: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    start: str = "effective_from_dttm",
    end: str = "effective_to_dttm",
    order: tuple[str, ...] = (),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Left as-of join: each probe gets ``carry`` columns of the latest history row
    of its key with start <= at, if at < that row's end.

    History rows must not overlap per key (true for intervals built with LEAD
    or merged intervals). Implemented as a union ordered by (key, time) with
    the last history row carried forward -- linear in the rows of a key, no
    pairs within a key.
    """
    pcols = probes.columns
    h = history.select(
        F.col(key),
        F.col(start).alias("_t"),
        F.lit(0).alias("_probe"),
        *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(order)],
        F.struct(F.col(end).alias("_end"), *[F.col(c) for c in carry]).alias("_h"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in pcols if c != key],
    )
    p = probes.select(
        F.col(key),
        F.col(at).alias("_t"),
        F.lit(1).alias("_probe"),
        *[F.lit(None).cast(history.schema[c].dataType).alias(f"_o_{i}") for i, c in enumerate(order)],
        F.lit(None).cast(h.schema["_h"].dataType).alias("_h"),
        *[F.col(c) for c in pcols if c != key],
    )
    w = Window.partitionBy(key).orderBy(
        F.col("_t").asc_nulls_last(), F.col("_probe").asc(), *[F.col(f"_o_{i}").asc_nulls_last() for i in range(len(order))]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = h.unionByName(p).withColumn("_last", F.last("_h", ignorenulls=True).over(w)).filter(F.col("_probe") == 1)
    valid = F.col("_t").isNotNull() & (F.col("_t") < F.col("_last._end"))
    return u.select(*[F.col(c) for c in pcols], *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in carry])


def unbalanced_customers(txi: DataFrame) -> DataFrame:
    """Customers whose round-up postings do not sum to zero (rounded to units)."""
    return (
        txi.filter(F.col("transaction_type_nm") == ROUND_UP_TYPE)
        .groupBy("customer_hash_key")
        .agg(F.sum("transaction_amt").cast(MONEY).alias("sum_amt"))
        .filter(F.round("sum_amt", 0) != 0)
    )


def limit_violations(txi: DataFrame, hsat_transaction: DataFrame, text: bool = True) -> DataFrame:
    """Round-up postings larger than the tail limit, with their original transaction.

    ``text``: have ``txi`` and the result their keys as text (else packed)?"""
    ht = hsat_transaction.select(pack("transaction_hash_key").alias("orig_transaction_hash_key"), F.col("transaction_amt").alias("orig_transaction_amt"))
    broken = txi.filter((F.col("transaction_type_nm") == ROUND_UP_TYPE) & (F.abs("transaction_amt") > F.col("tail_limit")))
    broken = broken.select("orig_transaction_hash_key", "transaction_hash_key", "transaction_amt", "tail_limit")
    keys = ("orig_transaction_hash_key", "transaction_hash_key") if text else ()
    return unpacked(packed(broken, *keys).join(ht, "orig_transaction_hash_key"), *keys).select(
        "orig_transaction_hash_key", "transaction_hash_key", "orig_transaction_amt", "transaction_amt", "tail_limit"
    )


def duplicate_versions(staged: DataFrame, id_col: str) -> DataFrame:
    """Source rows sent twice for one (id, start)."""
    return staged.groupBy(id_col, "create_dttm").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def key_history(hsat: DataFrame, hub: DataFrame, key: str, id_col: str, hot_keys: bool = False) -> DataFrame:
    """Version history per business id, newest first (rank 1 = newest).

    ``hot_keys``: the rank is a segmented count (no window over a whole key)."""
    df = hsat.join(hub.select(key, id_col), key)
    if hot_keys:
        from hvault.operators.segmented import row_number_segmented

        return row_number_segmented(df, key, ["effective_from_dttm"], "version_rank", descending=True)
    w = Window.partitionBy(key).orderBy(F.col("effective_from_dttm").desc_nulls_first())
    return df.withColumn("version_rank", F.row_number().over(w))


def key_history_of(store, batch: int, hsat: str, hub: str, id_col: str, keys: DataFrame) -> DataFrame:
    """M17 for a set of hash keys (a column of ``keys`` named like the table's key): the stored tables are scanned in those keys' buckets only."""
    from hvault.plans.pipeline import table_specs

    specs = table_specs()
    key = specs[hsat][1]
    return key_history(*[store.read_keys(t, specs[t][0], batch, keys, key) for t in (hsat, hub)], key, id_col)


def positive_roundups(hub_transaction: DataFrame, hsat_transaction: DataFrame) -> DataFrame:
    """Round-up postings with a positive amount (should not exist)."""
    hub = hub_transaction.select("transaction_hash_key", "transaction_id")
    return hub.join(hsat_transaction.drop("src_cd"), "transaction_hash_key").filter(
        (F.col("transaction_type_nm") == ROUND_UP_TYPE) & (F.col("transaction_amt") > 0)
    )


def drill_down(view: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a transaction or state view for the hash keys in ``keys`` (one column named like the view's key)."""
    return view.join(keys, keys.columns, "left_semi").select(*view.columns)


def interval_epoch(history: DataFrame, key: str) -> DataFrame:
    """Interval bounds as epoch seconds; the open end has none."""
    epoch = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    to = F.when(F.col("effective_to_dttm") < open_end(), epoch("effective_to_dttm"))
    return history.select(key, "version_id", epoch("effective_from_dttm").alias("from_epoch"), to.alias("to_epoch"))


def load_epoch(hubs: dict[str, DataFrame]) -> DataFrame:
    """Load times of the hubs as epoch seconds, with the rows each load inserted."""
    from functools import reduce

    parts = [df.groupBy("load_dttm").agg(F.count(F.lit(1)).alias("rows_loaded")).select(F.lit(n).alias("table_name"), "load_dttm", "rows_loaded") for n, df in hubs.items()]
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "load_dttm", F.unix_timestamp(F.col("load_dttm").cast("timestamp")).alias("epoch_seconds"), "rows_loaded"
    )

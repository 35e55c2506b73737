"""Derive the bank's 13 extract entities from the driver's test tables.

Each entity is a string-typed DataFrame with the catalogue's columns, so
every later operator runs the real warehouse model on data that grows with
the test tables. Record versions (re-sent rows with a deletion date, second
versions, rows with the same start) are generated in one pass per table by
exploding an array of optional versions -- one scan, no self-union.

Rules (all per row, deterministic):

* cab_customer  <- customer: created 1995-01-01 + key % 365 days; every 3rd key
  gets a second version on 1998-01-01 and its first version is re-sent with
  that deletion date; every 10th key has its latest version deleted (re-sent).
* crm_customer  <- customer: created 1995-03-01 + key % 365 days; every 4th key
  gets a second version on 1999-01-01, the first one is *not* re-sent.
* application, service_request <- orders (one row per order).
* crm_account   <- orders; finished orders ('F') are re-sent with the same
  start and a deletion 365 days later.
* crm_transaction <- lineitem, one row per (order, line number): the earliest
  shipment; its original is the lowest line of the order.
* advert_source <- supplier.
* six reference lists <- distinct codes of orders / lineitem.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hvault.functions.keys import MONEY, ts_text
from hvault.sources.catalogue import CATALOGUE

# Code -> name of the reference lists the mart depends on.
TRANSACTION_TYPES = {"R": "kopylka", "A": "purchase", "N": "transfer"}
REQUEST_TYPES = {"O": "enable", "P": "chg_round", "F": "disable"}
REQUEST_STATUSES = {"D": "done", "N": "new"}
ACCOUNT_STATUSES = {"F": "closed", "O": "open", "P": "pending"}
NOT_SPECIFIED_PRIORITY = "4-NOT SPECIFIED"
REF_LAST_UPDATE = "1995-01-01 00:00:00"
SECOND_CAB_VERSION = "1998-01-01 00:00:00"
SECOND_CRM_VERSION = "1999-01-01 00:00:00"
CAB_DELETION = "2001-01-01 00:00:00"

TABLES = ("customer", "orders", "lineitem", "supplier")


def read_tables(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _mapped(code: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr


def _versions(df: DataFrame, base: dict[str, Column], variants: list[tuple[Column | None, dict[str, Column]]], entity: str) -> DataFrame:
    """One output row per variant whose condition holds; variant values override ``base``."""
    cols = CATALOGUE[entity].columns
    structs = []
    for cond, override in variants:
        values = {**base, **override}
        fields = [values.get(c, F.lit(None)).cast("string").alias(c) for c in cols]
        if len(variants) == 1 and cond is None:
            return df.select(*fields)
        s = F.struct(*fields, F.lit(True).alias("_is"))
        structs.append(s if cond is None else F.when(cond, s))
    # a variant that does not hold is a row of NULLs; dropping it behind the generator keeps the stage compiled
    return df.select(F.inline(F.array(*structs))).filter("_is").select(*cols)


def _day_text(start: str, days: Column) -> Column:
    return ts_text(F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(days))


def cab_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    created = _day_text("1995-01-01 00:00:00", k % 365)
    base = {
        "customer_id": k,
        "birth_dt": F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (k % 15000).cast("int")), "yyyy-MM-dd"),
        "passport_num": F.concat(F.lit("P"), k),
        "phone_num": F.concat(F.lit("+"), F.col("c_nationkey"), F.lit("-"), k),
        "email": F.concat(F.lit("c"), k, F.lit("@mail.test")),
        "reg_address_txt": F.concat(F.lit("nation "), F.col("c_nationkey")),
        "first_nm": F.col("c_name"),
        "last_nm": F.col("c_mktsegment"),
        "create_dttm": created,
        "last_update": created,
    }
    second = {
        "last_nm": F.concat(F.col("c_mktsegment"), F.lit("-2")),
        "phone_num": F.concat(F.lit("+"), F.col("c_nationkey"), F.lit("-"), k, F.lit("-2")),
        "create_dttm": F.lit(SECOND_CAB_VERSION),
        "last_update": F.lit(SECOND_CAB_VERSION),
    }
    first_deleted = _day_text("1995-01-01 00:00:00", k % 365 + 1095)
    return _versions(
        customer,
        base,
        [
            (None, {}),
            (k % 3 == 0, {"delete_dttm": F.lit(SECOND_CAB_VERSION), "last_update": F.lit(SECOND_CAB_VERSION)}),
            (k % 3 == 0, second),
            ((k % 10 == 0) & (k % 3 == 0), {**second, "delete_dttm": F.lit(CAB_DELETION), "last_update": F.lit(CAB_DELETION)}),
            ((k % 10 == 0) & (k % 3 != 0), {"delete_dttm": first_deleted, "last_update": first_deleted}),
        ],
        "cab_customer",
    )


def crm_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    created = _day_text("1995-03-01 00:00:00", k % 365)
    base = {
        "crm_customer_id": F.concat(F.lit("C"), k),
        "customer_id": k,
        "birth_dt": F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (k % 15000).cast("int")), "yyyy-MM-dd"),
        "phone_num": F.concat(F.lit("+"), F.col("c_nationkey"), F.lit("-"), k),
        "email": F.concat(F.lit("c"), k, F.lit("@mail.test")),
        "first_nm": F.col("c_name"),
        "last_nm": F.col("c_mktsegment"),
        "create_dttm": created,
        "last_update": created,
    }
    second = {
        "email": F.concat(F.lit("c"), k, F.lit("@bank.test")),
        "last_nm": F.concat(F.col("c_mktsegment"), F.lit("-crm")),
        "create_dttm": F.lit(SECOND_CRM_VERSION),
        "last_update": F.lit(SECOND_CRM_VERSION),
    }
    return _versions(customer, base, [(None, {}), (k % 4 == 0, second)], "crm_customer")


def application(orders: DataFrame) -> DataFrame:
    created = ts_text(F.col("o_orderdate"))
    return _versions(
        orders,
        {
            "application_id": F.col("o_orderkey"),
            "product_type_cd": F.substring("o_orderpriority", 1, 1),
            "customer_id": F.col("o_custkey"),
            "advert_source_id": F.col("o_orderkey") % 10,
            "create_dttm": created,
            "last_update": created,
        },
        [(None, {})],
        "application",
    )


def crm_account(orders: DataFrame) -> DataFrame:
    created = ts_text(F.col("o_orderdate"))
    deleted = ts_text(F.col("o_orderdate") + F.make_dt_interval(F.lit(365)))
    return _versions(
        orders,
        {
            "account_id": F.concat(F.lit("A"), F.col("o_orderkey")),
            "account_type_cd": F.substring("o_orderpriority", 1, 1),
            "account_create_dt": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "account_status_cd": F.col("o_orderstatus"),
            "application_id": F.col("o_orderkey"),
            "create_dttm": created,
            "last_update": created,
        },
        [(None, {}), (F.col("o_orderstatus") == "F", {"delete_dttm": deleted, "last_update": deleted})],
        "crm_account",
    )


def crm_transaction(lineitem: DataFrame, hot_orders: bool = True) -> DataFrame:
    """``hot_orders``: may one order hold a large share of the lines? If not, one exchange by order serves both steps."""
    # One row per (order, line): the earliest shipment, as a partial
    # aggregate (combined map-side, so a hot order is reduced before its
    # shuffle). The original is the order's lowest line: a second partial
    # aggregate joined back on the order key (a skewed join that AQE can split).
    shipment = F.min(F.struct("l_shipdate", "l_extendedprice", "l_returnflag", "l_linestatus")).alias("m")
    if hot_orders:
        line = lineitem.groupBy("l_orderkey", "l_linenumber").agg(shipment)
        first = lineitem.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("_first_line"))
        line = line.join(first, "l_orderkey")
    else:
        rows = lineitem.filter(F.col("l_orderkey").isNotNull()).repartition("l_orderkey")
        line = rows.groupBy("l_orderkey", "l_linenumber").agg(shipment)
        line = line.withColumn("_first_line", F.min("l_linenumber").over(Window.partitionBy("l_orderkey")))
    first_line = F.col("_first_line")
    amount = F.col("m.l_extendedprice").cast(MONEY)
    signed = F.when(F.col("m.l_linestatus") == "F", -amount).otherwise(amount).cast(MONEY)
    shipped = ts_text(F.col("m.l_shipdate"))
    return _versions(
        line,
        {
            "transaction_id": F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")),
            "orig_id": F.concat_ws("-", F.col("l_orderkey"), first_line),
            "account_id": F.concat(F.lit("A"), F.col("l_orderkey")),
            "transaction_type_cd": F.col("m.l_returnflag"),
            "transaction_amt": signed,
            "transaction_dttm": shipped,
            "create_dttm": shipped,
            "last_update": shipped,
        },
        [(None, {})],
        "crm_transaction",
    )


def service_request(orders: DataFrame) -> DataFrame:
    created = ts_text(F.col("o_orderdate"))
    return _versions(
        orders,
        {
            "service_request_id": F.concat(F.lit("R"), F.col("o_orderkey")),
            "customer_id": F.col("o_custkey"),
            "service_request_type_cd": F.col("o_orderstatus"),
            "service_request_status_cd": F.when(F.col("o_orderpriority") == NOT_SPECIFIED_PRIORITY, "N").otherwise("D"),
            "tail_limit": F.floor(F.col("o_totalprice") / 1000).cast("long"),
            "create_dttm": created,
            "last_update": created,
        },
        [(None, {})],
        "service_request",
    )


def advert_source(supplier: DataFrame) -> DataFrame:
    return _versions(
        supplier,
        {
            "advert_source_id": F.col("s_suppkey"),
            "advert_source_nm": F.col("s_name"),
            "monthly_payment_amt": F.col("s_acctbal").cast(MONEY),
            "start_month": F.lit("1995-01"),
            "create_dttm": F.lit(REF_LAST_UPDATE),
            "last_update": F.lit(REF_LAST_UPDATE),
        },
        [(None, {})],
        "advert_source",
    )


def _ref(df: DataFrame, code: Column, name: Column, entity: str) -> DataFrame:
    cd_col, nm_col, lu_col = CATALOGUE[entity].columns
    return (
        df.select(code.alias(cd_col))
        .distinct()
        .select(cd_col, name.alias(nm_col), F.lit(REF_LAST_UPDATE).alias(lu_col))
    )


def reference_lists(orders: DataFrame, lineitem: DataFrame) -> dict[str, DataFrame]:
    prio = F.col("o_orderpriority")
    cd = F.col
    return {
        "product_type": orders.select(
            F.substring(prio, 1, 1).alias("product_type_cd"),
            F.lower(F.substring(prio, 3, 100)).alias("product_type_nm"),
        )
        .distinct()
        .select("product_type_cd", "product_type_nm", F.lit(REF_LAST_UPDATE).alias("last_update")),
        "crm_account_status_type": orders.select(
            F.substring(prio, 1, 1).alias("account_type_cd"),
            F.concat(F.lit("acc "), F.lower(F.substring(prio, 3, 100))).alias("account_type_nm"),
        )
        .distinct()
        .select("account_type_cd", "account_type_nm", F.lit(REF_LAST_UPDATE).alias("last_update")),
        "crm_account_status": _ref(orders, cd("o_orderstatus"), _mapped(cd("account_status_cd"), ACCOUNT_STATUSES), "crm_account_status"),
        "crm_transaction_type": _ref(lineitem, cd("l_returnflag"), _mapped(cd("transaction_type_cd"), TRANSACTION_TYPES), "crm_transaction_type"),
        "service_request_type": _ref(orders, cd("o_orderstatus"), _mapped(cd("service_request_type_cd"), REQUEST_TYPES), "service_request_type"),
        "service_request_status": _ref(
            orders,
            F.when(prio == NOT_SPECIFIED_PRIORITY, "N").otherwise("D"),
            _mapped(cd("service_request_status_cd"), REQUEST_STATUSES),
            "service_request_status",
        ),
    }


def profiled_transactions(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    """``crm_transaction`` by the plan that the largest order allows, bounded by the rows of its hash cell (a scan of one column)."""
    from hvault.plans.bucket_store import key_profiles

    lineitem = read_tables(spark, sf_dir, ["lineitem"])["lineitem"]
    return crm_transaction(lineitem, key_profiles(lineitem, ["l_orderkey"], 1)["l_orderkey"].top > hot_rows)


def derive_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = read_tables(spark, sf_dir)
    out = {
        "advert_source": advert_source(t["supplier"]),
        "application": application(t["orders"]),
        "cab_customer": cab_customer(t["customer"]),
        "crm_account": crm_account(t["orders"]),
        "crm_customer": crm_customer(t["customer"]),
        "crm_transaction": crm_transaction(t["lineitem"]),
        "service_request": service_request(t["orders"]),
    }
    out.update(reference_lists(t["orders"], t["lineitem"]))
    return out

"""DuckDB oracle: the same queries written as plain SQL over the test tables.

Every query is a chain of CTEs (source adaptor -> staging windows -> hubs,
links and satellites of batch 1 and 2 -> mart / checks) written directly from
the operator definitions, with the straightforward SQL formulation (range
joins, self joins, per-date evaluation) rather than the Spark plans'
rewrites. The CTEs a query needs are collected from the text of its SELECT.
"""

from __future__ import annotations

import re

from hvault.oracle_model import DQ_TABLES, HUBS, LINKS, SATS, STAGING
from hvault.plans.pipeline import LOAD_TS, WINDOWS
from hvault.sources.adaptor import (
    ACCOUNT_STATUSES,
    CAB_DELETION,
    NOT_SPECIFIED_PRIORITY,
    REF_LAST_UPDATE,
    REQUEST_STATUSES,
    REQUEST_TYPES,
    SECOND_CAB_VERSION,
    SECOND_CRM_VERSION,
    TRANSACTION_TYPES,
)
from hvault.sources.catalogue import CATALOGUE, REFERENCE_LISTS

OPEN = "TIMESTAMP '2999-12-31 00:00:00'"
LOW = "TIMESTAMP '1900-01-01 00:00:00'"
FAR = "TIMESTAMP '9999-12-31 00:00:00'"
FMT = "'%Y-%m-%d %H:%M:%S'"

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def txt(x: str) -> str:
    return f"strftime({x}, {FMT})"


def ts(x: str) -> str:
    return f"CAST(NULLIF({x}, '') AS TIMESTAMP)"


def hk(x: str) -> str:
    return f"upper(md5(upper(trim(coalesce({x}, '')))))"


def ch(cols) -> str:
    parts = ", ".join(f"trim(coalesce({c}, ''))" for c in cols)
    return f"upper(md5(upper(concat_ws(':', {parts}))))"


def case_map(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} END"


def dec(units: str, s: int) -> str:
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * CAST('{10 ** -s:.{s}f}' AS DECIMAL(18,{s})) AS DECIMAL(18,{s}))"


def half_up(num: str, den: str, s: int) -> str:
    return f"((CAST({num} AS BIGINT) * {2 * 10 ** s} + CAST({den} AS BIGINT)) // NULLIF(CAST({den} AS BIGINT) * 2, 0))"


def rate(num: str, den: str, s: int) -> str:
    return dec(half_up(num, den, s), s)


def tsl(v: str) -> str:
    return f"TIMESTAMP '{v}'"


# --- source adaptor ----------------------------------------------------------

def _days(start: str, days: str) -> str:
    return txt(f"(TIMESTAMP '{start}' + to_days(CAST({days} AS INTEGER)))")


cte("cab_base", f"""
SELECT c_custkey AS k, c_nationkey AS nat, c_mktsegment AS seg,
  CAST(c_custkey AS VARCHAR) AS customer_id,
  strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d') AS birth_dt,
  concat('P', c_custkey) AS passport_num,
  concat('+', c_nationkey, '-', c_custkey) AS phone_num,
  CAST(NULL AS VARCHAR) AS add_phone_num,
  concat('c', c_custkey, '@mail.test') AS email,
  concat('nation ', c_nationkey) AS reg_address_txt,
  CAST(NULL AS VARCHAR) AS fact_address_txt,
  c_name AS first_nm, c_mktsegment AS last_nm, CAST(NULL AS VARCHAR) AS middle_nm,
  {_days('1995-01-01 00:00:00', 'c_custkey % 365')} AS created,
  {_days('1995-01-01 00:00:00', 'c_custkey % 365 + 1095')} AS first_deleted
FROM customer""")

_CAB = "customer_id, birth_dt, passport_num, {phone} AS phone_num, add_phone_num, email, reg_address_txt, fact_address_txt, first_nm, {last} AS last_nm, middle_nm"
_v1 = _CAB.format(phone="phone_num", last="last_nm")
_v2 = _CAB.format(phone="concat('+', nat, '-', k, '-2')", last="concat(seg, '-2')")
cte("src_cab_customer", f"""
SELECT {_v1}, created AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, created AS last_update FROM cab_base
UNION ALL SELECT {_v1}, created, '{SECOND_CAB_VERSION}', '{SECOND_CAB_VERSION}' FROM cab_base WHERE k % 3 = 0
UNION ALL SELECT {_v2}, '{SECOND_CAB_VERSION}', NULL, '{SECOND_CAB_VERSION}' FROM cab_base WHERE k % 3 = 0
UNION ALL SELECT {_v2}, '{SECOND_CAB_VERSION}', '{CAB_DELETION}', '{CAB_DELETION}' FROM cab_base WHERE k % 10 = 0 AND k % 3 = 0
UNION ALL SELECT {_v1}, created, first_deleted, first_deleted FROM cab_base WHERE k % 10 = 0 AND k % 3 <> 0""")

cte("src_crm_customer", f"""
WITH b AS (
  SELECT c_custkey AS k, concat('C', c_custkey) AS crm_customer_id, CAST(c_custkey AS VARCHAR) AS customer_id,
    strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d') AS birth_dt,
    concat('+', c_nationkey, '-', c_custkey) AS phone_num, c_name AS first_nm, c_mktsegment AS seg,
    {_days('1995-03-01 00:00:00', 'c_custkey % 365')} AS created
  FROM customer)
SELECT crm_customer_id, customer_id, birth_dt, phone_num, concat('c', k, '@mail.test') AS email, first_nm, seg AS last_nm,
  created AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, created AS last_update FROM b
UNION ALL
SELECT crm_customer_id, customer_id, birth_dt, phone_num, concat('c', k, '@bank.test'), first_nm, concat(seg, '-crm'),
  '{SECOND_CRM_VERSION}', NULL, '{SECOND_CRM_VERSION}' FROM b WHERE k % 4 = 0""")

cte("src_application", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS application_id, substr(o_orderpriority, 1, 1) AS product_type_cd,
  CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey % 10 AS VARCHAR) AS advert_source_id,
  {txt('o_orderdate')} AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, {txt('o_orderdate')} AS last_update
FROM orders""")

_acc = "concat('A', o_orderkey) AS account_id, substr(o_orderpriority, 1, 1) AS account_type_cd, strftime(o_orderdate, '%Y-%m-%d') AS account_create_dt, o_orderstatus AS account_status_cd, CAST(o_orderkey AS VARCHAR) AS application_id"
cte("src_crm_account", f"""
SELECT {_acc}, {txt('o_orderdate')} AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, {txt('o_orderdate')} AS last_update FROM orders
UNION ALL
SELECT {_acc}, {txt('o_orderdate')}, {txt('o_orderdate + INTERVAL 365 DAY')}, {txt('o_orderdate + INTERVAL 365 DAY')} FROM orders WHERE o_orderstatus = 'F'""")

cte("src_crm_transaction", f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_extendedprice, l_returnflag, l_linestatus) AS rn
  FROM lineitem),
lines AS (SELECT *, MIN(l_linenumber) OVER (PARTITION BY l_orderkey) AS first_line FROM ranked WHERE rn = 1)
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS transaction_id,
  concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(first_line AS VARCHAR)) AS orig_id,
  concat('A', l_orderkey) AS account_id, l_returnflag AS transaction_type_cd,
  CAST(CASE WHEN l_linestatus = 'F' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS VARCHAR) AS transaction_amt,
  {txt('l_shipdate')} AS transaction_dttm, {txt('l_shipdate')} AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, {txt('l_shipdate')} AS last_update
FROM lines""")

cte("src_service_request", f"""
SELECT concat('R', o_orderkey) AS service_request_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  o_orderstatus AS service_request_type_cd,
  CASE WHEN o_orderpriority = '{NOT_SPECIFIED_PRIORITY}' THEN 'N' ELSE 'D' END AS service_request_status_cd,
  CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS tail_limit,
  {txt('o_orderdate')} AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, {txt('o_orderdate')} AS last_update
FROM orders""")

cte("src_advert_source", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS advert_source_id, s_name AS advert_source_nm,
  CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS monthly_payment_amt, '1995-01' AS start_month,
  CAST(NULL AS VARCHAR) AS end_month, '{REF_LAST_UPDATE}' AS create_dttm, CAST(NULL AS VARCHAR) AS delete_dttm, '{REF_LAST_UPDATE}' AS last_update
FROM supplier""")

cte("src_product_type", f"""
SELECT DISTINCT substr(o_orderpriority, 1, 1) AS product_type_cd, lower(substr(o_orderpriority, 3, 100)) AS product_type_nm, '{REF_LAST_UPDATE}' AS last_update FROM orders""")
cte("src_crm_account_status_type", f"""
SELECT DISTINCT substr(o_orderpriority, 1, 1) AS account_type_cd, concat('acc ', lower(substr(o_orderpriority, 3, 100))) AS account_type_nm, '{REF_LAST_UPDATE}' AS last_update FROM orders""")
cte("src_crm_account_status", f"""
SELECT account_status_cd, {case_map('account_status_cd', ACCOUNT_STATUSES)} AS account_status_nm, '{REF_LAST_UPDATE}' AS last_update
FROM (SELECT DISTINCT o_orderstatus AS account_status_cd FROM orders)""")
cte("src_crm_transaction_type", f"""
SELECT transaction_type_cd, {case_map('transaction_type_cd', TRANSACTION_TYPES)} AS transaction_type_nm, '{REF_LAST_UPDATE}' AS last_update
FROM (SELECT DISTINCT l_returnflag AS transaction_type_cd FROM lineitem)""")
cte("src_service_request_type", f"""
SELECT service_request_type_cd, {case_map('service_request_type_cd', REQUEST_TYPES)} AS service_request_type_nm, '{REF_LAST_UPDATE}' AS last_update
FROM (SELECT DISTINCT o_orderstatus AS service_request_type_cd FROM orders)""")
cte("src_service_request_status", f"""
SELECT service_request_status_cd, {case_map('service_request_status_cd', REQUEST_STATUSES)} AS service_request_status_nm, '{REF_LAST_UPDATE}' AS last_update
FROM (SELECT DISTINCT CASE WHEN o_orderpriority = '{NOT_SPECIFIED_PRIORITY}' THEN 'N' ELSE 'D' END AS service_request_status_cd FROM orders)""")


# --- staging -------------------------------------------------------------------

def _stage_sql(entity: str, lo: str | None, hi: str | None) -> str:
    spec = STAGING[entity]
    cols = CATALOGUE[entity].columns
    sel = [f"{hk('s.' + idc)} AS {h}" for h, idc in spec.keys.items()]
    sel += [f"CASE WHEN s.{r} <> s.{o} THEN {hk('s.' + r)} END AS {h}" for h, (r, o) in spec.optional_keys.items()]
    sel += [f"{ch(['s.' + c for c in cs])} AS {h}" for h, cs in spec.links.items()]
    sel += [f"s.{c} AS {c}" for c in cols]
    qual = {c: f"s.{c}" for c in cols}
    for lk in spec.lookups:
        qual[lk.name] = f"r_{lk.ref}.{lk.name}"
    sel += [f"{ch([qual[c] for c in cs])} AS {h}" for h, cs in spec.hash_diffs.items()]
    sel += [f"r_{lk.ref}.{lk.name} AS {lk.name}" for lk in spec.lookups]
    joins = "".join(f"\n  LEFT JOIN src_{lk.ref} r_{lk.ref} ON s.{lk.code} = r_{lk.ref}.{lk.code}" for lk in spec.lookups)
    return (
        f"SELECT {', '.join(sel)}\nFROM src_{entity} s{joins}\n"
        f"WHERE {ts('s.last_update')} >= {tsl(lo) if lo else LOW} AND {ts('s.last_update')} < {tsl(hi) if hi else OPEN}"
    )


for _b, (_lo, _hi) in enumerate(WINDOWS, start=1):
    for _e in STAGING:
        cte(f"stg_{_e}_{_b}", _stage_sql(_e, _lo, _hi))
for _e in STAGING:
    cte(f"stg_{_e}_all", f"SELECT * FROM stg_{_e}_1 UNION ALL SELECT * FROM stg_{_e}_2")


# --- interval merge ------------------------------------------------------------

def merge_sql(prefix: str, source: str, key: str, mode: str) -> str:
    """Register the merged intervals of ``source`` as ``prefix`` (key, create_dttm, delete_dttm).

    An island begins where the intervals before do not reach (``reference``: where the one before does not); an
    interval belongs to the last beginning that is not after it."""
    cte(f"{prefix}_placed", f"""
SELECT {key} AS k, create_dttm AS s, COALESCE(delete_dttm, {OPEN}) AS e, row_number() OVER by_start AS place
FROM {source} WHERE create_dttm IS NOT NULL WINDOW by_start AS (PARTITION BY {key} ORDER BY create_dttm, COALESCE(delete_dttm, {OPEN}))""")
    reached = "earlier.place = late.place - 1" if mode == "reference" else "earlier.place < late.place"
    cte(f"{prefix}_begins", f"""
SELECT DISTINCT k, s FROM {prefix}_placed late
WHERE NOT EXISTS (FROM {prefix}_placed earlier WHERE earlier.k = late.k AND {reached} AND earlier.e >= late.s)""")
    cte(prefix, f"""
SELECT i.k AS {key}, b.s AS create_dttm, CASE WHEN bool_or(i.e = {OPEN}) THEN NULL ELSE max(i.e) END AS delete_dttm
FROM {prefix}_placed i ASOF JOIN {prefix}_begins b ON b.k = i.k AND b.s <= i.s GROUP BY i.k, b.s""")
    return prefix


# --- vault ---------------------------------------------------------------------

MODES = {"s": "strict", "r": "reference"}


def _hub_ctes() -> None:
    for h in HUBS.values():
        extra = ", CAST(NULL AS VARCHAR) AS crm_customer_id" if h.extra else ""
        for b in (1, 2):
            cands = " UNION ALL ".join(f"SELECT {k} AS key, {i} AS id FROM stg_{e}_{b}" for e, k, i in h.sources)
            new = (
                f"SELECT key AS {h.key}, MIN(id) AS {h.id_col}{extra}, {tsl(LOAD_TS[b - 1])} AS load_dttm, '{h.src_cd}' AS src_cd "
                f"FROM ({cands}) c WHERE key IS NOT NULL"
            )
            if b == 1:
                cte(f"{h.name}_1", new + " GROUP BY key")
            else:
                cte(f"{h.name}_2", f"SELECT * FROM {h.name}_1 UNION ALL {new} AND NOT EXISTS (SELECT 1 FROM {h.name}_1 x WHERE x.{h.key} = c.key) GROUP BY key")


_hub_ctes()


def _empty_lsat(ln) -> str:
    return f"SELECT CAST(NULL AS VARCHAR) AS {ln.key}, CAST(NULL AS BIGINT) AS version_id, CAST(NULL AS TIMESTAMP) AS effective_from_dttm, CAST(NULL AS TIMESTAMP) AS effective_to_dttm, CAST(NULL AS VARCHAR) AS src_cd WHERE false"


def _empty_link(ln) -> str:
    hubs = ", ".join(f"CAST(NULL AS VARCHAR) AS {x}" for x in ln.hub_keys)
    return f"SELECT CAST(NULL AS VARCHAR) AS {ln.key}, {hubs}, CAST(NULL AS TIMESTAMP) AS load_dttm, CAST(NULL AS VARCHAR) AS src_cd WHERE false"


def _link_ctes() -> None:
    for ln in LINKS.values():
        k = ln.key
        hubs = ", ".join(ln.hub_keys)
        for m, mode in MODES.items():
            p = f"{m}_{ln.name}"
            ps = f"{m}_{ln.lsat}"
            cte(f"{p}_0", _empty_link(ln))
            cte(f"{ps}_0", _empty_lsat(ln))
            for b in (1, 2):
                req = f" AND {ln.require} IS NOT NULL" if ln.require else ""
                cte(f"{p}_rows_{b}", f"SELECT {k}, {hubs}, {ts('create_dttm')} AS create_dttm, {ts('delete_dttm')} AS delete_dttm FROM stg_{ln.staging}_{b} WHERE {k} IS NOT NULL{req}")
                rows, prev_l, prev_s = f"{p}_rows_{b}", f"{p}_{b - 1}", f"{ps}_{b - 1}"
                cte(f"{ps}_touched_{b}", f"SELECT * FROM {prev_s} t WHERE EXISTS (SELECT 1 FROM {rows} r WHERE r.{k} = t.{k})")
                cte(f"{ps}_untouched_{b}", f"SELECT * FROM {prev_s} t WHERE NOT EXISTS (SELECT 1 FROM {rows} r WHERE r.{k} = t.{k})")
                newl = (
                    f"SELECT {k}, " + ", ".join(f"MIN({x}) AS {x}" for x in ln.hub_keys)
                    + f", {tsl(LOAD_TS[b - 1])} AS load_dttm, '{ln.src_cd}' AS src_cd FROM {rows} r "
                    f"WHERE NOT EXISTS (SELECT 1 FROM {prev_l} x WHERE x.{k} = r.{k}) GROUP BY {k}"
                )
                if mode == "reference":
                    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {x}" for x in ln.hub_keys)
                    cte(f"{ps}_open_{b}", f"SELECT * FROM {ps}_touched_{b} WHERE effective_to_dttm = {OPEN}")
                    cte(f"{ps}_batch_{b}", f"SELECT {k}, {hubs}, create_dttm, delete_dttm FROM {rows} UNION SELECT {k}, {nulls}, effective_from_dttm, effective_to_dttm FROM {ps}_open_{b}")
                    cte(f"{ps}_go_{b}", f"SELECT EXISTS (SELECT 1 FROM {ps}_batch_{b} x WHERE NOT EXISTS (SELECT 1 FROM {ps}_open_{b} o WHERE o.{k} = x.{k})) AS go")
                    merged = merge_sql(f"{ps}_m_{b}", f"{ps}_batch_{b}", k, "reference")
                    cte(f"{ps}_up_{b}", f"""
SELECT COALESCE(t.{k}, m.{k}) AS {k}, COALESCE(t.version_id, {b}) AS version_id,
  COALESCE(t.effective_from_dttm, m.create_dttm) AS effective_from_dttm,
  COALESCE(COALESCE(m.delete_dttm, CASE WHEN m.{k} IS NOT NULL THEN {OPEN} END), t.effective_to_dttm) AS effective_to_dttm,
  COALESCE(t.src_cd, '{ln.src_cd}') AS src_cd
FROM {ps}_touched_{b} t FULL OUTER JOIN {merged} m ON t.{k} = m.{k} AND t.effective_from_dttm = m.create_dttm""")
                    cte(f"{ps}_{b}", f"""
SELECT * FROM {prev_s} WHERE NOT (SELECT go FROM {ps}_go_{b})
UNION ALL SELECT * FROM {ps}_untouched_{b} WHERE (SELECT go FROM {ps}_go_{b})
UNION ALL SELECT * FROM {ps}_up_{b} WHERE (SELECT go FROM {ps}_go_{b})""")
                    cte(f"{p}_{b}", f"SELECT * FROM {prev_l} UNION ALL SELECT * FROM ({newl}) WHERE (SELECT go FROM {ps}_go_{b})")
                else:
                    cte(f"{ps}_ps_{b}", f"""
SELECT {k}, create_dttm, MIN(delete_dttm) AS delete_dttm FROM (
  SELECT {k}, create_dttm, delete_dttm FROM {rows}
  UNION ALL SELECT {k}, effective_from_dttm, NULLIF(effective_to_dttm, {OPEN}) FROM {ps}_touched_{b}) u
WHERE create_dttm IS NOT NULL GROUP BY {k}, create_dttm""")
                    merged = merge_sql(f"{ps}_m_{b}", f"{ps}_ps_{b}", k, "strict")
                    cte(f"{ps}_{b}", f"""
SELECT * FROM {ps}_untouched_{b}
UNION ALL
SELECT m.{k}, CASE WHEN t.effective_to_dttm = COALESCE(m.delete_dttm, {OPEN}) THEN t.version_id ELSE {b} END,
  m.create_dttm, COALESCE(m.delete_dttm, {OPEN}),
  CASE WHEN t.effective_to_dttm = COALESCE(m.delete_dttm, {OPEN}) THEN t.src_cd ELSE '{ln.src_cd}' END
FROM {merged} m LEFT JOIN {ps}_touched_{b} t ON t.{k} = m.{k} AND t.effective_from_dttm = m.create_dttm""")
                    cte(f"{p}_{b}", f"SELECT * FROM {prev_l} UNION ALL {newl}")


_link_ctes()


def _attr_sql(a: str, kind: str) -> str:
    return a if kind == "VARCHAR" else f"CAST(NULLIF({a}, '') AS {kind})"


HASH_SQL = {
    "hsat_account_status": "md5(coalesce(account_status_nm, ''))",
    "hsat_request_status": "md5(coalesce(service_request_status_nm, ''))",
    "hsat_crm_customer_contact": "md5(concat_ws(':', phone_num, email))",
}


def _empty_sat(s) -> str:
    attrs = ", ".join(f"CAST(NULL AS {kind}) AS {a}" for a, kind in s.attrs)
    return (
        f"SELECT CAST(NULL AS VARCHAR) AS {s.key}, CAST(NULL AS BIGINT) AS version_id, CAST(NULL AS VARCHAR) AS {s.hash_col}, "
        f"CAST(NULL AS TIMESTAMP) AS effective_from_dttm, CAST(NULL AS TIMESTAMP) AS effective_to_dttm, CAST(NULL AS VARCHAR) AS src_cd, {attrs} WHERE false"
    )


def _sat_ctes() -> None:
    for s in SATS.values():
        k, h = s.key, s.hash_col
        names = [a for a, _ in s.attrs]
        al = ", ".join(names)
        hash_expr = HASH_SQL.get(s.name, h)
        cols = f"{k}, version_id, {h}, effective_from_dttm, effective_to_dttm, src_cd, {al}"
        for m, mode in MODES.items():
            p = f"{m}_{s.name}"
            cte(f"{p}_0", _empty_sat(s))
            for b in (1, 2):
                typed = ", ".join(f"{_attr_sql(a, t)} AS {a}" for a, t in s.attrs)
                cte(f"{p}_in_{b}", f"""
SELECT {k}, {hash_expr} AS {h}, {ts('create_dttm')} AS create_dttm, {ts('delete_dttm')} AS delete_dttm, {typed}, {ts('last_update')} AS last_update
FROM stg_{s.staging}_{b}""")
                order = ", ".join(f"{c} DESC NULLS LAST" for c in ["last_update", h, "delete_dttm", *names])
                cte(f"{p}_b_{b}", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {k}, create_dttm ORDER BY {order}) AS rn FROM {p}_in_{b} WHERE create_dttm IS NOT NULL)
WHERE rn = 1""")
                prev = f"{p}_{b - 1}"
                bb = f"{p}_b_{b}"
                cte(f"{p}_touched_{b}", f"SELECT * FROM {prev} t WHERE EXISTS (SELECT 1 FROM {bb} x WHERE x.{k} = t.{k})")
                cte(f"{p}_untouched_{b}", f"SELECT * FROM {prev} t WHERE NOT EXISTS (SELECT 1 FROM {bb} x WHERE x.{k} = t.{k})")
                if mode == "reference":
                    # every start of a touched key from the batch's first start on, and the start after it
                    cte(f"{p}_starts_{b}", f"""
SELECT {k}, create_dttm AS s FROM {bb}
UNION
SELECT {k}, effective_from_dttm FROM {p}_touched_{b} t
WHERE EXISTS (SELECT 1 FROM {bb} y WHERE y.{k} = t.{k} AND y.create_dttm <= t.effective_from_dttm)""")
                    cte(f"{p}_after_{b}", f"""
SELECT a.{k}, a.s, COALESCE(MIN(n.s), {OPEN}) AS following
FROM {p}_starts_{b} a LEFT JOIN {p}_starts_{b} n ON n.{k} = a.{k} AND n.s > a.s GROUP BY a.{k}, a.s""")
                    # a stored row ends anew when the batch re-sends its start, or when it is open between two batch starts
                    told = ", ".join(f"t.{a}" for a in names)
                    cte(f"{p}_{b}", f"""
SELECT {cols} FROM {p}_untouched_{b}
UNION ALL
SELECT t.{k}, CASE WHEN x.{k} IS NOT NULL OR closes THEN {b} ELSE t.version_id END, t.{h}, t.effective_from_dttm,
  CASE WHEN x.{k} IS NOT NULL THEN COALESCE(NULLIF(x.delete_dttm, {OPEN}), following) WHEN closes THEN following ELSE t.effective_to_dttm END, t.src_cd, {told}
FROM (SELECT o.*, o.effective_to_dttm = {OPEN} AND EXISTS (SELECT 1 FROM {bb} y WHERE y.{k} = o.{k} AND y.create_dttm < o.effective_from_dttm)
        AND EXISTS (SELECT 1 FROM {bb} y WHERE y.{k} = o.{k} AND y.create_dttm > o.effective_from_dttm) AS closes FROM {p}_touched_{b} o) t
LEFT JOIN {bb} x ON x.{k} = t.{k} AND x.create_dttm = t.effective_from_dttm
LEFT JOIN {p}_after_{b} n ON n.{k} = t.{k} AND n.s = t.effective_from_dttm
UNION ALL
SELECT x.{k}, {b}, x.{h}, x.create_dttm, COALESCE(NULLIF(x.delete_dttm, {OPEN}), following, {OPEN}), '{s.src_cd}', {", ".join(f"x.{a}" for a in names)}
FROM {bb} x LEFT JOIN {p}_after_{b} n ON n.{k} = x.{k} AND n.s = x.create_dttm
WHERE NOT EXISTS (SELECT 1 FROM {p}_touched_{b} t WHERE t.{k} = x.{k} AND t.effective_from_dttm = x.create_dttm)""")
                else:
                    cte(f"{p}_comb_{b}", f"""
SELECT {k}, create_dttm AS effective_from_dttm, COALESCE(delete_dttm, {OPEN}) AS explicit_to, {h}, {al},
  CAST(NULL AS BIGINT) AS old_v, CAST(NULL AS TIMESTAMP) AS old_to, '{s.src_cd}' AS src_cd FROM {bb}
UNION ALL
SELECT {k}, effective_from_dttm, effective_to_dttm, {h}, {al}, version_id, effective_to_dttm, src_cd
FROM {p}_touched_{b} t WHERE NOT EXISTS (SELECT 1 FROM {bb} x WHERE x.{k} = t.{k} AND x.create_dttm = t.effective_from_dttm)""")
                    cte(f"{p}_{b}", f"""
SELECT {cols} FROM {p}_untouched_{b}
UNION ALL
SELECT {k}, CASE WHEN old_v IS NOT NULL AND old_to = new_to THEN old_v ELSE {b} END AS version_id, {h},
  effective_from_dttm, new_to AS effective_to_dttm, src_cd, {al}
FROM (SELECT *, LEAST(explicit_to, COALESCE(LEAD(effective_from_dttm) OVER (PARTITION BY {k} ORDER BY effective_from_dttm), {OPEN})) AS new_to
      FROM {p}_comb_{b})""")


_sat_ctes()


def V(name: str, mode: str = "s", batch: int = 2) -> str:
    """CTE name of a vault table after ``batch`` loads in a mode ('s' strict, 'r' reference)."""
    if name in HUBS:
        return f"{name}_{batch}"
    return f"{mode}_{name}_{batch}"


def present(select_cols: str) -> str:
    return select_cols


def nul(c: str, alias: str | None = None) -> str:
    return f"NULLIF({c}, {OPEN}) AS {alias or c.split('.')[-1]}"


# --- mart ------------------------------------------------------------------------

GRID_START, GRID_END = "1995-01-01", "2001-12-31"
TI_ORDER = "effective_from_dttm, request_hash_key, status_from_dttm"


def _mart_ctes(m: str) -> None:
    cte(f"{m}_done", f"""
SELECT l.customer_hash_key, l.request_hash_key, hr.effective_from_dttm, hr.tail_limit, hr.service_request_type_nm, hs.effective_from_dttm AS status_from_dttm
FROM {V('link_cust_x_req', m)} l
JOIN {V('hsat_request', m)} hr ON hr.request_hash_key = l.request_hash_key
JOIN {V('hsat_request_status', m)} hs ON hs.request_hash_key = l.request_hash_key
WHERE hs.service_request_status_nm = 'done'""")
    cte(f"{m}_tail_info", f"""
SELECT customer_hash_key, request_hash_key, status_from_dttm, effective_from_dttm,
  COALESCE(LEAD(effective_from_dttm) OVER w, {OPEN}) AS effective_to_dttm, tail_limit, service_request_type_nm,
  LAG(service_request_type_nm) OVER w AS prev_status
FROM {m}_done WINDOW w AS (PARTITION BY customer_hash_key ORDER BY effective_from_dttm, request_hash_key, status_from_dttm)""")
    # the type of the state before it, states counted by end, then start
    cte(f"{m}_counted", f"""
SELECT *, row_number() OVER (PARTITION BY customer_hash_key ORDER BY effective_to_dttm, effective_from_dttm, request_hash_key, status_from_dttm) AS place
FROM {m}_tail_info""")
    cte(f"{m}_tip", f"""
SELECT t.* EXCLUDE (place), b.service_request_type_nm AS prev_type
FROM {m}_counted t LEFT JOIN {m}_counted b ON b.customer_hash_key = t.customer_hash_key AND b.place = t.place - 1""")
    # which customer an account belongs to; the reference's view shows a row once for each version of the links on the way
    for ln in ("acc_x_trans", "acc_x_app", "cust_x_app"):
        versions = f"SELECT {ln}_hash_key, count(*) AS n FROM {V('lsat_' + ln, m)} GROUP BY ALL" if m == "r" else f"SELECT NULL AS {ln}_hash_key, 1 AS n WHERE false"
        cte(f"{m}_times_{ln}", versions)
    cte(f"{m}_owner", f"""
SELECT account_hash_key, customer_hash_key, COALESCE(app.n, 1) * COALESCE(cust.n, 1) AS times
FROM {V('link_cust_x_app', m)} JOIN {V('link_acc_x_app', m)} USING (application_hash_key)
LEFT JOIN {m}_times_acc_x_app app USING (acc_x_app_hash_key) LEFT JOIN {m}_times_cust_x_app cust USING (cust_x_app_hash_key)""")
    cte(f"{m}_posting", f"""
SELECT transaction_hash_key, account_hash_key, customer_hash_key, unnest(range(times * COALESCE(n, 1))) AS copy
FROM {m}_owner JOIN {V('link_acc_x_trans', m)} USING (account_hash_key) LEFT JOIN {m}_times_acc_x_trans USING (acc_x_trans_hash_key)
WHERE transaction_hash_key IN (SELECT transaction_hash_key FROM {V('hub_transaction', m)})""")
    cte(f"{m}_states", f"SELECT * FROM {m}_tail_info WHERE effective_from_dttm < effective_to_dttm")
    cte(f"{m}_txi", f"""
SELECT transaction_hash_key, orig_transaction_hash_key, account_hash_key, p.customer_hash_key, transaction_amt, transaction_type_nm, transaction_dttm,
  facts.effective_from_dttm, facts.effective_to_dttm,
  CASE WHEN transaction_dttm < state.effective_to_dttm THEN state.tail_limit END AS tail_limit,
  CASE WHEN transaction_dttm < state.effective_to_dttm THEN state.service_request_type_nm END AS service_request_type_nm
FROM (FROM {m}_posting LEFT JOIN {V('hsat_transaction', m)} USING (transaction_hash_key)
      LEFT JOIN (SELECT transaction_hash_key, orig_transaction_hash_key FROM {V('link_trans_x_orig_trans', m)}) USING (transaction_hash_key)) p
  ASOF LEFT JOIN {m}_states state ON state.customer_hash_key = p.customer_hash_key AND state.effective_from_dttm <= p.transaction_dttm""".replace("facts.", "p."))
    cte(f"{m}_tx", f"""
SELECT customer_hash_key, hs.*
FROM (SELECT DISTINCT transaction_hash_key, account_hash_key, customer_hash_key FROM {m}_posting) JOIN {V('hsat_transaction', m)} hs USING (transaction_hash_key)
WHERE hs.transaction_type_nm = 'kopylka' AND hs.transaction_amt > 0
  AND hs.transaction_dttm >= hs.effective_from_dttm AND hs.transaction_dttm < hs.effective_to_dttm""")
    cte(f"{m}_revenue", f"""
SELECT customer_hash_key, CAST(date_trunc('month', transaction_dttm) AS DATE) AS revenue_month,
  CAST(SUM(ROUND(transaction_amt * CAST(0.01 AS DECIMAL(3,2)), 2)) AS DECIMAL(18,2)) AS monthly_revenue
FROM {m}_tx t WHERE EXISTS (SELECT 1 FROM {V('link_cust_x_req', m)} r WHERE r.customer_hash_key = t.customer_hash_key)
GROUP BY 1, 2""")
    cte(f"{m}_revenue_ref", f"""
SELECT t.customer_hash_key, CAST(date_trunc('month', transaction_dttm) AS DATE) AS revenue_month,
  CAST(SUM(ROUND(transaction_amt * CAST(0.01 AS DECIMAL(3,2)), 2)) AS DECIMAL(18,2)) AS monthly_revenue
FROM {m}_tx t JOIN {V('link_cust_x_req', m)} r ON r.customer_hash_key = t.customer_hash_key
GROUP BY 1, 2""")
    cte(f"{m}_arpu", f"""
SELECT revenue_month AS report_date, COUNT(DISTINCT customer_hash_key) AS paying_customers,
  CAST(SUM(r) AS DECIMAL(18,2)) AS total_revenue,
  {dec(half_up('CAST(SUM(r) * 100 AS BIGINT)', 'COUNT(DISTINCT customer_hash_key)', 0), 2)} AS arpu
FROM (SELECT customer_hash_key, CAST(date_trunc('month', transaction_dttm) AS DATE) AS revenue_month,
        SUM(ROUND(transaction_amt * CAST(0.01 AS DECIMAL(3,2)), 2)) AS r FROM {m}_tx GROUP BY 1, 2)
GROUP BY revenue_month""")
    # per customer: months with a current request version, and those of them with another type than disable
    cte(f"{m}_months", f"""
SELECT customer_hash_key, list(DISTINCT mon) AS seen, coalesce(list(DISTINCT mon) FILTER (service_request_type_nm <> 'disable'), []) AS using_it
FROM (SELECT l.customer_hash_key, service_request_type_nm, CAST(date_trunc('month', effective_from_dttm) AS DATE) AS mon
      FROM {V('link_cust_x_req', m)} l JOIN {V('hsat_request', m)} h USING (request_hash_key) WHERE effective_to_dttm = {OPEN})
GROUP BY customer_hash_key""")
    cte(f"{m}_churn", f"""
SELECT report_date, COUNT(*) AS customers_start, COUNT(*) FILTER (lost) AS customers_lost,
  {rate('COUNT(*) FILTER (lost)', 'COUNT(*)', 4)} AS churn_rate,
  CAST(ROUND({rate('COUNT(*) FILTER (lost)', 'COUNT(*)', 4)} * 100, 2) AS DECIMAL(18,2)) AS churn_rate_percent
FROM (SELECT report_date, list_contains(seen, CAST(report_date + INTERVAL 1 MONTH AS DATE)) AND NOT list_contains(using_it, CAST(report_date + INTERVAL 1 MONTH AS DATE)) AS lost
      FROM (SELECT seen, using_it, unnest(using_it) AS report_date FROM {m}_months))
GROUP BY report_date""")
    # M6: months of a customer as one list; retained when the list holds the month after
    for sc in (3, 4):
        cte(f"{m}_retention{sc}", f"""
SELECT current_month, COUNT(*) AS total_users, COUNT(*) FILTER (stays) AS retained_users, {rate('COUNT(*) FILTER (stays)', 'COUNT(*)', sc)} AS retention_rate
FROM (SELECT current_month, list_contains(months, CAST(current_month + INTERVAL 1 MONTH AS DATE)) AS stays
      FROM (SELECT months, unnest(months) AS current_month
            FROM (SELECT list(DISTINCT CAST(date_trunc('month', effective_from_dttm) AS DATE)) AS months
                  FROM {m}_tail_info WHERE service_request_type_nm <> 'disable' GROUP BY customer_hash_key)))
GROUP BY current_month""")
    cte(f"{m}_mgrid", f"SELECT CAST(date_trunc('month', d) AS DATE) AS month_dt FROM generate_series(DATE '{GRID_START}', DATE '{GRID_END}', INTERVAL 1 MONTH) t(d)")
    # per month and customer: does a stored version span the month start, and does a done request with a limit hold there
    cte(f"{m}_kop", f"""
SELECT month_dt, COUNT(*) AS total_active_users, COUNT(*) FILTER (limited) AS kopylka_users, COUNT(*) FILTER (NOT limited) AS not_active_user,
  CAST({rate('COUNT(*) FILTER (limited)', 'COUNT(*)', 4)} * 100 AS DECIMAL(18,4)) AS kopylka_usage_pct
FROM (
  SELECT month_dt,
    EXISTS (SELECT 1 FROM {m}_tail_info ti WHERE ti.customer_hash_key = c.customer_hash_key AND ti.tail_limit > 0
            AND CAST(month_dt AS TIMESTAMP) BETWEEN ti.effective_from_dttm AND ti.effective_to_dttm - INTERVAL 1 MICROSECOND) AS limited
  FROM {m}_mgrid, {V('hub_customer', m)} c
  WHERE EXISTS (SELECT 1 FROM {V('hsat_cab_customer', m)} v WHERE v.customer_hash_key = c.customer_hash_key
                AND v.effective_from_dttm < CAST(month_dt AS TIMESTAMP) AND NOT v.effective_to_dttm <= CAST(month_dt AS TIMESTAMP)))
GROUP BY month_dt""")
    cte(f"{m}_act_month", f"""
SELECT CAST(g.month_dt AS DATE) AS month_dt,
  COUNT(CASE WHEN t.service_request_type_nm IN ('chg_round','enable') AND (t.prev_type = 'disable' OR t.prev_type IS NULL) THEN 1 END) AS activation,
  COUNT(CASE WHEN t.service_request_type_nm = 'disable' AND t.prev_type IN ('chg_round','enable') THEN 1 END) AS deactivation
FROM {m}_mgrid g JOIN {m}_tip t
  ON t.effective_from_dttm <= CAST(g.month_dt AS TIMESTAMP) AND CAST(g.month_dt AS TIMESTAMP) - INTERVAL 1 MONTH < t.effective_from_dttm
GROUP BY 1""")


for _m in MODES:
    _mart_ctes(_m)


def activation_grid_sql(step: int) -> str:
    return f"""
SELECT *, activation - deactivation AS net_change FROM (
SELECT d.to_date, CAST(d.to_date - INTERVAL {step} DAY AS DATE) AS from_date,
  (SELECT COUNT(*) FROM s_tip t WHERE t.effective_from_dttm <= CAST(d.to_date AS TIMESTAMP) AND CAST(d.to_date AS TIMESTAMP) - INTERVAL {step} DAY < t.effective_from_dttm
     AND t.service_request_type_nm IN ('chg_round','enable') AND (t.prev_type = 'disable' OR t.prev_type IS NULL)) AS activation,
  (SELECT COUNT(*) FROM s_tip t WHERE t.effective_from_dttm <= CAST(d.to_date AS TIMESTAMP) AND CAST(d.to_date AS TIMESTAMP) - INTERVAL {step} DAY < t.effective_from_dttm
     AND t.service_request_type_nm = 'disable' AND t.prev_type IN ('chg_round','enable')) AS deactivation
FROM (SELECT CAST(x AS DATE) AS to_date FROM generate_series(DATE '{GRID_START}', DATE '{GRID_END}', INTERVAL {step} DAY) g(x)) d)"""


# --- final queries ---------------------------------------------------------------

Q: dict[str, str] = {}


def _sat_present(name: str, mode: str = "s") -> str:
    s = SATS.get(name)
    if s is not None:
        attrs = ", ".join(a for a, _ in s.attrs)
        return f"SELECT {s.key}, version_id, {s.hash_col}, effective_from_dttm, {nul('effective_to_dttm')}, src_cd, {attrs} FROM {V(name, mode)}"
    ln = next(x for x in LINKS.values() if x.lsat == name)
    return f"SELECT {ln.key}, version_id, effective_from_dttm, {nul('effective_to_dttm')}, src_cd FROM {V(name, mode)}"


Q["source_catalogue"] = "\nUNION ALL\n".join(
    f"SELECT '{s.entity}' AS entity_name, '{s.ddl}' AS columns_def, {str(s.has_header).upper()} AS has_header, {len(s.columns)} AS n_columns, "
    f"{str(s.is_reference_list).upper()} AS is_reference_list, (SELECT COUNT(*) FROM src_{s.entity}) AS source_rows"
    for s in CATALOGUE.values()
)
Q["csv_folder_scan"] = "SELECT * FROM src_cab_customer"
Q["register_sources"] = "\nUNION ALL\n".join(
    f"SELECT '{s.entity}' AS entity_name, TRUE AS ok, CAST(NULL AS VARCHAR) AS error, (SELECT COUNT(*) FROM src_{s.entity}) AS source_rows" for s in CATALOGUE.values()
)
Q["incremental_window"] = f"SELECT * FROM src_crm_transaction WHERE {ts('last_update')} >= TIMESTAMP '1998-01-01' AND {ts('last_update')} < TIMESTAMP '1999-01-01'"
Q["ref_refresh"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS entity_name, {CATALOGUE[n].columns[0]} AS code, {CATALOGUE[n].columns[1]} AS name FROM src_{n}" for n in REFERENCE_LISTS
)
for _e in STAGING:
    Q[f"stage_{_e}"] = f"SELECT * FROM stg_{_e}_all"
Q["typed_staging"] = f"""SELECT transaction_hash_key, CAST(NULLIF(transaction_amt, '') AS DECIMAL(18,2)) AS transaction_amt,
  {ts('transaction_dttm')} AS transaction_dttm, {ts('create_dttm')} AS create_dttm, {ts('delete_dttm')} AS delete_dttm FROM stg_crm_transaction_all"""
Q["staging_batch_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{e}' AS table_name, COUNT(*) AS rows_loaded, COUNT(*) > 0 AS registered, CASE WHEN COUNT(*) > 0 THEN {tsl(LOAD_TS[b - 1])} END AS load_dttm, {b} AS batch FROM stg_{e}_{b}"
    for b in (1, 2) for e in STAGING
)
Q["registry_last_load"] = "\nUNION ALL\n".join(
    f"SELECT 'staging_{e}' AS table_name, COALESCE(MAX(ts), {LOW}) AS last_load_dttm FROM ("
    + " UNION ALL ".join(f"SELECT {tsl(LOAD_TS[b - 1])} AS ts FROM (SELECT COUNT(*) AS n FROM stg_{e}_{b}) WHERE n > 0" for b in (1, 2))
    + ")"
    for e in STAGING
)
for _m in MODES:
    cte(f"{_m}_registry", "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{n}' AS table_name, version_id, CASE version_id WHEN 1 THEN {tsl(LOAD_TS[0])} WHEN 2 THEN {tsl(LOAD_TS[1])} END AS load_dttm FROM {V(n, _m)}"
        for n in [ln.lsat for ln in LINKS.values()] + list(SATS)
    ))
for _m, _name in (("s", "registry_next_version"), ("r", "registry_next_version_ref")):
    Q[_name] = f"""SELECT table_name, MAX(load_dttm) AS last_load_dttm, MAX(version_id) + 1 AS next_version FROM {_m}_registry GROUP BY table_name"""
Q["registry_epoch"] = "SELECT table_name, version_id, load_dttm, CAST(epoch(load_dttm) AS BIGINT) AS epoch_seconds FROM s_registry"
Q["hash_key"] = f"SELECT c_custkey, {hk('CAST(c_custkey AS VARCHAR)')} AS customer_hash_key, {hk('c_name')} AS name_hash_key FROM customer"
Q["link_hash_key"] = f"SELECT o_orderkey, {ch(['CAST(o_custkey AS VARCHAR)', 'CAST(o_orderkey AS VARCHAR)'])} AS cust_x_app_hash_key FROM orders"
Q["hash_diff"] = "SELECT application_id, product_type_nm, hash_diff FROM stg_application_all"
Q["hash_diff_variants"] = "SELECT customer_id, create_dttm, hash_diff_con, md5(concat_ws(':', phone_num, email)) AS contact_md5, md5(coalesce(first_nm, '')) AS first_nm_md5 FROM stg_crm_customer_all"
Q["self_link_key"] = "SELECT transaction_id, orig_id, orig_transaction_hash_key, trans_x_orig_trans_hash_key FROM stg_crm_transaction_all"

for _h in HUBS:
    Q[_h] = f"SELECT * FROM {V(_h)}"
for _ln in LINKS.values():
    Q[_ln.name] = f"SELECT * FROM {V(_ln.name)}"
    Q[_ln.lsat] = _sat_present(_ln.lsat)
for _s in SATS:
    Q[_s] = _sat_present(_s)
for _ln in LINKS.values():
    Q[f"{_ln.name}_ref"] = f"SELECT * FROM {V(_ln.name, 'r')}"
    Q[f"{_ln.lsat}_ref"] = _sat_present(_ln.lsat, "r")
for _s in SATS:
    Q[f"{_s}_ref"] = _sat_present(_s, "r")
Q["lsat_two_batches"] = _sat_present("lsat_acc_x_app", "r")
Q["hsat_two_batches"] = _sat_present("hsat_cab_customer", "r")
Q["hsat_late_rows"] = _sat_present("hsat_crm_customer", "r")
Q["hub_incremental"] = "\nUNION ALL\n".join(
    f"SELECT '{h.name}' AS hub_name, {h.key} AS hash_key, {h.id_col} AS business_id, load_dttm FROM {V(h.name)} WHERE load_dttm = {tsl(LOAD_TS[1])}" for h in HUBS.values()
)
_all_tables = sorted(list(HUBS) + [x for ln in LINKS.values() for x in (ln.name, ln.lsat)] + list(SATS))
Q["pipeline_row_counts"] = "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {V(n)}" for n in _all_tables)
Q["hsat_current"] = _sat_present("hsat_request") + f" WHERE effective_to_dttm = {OPEN}"

cte("ev_iv", "SELECT user_id, ts AS create_dttm, ts + INTERVAL 2 HOUR AS delete_dttm FROM events")
merge_sql("ev_lag", "ev_iv", "user_id", "reference")
merge_sql("ev_max", "ev_iv", "user_id", "strict")
Q["merge_intervals_lag"] = "SELECT * FROM ev_lag"
Q["merge_intervals_max"] = "SELECT * FROM ev_max"
cte("ev_state", f"""
SELECT user_id, event_id, event_type AS state, ts AS effective_from_dttm,
  COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), {OPEN}) AS effective_to_dttm
FROM events WHERE event_type IN ('signup', 'click', 'error')""")
Q["scd2_lead"] = f"SELECT user_id, event_id, state, effective_from_dttm, {nul('effective_to_dttm')} FROM ev_state"
Q["asof_state"] = """
SELECT p.user_id, p.event_id, p.ts, p.value, s.state, s.effective_from_dttm AS state_from
FROM events p LEFT JOIN ev_state s ON s.user_id = p.user_id AND s.effective_from_dttm <= p.ts AND p.ts < s.effective_to_dttm
WHERE p.event_type = 'purchase'"""

Q["state_intervals"] = f"""SELECT customer_hash_key, request_hash_key, status_from_dttm, effective_from_dttm, {nul('effective_to_dttm')},
  tail_limit, service_request_type_nm, prev_status FROM s_tail_info"""
Q["transaction_enriched"] = f"""SELECT transaction_hash_key, orig_transaction_hash_key, account_hash_key, customer_hash_key, transaction_amt,
  transaction_type_nm, transaction_dttm, effective_from_dttm, {nul('effective_to_dttm')}, tail_limit, service_request_type_nm FROM s_txi"""
Q["transaction_enriched_ref"] = Q["transaction_enriched"].replace("s_txi", "r_txi")
_ONE = f"(SELECT MIN(customer_hash_key) FROM {V('link_cust_x_req')})"
_VIOLATING = f"""(SELECT customer_hash_key FROM s_txi JOIN (SELECT DISTINCT transaction_hash_key AS orig_transaction_hash_key FROM {V('hsat_transaction')}) USING (orig_transaction_hash_key)
  WHERE transaction_type_nm = 'kopylka' AND abs(transaction_amt) > tail_limit)"""
Q["state_drill_down_violations"] = Q["state_intervals"] + f" WHERE customer_hash_key IN {_VIOLATING}"
Q["transaction_drill_down_violations"] = Q["transaction_enriched"] + f" WHERE customer_hash_key IN {_VIOLATING}"
Q["state_drill_down"] = Q["state_intervals"] + f" WHERE customer_hash_key = {_ONE}"
Q["transaction_drill_down"] = Q["transaction_enriched"] + f" WHERE customer_hash_key = {_ONE}"
Q["interval_epoch"] = f"""SELECT account_hash_key, version_id, CAST(epoch(effective_from_dttm) AS BIGINT) AS from_epoch,
  CASE WHEN effective_to_dttm < {OPEN} THEN CAST(epoch(effective_to_dttm) AS BIGINT) END AS to_epoch FROM {V('hsat_account')}"""
Q["activation_at_date"] = """
SELECT DATE '1999-06-30' AS calc_date,
  COUNT(CASE WHEN service_request_type_nm IN ('chg_round','enable') AND (prev_type = 'disable' OR prev_type IS NULL) THEN 1 END) AS activation,
  COUNT(CASE WHEN service_request_type_nm = 'disable' AND prev_type IN ('chg_round','enable') THEN 1 END) AS deactivation
FROM s_tip WHERE effective_from_dttm <= TIMESTAMP '1999-06-30' AND TIMESTAMP '1999-06-30' - INTERVAL 2000 DAY < effective_from_dttm"""
Q["activation_30d"] = activation_grid_sql(30)
Q["activation_7d"] = activation_grid_sql(7)
Q["retention_monthly"] = "SELECT * FROM s_retention4"
Q["user_activity_monthly"] = "SELECT * FROM s_kop"
Q["metrics_unified"] = """
SELECT g.month_dt, COALESCE(a.activation, 0) AS activation, COALESCE(a.deactivation, 0) AS deactivation,
  COALESCE(a.activation - a.deactivation, 0) AS net_change, COALESCE(r.total_users, 0) AS total_users,
  COALESCE(r.retained_users, 0) AS retained_users, COALESCE(r.retention_rate, CAST(0 AS DECIMAL(18,3))) AS retention_rate,
  COALESCE(k.kopylka_users, 0) AS kopylka_users, COALESCE(k.kopylka_usage_pct, CAST(0 AS DECIMAL(18,4))) AS kopylka_usage_pct
FROM s_mgrid g LEFT JOIN s_act_month a ON a.month_dt = g.month_dt
LEFT JOIN s_retention3 r ON r.current_month = g.month_dt
LEFT JOIN s_kop k ON k.month_dt = g.month_dt"""
Q["customer_revenue"] = "SELECT * FROM s_revenue"
Q["customer_revenue_ref"] = "SELECT * FROM s_revenue_ref"
Q["revenue_by_month"] = "SELECT revenue_month, CAST(SUM(monthly_revenue) AS DECIMAL(18,2)) AS revenue FROM s_revenue GROUP BY revenue_month"
Q["churn_monthly"] = "SELECT * FROM s_churn"
Q["arpu_monthly"] = "SELECT * FROM s_arpu"
Q["ltv_monthly"] = f"""
SELECT report_date, arpu, churn_rate, churn_rate_percent, paying_customers, total_revenue, customers_start, customers_lost,
  {dec(half_up('s * 100', 'n', 0), 6)} AS avg_churn_rate,
  CASE WHEN s > 0 THEN {dec(half_up('a * n * 10000', 's', 0), 2)} END AS ltv_estimate
FROM (
  SELECT ar.*, ch.churn_rate, ch.churn_rate_percent, ch.customers_start, ch.customers_lost,
    CAST(ar.arpu * 100 AS BIGINT) AS a,
    SUM(CAST(ch.churn_rate * 10000 AS BIGINT)) OVER (ORDER BY ar.report_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s,
    COUNT(*) OVER (ORDER BY ar.report_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
  FROM s_arpu ar LEFT JOIN s_churn ch ON ar.report_date = ch.report_date
  WHERE ch.churn_rate IS NOT NULL)"""
Q["unbalanced_customers"] = """
SELECT customer_hash_key, CAST(SUM(transaction_amt) AS DECIMAL(18,2)) AS sum_amt FROM s_txi
WHERE transaction_type_nm = 'kopylka' GROUP BY customer_hash_key HAVING ROUND(SUM(transaction_amt), 0) <> 0"""
Q["limit_violations"] = f"""
SELECT ht.transaction_hash_key AS orig_transaction_hash_key, ti.transaction_hash_key, ht.transaction_amt AS orig_transaction_amt,
  ti.transaction_amt, ti.tail_limit
FROM s_txi ti JOIN {V('hsat_transaction')} ht ON ti.orig_transaction_hash_key = ht.transaction_hash_key
WHERE ti.transaction_type_nm = 'kopylka' AND abs(ti.transaction_amt) > ti.tail_limit"""
Q["duplicate_versions"] = "SELECT account_id, create_dttm, COUNT(*) AS n_rows FROM stg_crm_account_all GROUP BY account_id, create_dttm HAVING COUNT(*) > 1"
Q["key_history"] = f"""
SELECT h.account_hash_key, h.version_id, h.hash_diff, h.effective_from_dttm, {nul('h.effective_to_dttm')}, h.src_cd, h.account_type_nm,
  h.account_create_dt, hub.account_id,
  row_number() OVER (PARTITION BY h.account_hash_key ORDER BY h.effective_from_dttm DESC NULLS FIRST) AS version_rank
FROM {V('hsat_account')} h JOIN {V('hub_account')} hub ON hub.account_hash_key = h.account_hash_key"""
Q["key_history_one"] = Q["key_history"] + f" WHERE hub.account_id = (SELECT MIN(account_id) FROM {V('hub_account')})"
Q["key_history_resent"] = Q["key_history"] + f" WHERE h.account_hash_key IN (SELECT account_hash_key FROM stg_crm_account_all GROUP BY account_hash_key HAVING COUNT(*) > 1)"
Q["positive_roundups"] = f"""
SELECT hs.transaction_hash_key, hub.transaction_id, hs.version_id, hs.hash_diff, hs.effective_from_dttm, {nul('hs.effective_to_dttm')},
  hs.transaction_amt, hs.transaction_type_nm, hs.transaction_dttm
FROM {V('hub_transaction')} hub JOIN {V('hsat_transaction')} hs ON hs.transaction_hash_key = hub.transaction_hash_key
WHERE hs.transaction_type_nm = 'kopylka' AND hs.transaction_amt > 0"""
Q["load_epoch"] = "\nUNION ALL\n".join(
    f"SELECT '{h}' AS table_name, load_dttm, CAST(epoch(load_dttm) AS BIGINT) AS epoch_seconds, COUNT(*) AS rows_loaded FROM {V(h)} GROUP BY load_dttm" for h in HUBS
)
Q["roundup_amount"] = """
SELECT transaction_hash_key, transaction_amt, tail_limit,
  CAST((CAST(transaction_amt * 100 AS BIGINT) + tail_limit * 100) // 1000 * 10 - transaction_amt AS DECIMAL(18,2)) AS roundup_amt
FROM s_txi WHERE tail_limit > 0 AND transaction_amt > 0"""


# --- data quality ------------------------------------------------------------------

def _dq_check_sql(name: str, check: str, m: str = "s") -> str:
    s = SATS[name]
    t, k = V(name, m), s.key
    out = f"CAST({k} AS VARCHAR) AS bk_value, version_id, effective_from_dttm, effective_to_dttm"
    if check == "check_overlapping_intervals":
        return f"""SELECT {out} FROM (SELECT *, LEAD(effective_from_dttm) OVER (PARTITION BY {k} ORDER BY effective_from_dttm, effective_to_dttm, version_id) AS nx
  FROM {t} WHERE effective_to_dttm <> {OPEN}) WHERE effective_to_dttm > nx"""
    if check == "check_explicit_deletion":
        # the ends that the source gave for a (key, start), against the end that the history holds
        said = f"""SELECT {k}, {ts('create_dttm')} AS effective_from_dttm, list({ts('delete_dttm')}) AS ends
  FROM stg_{s.staging}_2 WHERE {ts('delete_dttm')} IS NOT NULL GROUP BY ALL"""
        return f"""SELECT {out}
FROM (SELECT *, unnest(list_filter(ends, lambda e: e <> effective_to_dttm)) AS other FROM {t} JOIN ({said}) USING ({k}, effective_from_dttm))"""
    if check == "check_multiple_current_records":
        return f"""SELECT {out} FROM {t} WHERE effective_to_dttm = {OPEN}
  AND {k} IN (SELECT {k} FROM {t} WHERE effective_to_dttm = {OPEN} GROUP BY {k} HAVING COUNT(*) > 1)"""
    if check == "check_gaps_in_history":
        return f"""SELECT {out} FROM (SELECT *, LEAD(effective_from_dttm) OVER (PARTITION BY {k} ORDER BY effective_from_dttm, effective_to_dttm, version_id) AS nx FROM {t})
WHERE effective_to_dttm <> {OPEN} AND nx IS NOT NULL AND nx > effective_to_dttm"""
    if check == "check_referential_integrity":
        return f"""SELECT DISTINCT CAST(t.{k} AS VARCHAR) AS bk_value, t.version_id, t.effective_from_dttm, t.effective_to_dttm
FROM {t} t LEFT JOIN {V(s.hub, m)} h ON t.{k} = h.{k} WHERE h.{k} IS NULL"""
    if check == "check_invalid_intervals":
        return f"SELECT {out} FROM {t} WHERE effective_from_dttm > effective_to_dttm"
    if check == "check_duplicate_keys":
        return f"""SELECT CAST(t.{k} AS VARCHAR) AS bk_value, t.version_id, t.effective_from_dttm, t.effective_to_dttm FROM {t} t
JOIN (SELECT {k}, effective_from_dttm FROM {t} GROUP BY 1, 2 HAVING COUNT(*) > 1) d ON t.{k} = d.{k} AND t.effective_from_dttm = d.effective_from_dttm"""
    if check == "check_null_hash_diff":
        return f"SELECT {out} FROM {t} WHERE {s.hash_col} IS NULL"
    raise KeyError(check)


from hvault.operators.quality import CHECK_NAMES  # noqa: E402

_DQ_QUERY = {
    "dq_overlap": "check_overlapping_intervals",
    "dq_explicit_deletion": "check_explicit_deletion",
    "dq_multiple_current": "check_multiple_current_records",
    "dq_gaps": "check_gaps_in_history",
    "dq_orphans": "check_referential_integrity",
    "dq_invalid_interval": "check_invalid_intervals",
    "dq_duplicate_keys": "check_duplicate_keys",
    "dq_null_required": "check_null_hash_diff",
}
for _q, _c in _DQ_QUERY.items():
    Q[_q] = "\nUNION ALL\n".join(
        f"SELECT bk_value, version_id, effective_from_dttm, {nul('effective_to_dttm')}, '{n}' AS table_name FROM ({_dq_check_sql(n, _c)})" for n in DQ_TABLES
    )

for _m in MODES:
    cte(f"{_m}_dq_results", "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS table_name, '{c}' AS test_name, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  string_agg(DISTINCT CAST(version_id AS VARCHAR), '#' ORDER BY CAST(version_id AS VARCHAR)) AS versions, COUNT(*) AS error_count,
  {tsl(LOAD_TS[1])} AS check_timestamp FROM ({_dq_check_sql(n, c, _m)})"""
        for n in DQ_TABLES for c in CHECK_NAMES
    ))
Q["dq_results"] = "SELECT * FROM s_dq_results"
Q["dq_results_ref"] = "SELECT * FROM r_dq_results"
Q["dq_summary"] = f"""SELECT table_name, COUNT(*) AS total_tests, CAST(SUM(CASE WHEN result = 'PASS' THEN 1 ELSE 0 END) AS BIGINT) AS passed_tests,
  CAST(SUM(CASE WHEN result = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS failed_tests,
  {rate("SUM(CASE WHEN result = 'PASS' THEN 1 ELSE 0 END) * 100", 'COUNT(*)', 2)} AS pass_rate_percent
FROM s_dq_results GROUP BY table_name"""
Q["dq_failures"] = "SELECT table_name, test_name, versions FROM r_dq_results WHERE result = 'FAIL'"


# --- assembly ----------------------------------------------------------------------

# CTEs DuckDB must compute once as written (its join reordering through the
# transaction view's range join blows up memory otherwise).
MATERIALIZED = {"s_txi", "r_txi", "s_tail_info", "r_tail_info"}

_NAME_RE = re.compile(r"\b[a-z][a-z0-9_]*\b")


def _deps(sql: str) -> list[str]:
    return [t for t in dict.fromkeys(_NAME_RE.findall(sql)) if t in CTES]


def build(sql: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(CTES[name]):
            if d != name:
                visit(d)
        order.append(name)

    for d in _deps(sql):
        visit(d)
    if not order:
        return sql.strip()
    body = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}(\n{CTES[n].strip()}\n)" for n in order)
    return f"WITH {body}\n{sql.strip()}"


ORACLES: dict[str, str] = {name: build(sql) for name, sql in Q.items()}

cte("ups_rows", f"""
SELECT acc_x_app_hash_key, {ts('create_dttm')} AS effective_from_dttm, MIN(COALESCE({ts('delete_dttm')}, {OPEN})) AS effective_to_dttm
FROM stg_crm_account_2 GROUP BY 1, 2""")
Q["upsert_interval"] = f"""
SELECT acc_x_app_hash_key, version_id, effective_from_dttm, {nul('effective_to_dttm')}, src_cd FROM (
  SELECT * FROM s_lsat_acc_x_app_1 t WHERE NOT EXISTS (SELECT 1 FROM ups_rows r WHERE r.acc_x_app_hash_key = t.acc_x_app_hash_key)
  UNION ALL
  SELECT COALESCE(t.acc_x_app_hash_key, r.acc_x_app_hash_key), COALESCE(t.version_id, 2), COALESCE(t.effective_from_dttm, r.effective_from_dttm),
    COALESCE(r.effective_to_dttm, t.effective_to_dttm), COALESCE(t.src_cd, 'CRM')
  FROM (SELECT * FROM s_lsat_acc_x_app_1 x WHERE EXISTS (SELECT 1 FROM ups_rows y WHERE y.acc_x_app_hash_key = x.acc_x_app_hash_key)) t
  FULL OUTER JOIN ups_rows r ON t.acc_x_app_hash_key = r.acc_x_app_hash_key AND t.effective_from_dttm = r.effective_from_dttm)"""
ORACLES["upsert_interval"] = build(Q["upsert_interval"])

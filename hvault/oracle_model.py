"""The warehouse model as the oracle states it, independent of the Spark specs.

Fixed values: table, key, source and column names and the types of the
attributes, one line per table. Fields are split by ``|``.
"""

from __future__ import annotations

from types import SimpleNamespace

# entity | hash column = id column | link hash = id columns | optional hash = reference id, own id | hash diff = columns | look-up list: code, name
STAGING_LINES = """
advert_source | | | | |
application | application_hash_key = application_id; customer_hash_key = customer_id | cust_x_app_hash_key = customer_id, application_id | | hash_diff = product_type_nm | product_type: product_type_cd, product_type_nm
cab_customer | customer_hash_key = customer_id | | | hash_diff = first_nm, last_nm, middle_nm, birth_dt, passport_num; hash_diff_con = phone_num, add_phone_num, email, reg_address_txt, fact_address_txt |
crm_account | account_hash_key = account_id; application_hash_key = application_id | acc_x_app_hash_key = account_id, application_id | | hash_diff = account_type_nm, account_create_dt | crm_account_status_type: account_type_cd, account_type_nm; crm_account_status: account_status_cd, account_status_nm
crm_customer | customer_hash_key = customer_id | | | hash_diff = first_nm, last_nm, birth_dt; hash_diff_con = phone_num, email |
crm_transaction | transaction_hash_key = transaction_id; account_hash_key = account_id | acc_x_trans_hash_key = account_id, transaction_id; trans_x_orig_trans_hash_key = transaction_id, orig_id | orig_transaction_hash_key = orig_id, transaction_id | hash_diff = transaction_amt, transaction_dttm, transaction_type_nm | crm_transaction_type: transaction_type_cd, transaction_type_nm
service_request | request_hash_key = service_request_id; customer_hash_key = customer_id | cust_x_req_hash_key = customer_id, service_request_id | | hash_diff = tail_limit, service_request_type_nm, service_request_status_nm | service_request_type: service_request_type_cd, service_request_type_nm; service_request_status: service_request_status_cd, service_request_status_nm
"""

# hub | key | id column | source code | entity: key column, id column | column that stays NULL
HUB_LINES = """
hub_account | account_hash_key | account_id | CRM | crm_account: account_hash_key, account_id; crm_transaction: account_hash_key, account_id |
hub_customer | customer_hash_key | customer_id | CAB | cab_customer: customer_hash_key, customer_id; crm_customer: customer_hash_key, customer_id; application: customer_hash_key, customer_id; service_request: customer_hash_key, customer_id | crm_customer_id
hub_request | request_hash_key | service_request_id | CAB | service_request: request_hash_key, service_request_id |
hub_transaction | transaction_hash_key | transaction_id | CRM | crm_transaction: transaction_hash_key, transaction_id; crm_transaction: orig_transaction_hash_key, orig_id |
hub_application | application_hash_key | application_id | CRM | application: application_hash_key, application_id; crm_account: application_hash_key, application_id |
"""

# link | key | hub keys | entity | column that must not be NULL (its satellite is lsat_<rest of the name>; source code CRM)
LINK_LINES = """
link_acc_x_app | acc_x_app_hash_key | account_hash_key, application_hash_key | crm_account |
link_cust_x_app | cust_x_app_hash_key | customer_hash_key, application_hash_key | application |
link_cust_x_req | cust_x_req_hash_key | request_hash_key, customer_hash_key | service_request |
link_acc_x_trans | acc_x_trans_hash_key | account_hash_key, transaction_hash_key | crm_transaction |
link_trans_x_orig_trans | trans_x_orig_trans_hash_key | transaction_hash_key, orig_transaction_hash_key | crm_transaction | orig_transaction_hash_key
"""

# satellite | key | entity | source code | hash column | attributes with their type (none: VARCHAR)
SATELLITE_LINES = """
hsat_account | account_hash_key | crm_account | CRM | hash_diff | account_type_nm, account_create_dt DATE
hsat_account_status | account_hash_key | crm_account | CRM | hash_diff | account_status_nm
hsat_application | application_hash_key | application | CRM | hash_diff | product_type_nm
hsat_crm_customer | customer_hash_key | crm_customer | CRM | hash_diff | first_nm, last_nm, birth_dt DATE
hsat_cab_customer | customer_hash_key | cab_customer | CAB | hash_diff | first_nm, last_nm, middle_nm, birth_dt DATE, passport_num
hsat_crm_customer_contact | customer_hash_key | crm_customer | CRM | hash_diff_con | phone_num, email
hsat_cab_customer_contact | customer_hash_key | cab_customer | CAB | hash_diff_con | phone_num, add_phone_num, email, reg_address_txt, fact_address_txt
hsat_request | request_hash_key | service_request | CAB | hash_diff | tail_limit INTEGER, service_request_type_nm
hsat_request_status | request_hash_key | service_request | CAB | hash_diff | service_request_status_nm
hsat_transaction | transaction_hash_key | crm_transaction | CRM | hash_diff | transaction_amt DECIMAL(18;2), transaction_type_nm, transaction_dttm TIMESTAMP
"""

# satellites of the data-quality view and the hub of each
CHECKED = {
    "hsat_account": "hub_account",
    "hsat_account_status": "hub_account",
    "hsat_application": "hub_application",
    "hsat_crm_customer": "hub_customer",
    "hsat_cab_customer": "hub_customer",
    "hsat_request": "hub_request",
    "hsat_request_status": "hub_request",
    "hsat_transaction": "hub_transaction",
}


def _lines(text: str):
    return [[f.strip() for f in line.split("|")] for line in text.strip().splitlines()]


def _names(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


def _pairs(text: str, sep: str) -> list[tuple[str, list[str]]]:
    return [(a.strip(), _names(b)) for a, b in (x.split(sep) for x in text.split(";") if x.strip())]


STAGING = {
    e: SimpleNamespace(
        keys={h: c[0] for h, c in _pairs(keys, "=")},
        links=dict(_pairs(links, "=")),
        optional_keys=dict(_pairs(optional, "=")),
        hash_diffs=dict(_pairs(diffs, "=")),
        lookups=[SimpleNamespace(ref=r, code=c[0], name=c[1]) for r, c in _pairs(lookups, ":")],
    )
    for e, keys, links, optional, diffs, lookups in _lines(STAGING_LINES)
}
HUBS = {
    n: SimpleNamespace(name=n, key=k, id_col=i, src_cd=s, sources=[(e, *c) for e, c in _pairs(src, ":")], extra=extra)
    for n, k, i, s, src, extra in _lines(HUB_LINES)
}
LINKS = {
    n: SimpleNamespace(name=n, key=k, hub_keys=_names(h), staging=e, require=r, src_cd="CRM", lsat="lsat_" + n.removeprefix("link_"))
    for n, k, h, e, r in _lines(LINK_LINES)
}
SATS = {
    n: SimpleNamespace(
        name=n, key=k, staging=e, src_cd=s, hash_col=h, hub=CHECKED.get(n, ""),
        attrs=[(a.split()[0], (a.split()[1:] or ["VARCHAR"])[0].replace(";", ",")) for a in _names(attrs)],
    )
    for n, k, e, s, h, attrs in _lines(SATELLITE_LINES)
}
DQ_TABLES = list(CHECKED)

"""The bank's warehouse model as declarative specs: staging, 5 hubs, 5 links
with their validity satellites, 10 hub satellites."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from hvault.functions.keys import MONEY, md5_coalesce, md5_concat_ws, to_date, to_int, to_money, to_ts
from hvault.operators.staging import Lookup, StageSpec

STAGING: dict[str, StageSpec] = {
    "advert_source": StageSpec("advert_source"),
    "application": StageSpec(
        "application",
        keys={"application_hash_key": "application_id", "customer_hash_key": "customer_id"},
        links={"cust_x_app_hash_key": ("customer_id", "application_id")},
        hash_diffs={"hash_diff": ("product_type_nm",)},
        lookups=(Lookup("product_type", "product_type_cd", "product_type_nm"),),
    ),
    "cab_customer": StageSpec(
        "cab_customer",
        keys={"customer_hash_key": "customer_id"},
        hash_diffs={
            "hash_diff": ("first_nm", "last_nm", "middle_nm", "birth_dt", "passport_num"),
            "hash_diff_con": ("phone_num", "add_phone_num", "email", "reg_address_txt", "fact_address_txt"),
        },
    ),
    "crm_account": StageSpec(
        "crm_account",
        keys={"account_hash_key": "account_id", "application_hash_key": "application_id"},
        links={"acc_x_app_hash_key": ("account_id", "application_id")},
        hash_diffs={"hash_diff": ("account_type_nm", "account_create_dt")},
        lookups=(
            Lookup("crm_account_status_type", "account_type_cd", "account_type_nm"),
            Lookup("crm_account_status", "account_status_cd", "account_status_nm"),
        ),
    ),
    "crm_customer": StageSpec(
        "crm_customer",
        keys={"customer_hash_key": "customer_id"},
        hash_diffs={"hash_diff": ("first_nm", "last_nm", "birth_dt"), "hash_diff_con": ("phone_num", "email")},
    ),
    "crm_transaction": StageSpec(
        "crm_transaction",
        keys={"transaction_hash_key": "transaction_id", "account_hash_key": "account_id"},
        optional_keys={"orig_transaction_hash_key": ("orig_id", "transaction_id")},
        links={
            "acc_x_trans_hash_key": ("account_id", "transaction_id"),
            "trans_x_orig_trans_hash_key": ("transaction_id", "orig_id"),
        },
        hash_diffs={"hash_diff": ("transaction_amt", "transaction_dttm", "transaction_type_nm")},
        lookups=(Lookup("crm_transaction_type", "transaction_type_cd", "transaction_type_nm"),),
    ),
    "service_request": StageSpec(
        "service_request",
        keys={"request_hash_key": "service_request_id", "customer_hash_key": "customer_id"},
        links={"cust_x_req_hash_key": ("customer_id", "service_request_id")},
        hash_diffs={"hash_diff": ("tail_limit", "service_request_type_nm", "service_request_status_nm")},
        lookups=(
            Lookup("service_request_type", "service_request_type_cd", "service_request_type_nm"),
            Lookup("service_request_status", "service_request_status_cd", "service_request_status_nm"),
        ),
    ),
}


@dataclass(frozen=True)
class HubSpec:
    name: str
    key: str
    id_col: str
    src_cd: str
    # (staged entity, key column there, id column there, only rows with a key)
    sources: Sequence[tuple[str, str, str]]
    extra: Sequence[tuple[str, DataType]] = ()

    @property
    def schema(self) -> StructType:
        return StructType(
            [StructField(self.key, StringType()), StructField(self.id_col, StringType())]
            + [StructField(c, t) for c, t in self.extra]
            + [StructField("load_dttm", TimestampNTZType()), StructField("src_cd", StringType())]
        )


HUBS: dict[str, HubSpec] = {
    h.name: h
    for h in [
        HubSpec("hub_account", "account_hash_key", "account_id", "CRM", [("crm_account", "account_hash_key", "account_id"), ("crm_transaction", "account_hash_key", "account_id")]),
        HubSpec(
            "hub_customer",
            "customer_hash_key",
            "customer_id",
            "CAB",
            [("cab_customer", "customer_hash_key", "customer_id"), ("crm_customer", "customer_hash_key", "customer_id"), ("application", "customer_hash_key", "customer_id"), ("service_request", "customer_hash_key", "customer_id")],
            extra=[("crm_customer_id", StringType())],
        ),
        HubSpec("hub_request", "request_hash_key", "service_request_id", "CAB", [("service_request", "request_hash_key", "service_request_id")]),
        HubSpec("hub_transaction", "transaction_hash_key", "transaction_id", "CRM", [("crm_transaction", "transaction_hash_key", "transaction_id"), ("crm_transaction", "orig_transaction_hash_key", "orig_id")]),
        HubSpec("hub_application", "application_hash_key", "application_id", "CRM", [("application", "application_hash_key", "application_id"), ("crm_account", "application_hash_key", "application_id")]),
    ]
}


@dataclass(frozen=True)
class LinkSpec:
    name: str  # link table; the satellite is lsat_<suffix>
    key: str
    hub_keys: Sequence[str]
    staging: str
    src_cd: str = "CRM"
    require: str | None = None  # staged column that must be non-NULL

    @property
    def lsat(self) -> str:
        return "lsat_" + self.name[len("link_"):]

    @property
    def schema(self) -> StructType:
        return StructType(
            [StructField(self.key, StringType())]
            + [StructField(h, StringType()) for h in self.hub_keys]
            + [StructField("load_dttm", TimestampNTZType()), StructField("src_cd", StringType())]
        )

    @property
    def lsat_schema(self) -> StructType:
        return StructType(
            [
                StructField(self.key, StringType()),
                StructField("version_id", LongType()),
                StructField("effective_from_dttm", TimestampNTZType()),
                StructField("effective_to_dttm", TimestampNTZType()),
                StructField("src_cd", StringType()),
            ]
        )


LINKS: dict[str, LinkSpec] = {
    s.name: s
    for s in [
        LinkSpec("link_acc_x_app", "acc_x_app_hash_key", ("account_hash_key", "application_hash_key"), "crm_account"),
        LinkSpec("link_cust_x_app", "cust_x_app_hash_key", ("customer_hash_key", "application_hash_key"), "application"),
        LinkSpec("link_cust_x_req", "cust_x_req_hash_key", ("request_hash_key", "customer_hash_key"), "service_request"),
        LinkSpec("link_acc_x_trans", "acc_x_trans_hash_key", ("account_hash_key", "transaction_hash_key"), "crm_transaction"),
        LinkSpec(
            "link_trans_x_orig_trans",
            "trans_x_orig_trans_hash_key",
            ("transaction_hash_key", "orig_transaction_hash_key"),
            "crm_transaction",
            require="orig_transaction_hash_key",
        ),
    ]
}


@dataclass(frozen=True)
class SatSpec:
    name: str
    key: str
    staging: str
    src_cd: str
    hash_col: str
    # attribute -> (type, expression over the staged row)
    attrs: Sequence[tuple[str, DataType, Callable[[], Column]]]
    hash_expr: Callable[[], Column] | None = None  # recomputed hash instead of the staged one
    hub: str = ""

    @property
    def attr_names(self) -> list[str]:
        return [a for a, _, _ in self.attrs]

    @property
    def schema(self) -> StructType:
        return StructType(
            [
                StructField(self.key, StringType()),
                StructField("version_id", LongType()),
                StructField(self.hash_col, StringType()),
                StructField("effective_from_dttm", TimestampNTZType()),
                StructField("effective_to_dttm", TimestampNTZType()),
                StructField("src_cd", StringType()),
            ]
            + [StructField(a, t) for a, t, _ in self.attrs]
        )


def _s(c: str) -> Callable[[], Column]:
    return lambda: F.col(c)


SATS: dict[str, SatSpec] = {
    s.name: s
    for s in [
        SatSpec("hsat_account", "account_hash_key", "crm_account", "CRM", "hash_diff",
                [("account_type_nm", StringType(), _s("account_type_nm")), ("account_create_dt", DateType(), lambda: to_date("account_create_dt"))],
                hub="hub_account"),
        SatSpec("hsat_account_status", "account_hash_key", "crm_account", "CRM", "hash_diff",
                [("account_status_nm", StringType(), _s("account_status_nm"))],
                hash_expr=lambda: md5_coalesce("account_status_nm"), hub="hub_account"),
        SatSpec("hsat_application", "application_hash_key", "application", "CRM", "hash_diff",
                [("product_type_nm", StringType(), _s("product_type_nm"))], hub="hub_application"),
        SatSpec("hsat_crm_customer", "customer_hash_key", "crm_customer", "CRM", "hash_diff",
                [("first_nm", StringType(), _s("first_nm")), ("last_nm", StringType(), _s("last_nm")), ("birth_dt", DateType(), lambda: to_date("birth_dt"))],
                hub="hub_customer"),
        SatSpec("hsat_cab_customer", "customer_hash_key", "cab_customer", "CAB", "hash_diff",
                [("first_nm", StringType(), _s("first_nm")), ("last_nm", StringType(), _s("last_nm")), ("middle_nm", StringType(), _s("middle_nm")),
                 ("birth_dt", DateType(), lambda: to_date("birth_dt")), ("passport_num", StringType(), _s("passport_num"))],
                hub="hub_customer"),
        SatSpec("hsat_crm_customer_contact", "customer_hash_key", "crm_customer", "CRM", "hash_diff_con",
                [("phone_num", StringType(), _s("phone_num")), ("email", StringType(), _s("email"))],
                hash_expr=lambda: md5_concat_ws(["phone_num", "email"]), hub="hub_customer"),
        SatSpec("hsat_cab_customer_contact", "customer_hash_key", "cab_customer", "CAB", "hash_diff_con",
                [("phone_num", StringType(), _s("phone_num")), ("add_phone_num", StringType(), _s("add_phone_num")), ("email", StringType(), _s("email")),
                 ("reg_address_txt", StringType(), _s("reg_address_txt")), ("fact_address_txt", StringType(), _s("fact_address_txt"))],
                hub="hub_customer"),
        SatSpec("hsat_request", "request_hash_key", "service_request", "CAB", "hash_diff",
                [("tail_limit", IntegerType(), lambda: to_int("tail_limit")), ("service_request_type_nm", StringType(), _s("service_request_type_nm"))],
                hub="hub_request"),
        SatSpec("hsat_request_status", "request_hash_key", "service_request", "CAB", "hash_diff",
                [("service_request_status_nm", StringType(), _s("service_request_status_nm"))],
                hash_expr=lambda: md5_coalesce("service_request_status_nm"), hub="hub_request"),
        SatSpec("hsat_transaction", "transaction_hash_key", "crm_transaction", "CRM", "hash_diff",
                [("transaction_amt", MONEY, lambda: to_money("transaction_amt")), ("transaction_type_nm", StringType(), _s("transaction_type_nm")),
                 ("transaction_dttm", TimestampNTZType(), lambda: to_ts("transaction_dttm"))],
                hub="hub_transaction"),
    ]
}

# Tables covered by the data-quality result view, with the staging entity the
# explicit-deletion check reads (the two contact satellites are not covered).
DQ_TABLES = [
    "hsat_account",
    "hsat_account_status",
    "hsat_application",
    "hsat_crm_customer",
    "hsat_cab_customer",
    "hsat_request",
    "hsat_request_status",
    "hsat_transaction",
]

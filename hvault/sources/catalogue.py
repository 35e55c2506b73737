"""Source catalogue: the extract entities, their columns and header flags.

Every source column is text at the edge; types are applied on entry to the
core layer (``hvault.functions.to_ts`` and friends).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType


@dataclass(frozen=True)
class SourceSpec:
    entity: str
    columns: tuple[str, ...]
    has_header: bool

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, StringType(), True) for c in self.columns])

    @property
    def ddl(self) -> str:
        return ", ".join(f"{c} STRING" for c in self.columns)

    @property
    def header_line(self) -> str:
        return ",".join(self.columns)

    @property
    def is_reference_list(self) -> bool:
        name = self.entity.lower()
        return "type" in name or "status" in name


# Entity names, column order and header flags of the extracts.
_CATALOGUE = [
    ("advert_source", "advert_source_id advert_source_nm monthly_payment_amt start_month end_month create_dttm delete_dttm last_update", True),
    ("application", "application_id product_type_cd customer_id advert_source_id create_dttm delete_dttm last_update", False),
    ("cab_customer", "customer_id birth_dt passport_num phone_num add_phone_num email reg_address_txt fact_address_txt first_nm last_nm middle_nm create_dttm delete_dttm last_update", True),
    ("crm_account", "account_id account_type_cd account_create_dt account_status_cd application_id create_dttm delete_dttm last_update", True),
    ("crm_account_status", "account_status_cd account_status_nm last_update", True),
    ("crm_account_status_type", "account_type_cd account_type_nm last_update", True),
    ("crm_customer", "crm_customer_id customer_id birth_dt phone_num email first_nm last_nm create_dttm delete_dttm last_update", True),
    ("crm_transaction", "transaction_id orig_id account_id transaction_type_cd transaction_amt transaction_dttm create_dttm delete_dttm last_update", False),
    ("crm_transaction_type", "transaction_type_cd transaction_type_nm last_update", True),
    ("product_type", "product_type_cd product_type_nm last_update", True),
    ("service_request", "service_request_id customer_id service_request_type_cd service_request_status_cd tail_limit create_dttm delete_dttm last_update", False),
    ("service_request_status", "service_request_status_cd service_request_status_nm last_update", True),
    ("service_request_type", "service_request_type_cd service_request_type_nm last_update", True),
]

CATALOGUE: dict[str, SourceSpec] = {
    name: SourceSpec(name, tuple(cols.split()), header) for name, cols, header in _CATALOGUE
}

REFERENCE_LISTS = [s.entity for s in CATALOGUE.values() if s.is_reference_list]


def catalogue_frame(spark: SparkSession) -> DataFrame:
    """The catalogue as a table (entity_name, columns_def, has_header, n_columns, is_reference_list)."""
    rows = [
        (s.entity, s.ddl, s.has_header, len(s.columns), s.is_reference_list)
        for s in CATALOGUE.values()
    ]
    schema = StructType(
        [
            StructField("entity_name", StringType(), False),
            StructField("columns_def", StringType(), False),
            StructField("has_header", BooleanType(), False),
            StructField("n_columns", IntegerType(), False),
            StructField("is_reference_list", BooleanType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)

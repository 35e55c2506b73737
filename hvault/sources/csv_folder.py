"""CSV folder sources: every ``*.csv`` file in an entity's folder is one table.

The scan stays distributed: files are read as lines by the executors, the
header line of *each* file is dropped, every ``""`` pair is removed from the
text (an empty quoted field then reads as NULL, doubled quotes vanish), and
the line is parsed with the entity's all-string schema. A header line may be
quoted. A line that does not fit the schema (too few or too many fields, an
open quote) is an error, or, with ``on_error="report"``, a row whose
``_corrupt_record`` holds the line. Quoted fields that contain line breaks need
``multi_line=True``: then each file is parsed whole by one task, and the same
scrubbing is done on the parsed fields.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from hvault.sources.catalogue import SourceSpec

CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}


CORRUPT = "_corrupt_record"


def write_folder(df: DataFrame, root: str, spec: SourceSpec, mode: str = "overwrite") -> str:
    """Write an entity as CSV files, one per partition (with a header line in each when the spec has one)."""
    path = f"{root.rstrip('/')}/{spec.entity}"
    df.select(*spec.columns).write.mode(mode).options(header=str(spec.has_header).lower(), **CSV_OPTIONS).csv(path)
    return path


def _modes(on_error: str) -> dict[str, str]:
    if on_error not in ("fail", "report"):
        raise ValueError(f"on_error is 'fail' or 'report', not {on_error!r}")
    return {"mode": "FAILFAST"} if on_error == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_lines(lines: DataFrame, spec: SourceSpec, on_error: str = "fail") -> DataFrame:
    """Rows of a frame with one CSV line per row in ``value``; empty lines and header lines are left out."""
    lines = lines.filter(F.length("value") > 0)
    if spec.has_header:
        plain = F.regexp_replace(F.trim("value"), '"', "")
        lines = lines.filter(plain != spec.header_line)
    ddl = spec.ddl if on_error == "fail" else f"{spec.ddl}, {CORRUPT} STRING"
    parsed = F.from_csv(F.regexp_replace("value", '""', ""), ddl, CSV_OPTIONS | _modes(on_error))
    return lines.select(parsed.alias("_r")).select("_r.*")


def scan_folder(spark: SparkSession, root: str, spec: SourceSpec, scrub_quotes: bool = True, multi_line: bool = False, on_error: str = "fail") -> DataFrame:
    path = f"{root.rstrip('/')}/{spec.entity}/*.csv"
    if scrub_quotes and not multi_line:
        return parse_lines(spark.read.text(path), spec, on_error)
    schema = spec.schema if on_error == "fail" else spec.schema.add(CORRUPT, StringType())
    reader = spark.read.options(header=str(spec.has_header).lower(), multiLine=str(multi_line).lower(), enforceSchema="true", **CSV_OPTIONS, **_modes(on_error))
    rows = reader.schema(schema).csv(path)
    if not scrub_quotes:
        return rows
    return rows.select(*[F.nullif(F.regexp_replace(c, '"', ""), F.lit("")).alias(c) if c != CORRUPT else F.col(c) for c in rows.columns])


REPORT_SCHEMA = StructType(
    [
        StructField("entity_name", StringType(), False),
        StructField("ok", BooleanType(), False),
        StructField("error", StringType(), True),
        StructField("source_rows", LongType(), True),
    ]
)


def register_all(spark: SparkSession, root: str, specs: Iterable[SourceSpec], prefix: str = "source_") -> tuple[dict[str, DataFrame], DataFrame]:
    """Scan every entity, count it in a job of its own and register it as a temp
    view. An entity that cannot be listed or parsed is a warning and a row of
    the report with the whole error; the others go on."""
    frames: dict[str, DataFrame] = {}
    report: list[tuple] = []
    for spec in specs:
        try:
            df = scan_folder(spark, root, spec)
            # reading every field finds a broken line here and not in a later query
            rows = df.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.length(c)) for c in df.columns]).first()["n"]
            df.createOrReplaceTempView(prefix + spec.entity)
            frames[spec.entity] = df
            report.append((spec.entity, True, None, rows))
        except Exception as exc:  # noqa: BLE001 - reported per entity
            warnings.warn(f"source {spec.entity} not registered: {exc}")
            report.append((spec.entity, False, str(exc), None))
    return frames, spark.createDataFrame(report, REPORT_SCHEMA)

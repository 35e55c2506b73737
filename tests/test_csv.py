"""CSV edge: malformed lines fail loudly, headers may be quoted, fields may span lines, entities fail alone."""

import warnings

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from hvault.sources import csv_folder
from hvault.sources.catalogue import CATALOGUE

SPEC = CATALOGUE["crm_account_status"]  # account_status_cd, account_status_nm, last_update; with a header


def put(tmp_path, text, spec=SPEC, name="a.csv"):
    (tmp_path / spec.entity).mkdir(exist_ok=True)
    (tmp_path / spec.entity / name).write_text(text)
    return str(tmp_path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_header_per_file_plain_or_quoted(spark, tmp_path):
    put(tmp_path, SPEC.header_line + "\nF,fin,2000-01-01\n\n")
    root = put(tmp_path, ",".join(f'"{c}"' for c in SPEC.columns) + '\n"O","a""b",""\n', name="b.csv")
    assert rows(csv_folder.scan_folder(spark, root, SPEC)) == [("F", "fin", "2000-01-01"), ("O", "ab", None)]


@pytest.mark.parametrize("line", ["F,fin,2000-01-01,extra", "F,fin", '"F,fin,2000-01-01'])
def test_malformed_line_fails_or_is_reported(spark, tmp_path, line):
    root = put(tmp_path, f"{SPEC.header_line}\nO,open,2001-01-01\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_folder.scan_folder(spark, root, SPEC).collect()
    out = csv_folder.scan_folder(spark, root, SPEC, on_error="report").collect()
    assert sorted(r[csv_folder.CORRUPT] is not None for r in out) == [False, True]


def test_multi_line_field(spark, tmp_path):
    root = put(tmp_path, f'{SPEC.header_line}\n"F","two\nlines",""\nO,"a""b",x\n')
    assert rows(csv_folder.scan_folder(spark, root, SPEC, multi_line=True)) == [("F", "two\nlines", None), ("O", "ab", "x")]
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_folder.scan_folder(spark, root, SPEC).collect()


def test_round_trip(spark, tmp_path):
    schema = StructType([StructField(c, StringType()) for c in SPEC.columns])
    df = spark.createDataFrame([("a", "b,c", None), (None, "d", "e")], schema)
    csv_folder.write_folder(df, str(tmp_path), SPEC)
    assert rows(csv_folder.scan_folder(spark, str(tmp_path), SPEC)) == rows(df)


def test_one_bad_entity_does_not_stop_the_others(spark, tmp_path):
    other = CATALOGUE["product_type"]
    put(tmp_path, f"{SPEC.header_line}\nF\n")
    root = put(tmp_path, f"{other.header_line}\n1,x,2000-01-01\n", spec=other)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        frames, report = csv_folder.register_all(spark, root, [SPEC, other, CATALOGUE["crm_account"]])
    got = {r.entity_name: r for r in report.collect()}
    assert set(frames) == {"product_type"} and got["product_type"].source_rows == 1
    assert not got[SPEC.entity].ok and not got["crm_account"].ok and len(got[SPEC.entity].error) > 500

from decimal import Decimal

from pyspark.sql import functions as F

from hvault.functions import composite_hash, hash_key, md5_concat_ws, optional_hash_key, ratio, roundup_amount, to_money


def test_hash_key_normalises_null_blank_case_and_spaces(spark):
    df = spark.createDataFrame([(None,), ("",), (" a1 ",), ("A1",)], "x string")
    got = [r[0] for r in df.select(hash_key("x")).collect()]
    assert got[0] == got[1] == "D41D8CD98F00B204E9800998ECF8427E"
    assert got[2] == got[3] == "27F237E6B7F96587B6202FF3607AD88A"


def test_composite_hash_joins_trimmed_parts_with_colon(spark):
    df = spark.createDataFrame([(" c1", "a2 ")], "c string, a string")
    got = df.select(composite_hash(["c", "a"]).alias("h"), hash_key(F.lit("c1:a2")).alias("ref")).first()
    assert got.h == got.ref


def test_md5_concat_ws_skips_nulls(spark):
    df = spark.createDataFrame([(None, "e")], "p string, e string")
    got = df.select(md5_concat_ws(["p", "e"]).alias("h"), F.md5(F.lit("e")).alias("ref")).first()
    assert got.h == got.ref


def test_optional_hash_key_is_null_for_self_reference(spark):
    df = spark.createDataFrame([("t1", "t1"), ("t2", "t1"), ("t3", None)], "id string, orig string")
    got = [r[0] for r in df.select(optional_hash_key("orig", "id")).collect()]
    assert got[0] is None and got[1] is not None and got[2] is None


def test_roundup_amount_examples(spark):
    # limit 47: 52 is rounded up to 90 (38 booked), 53 to 100 (47 booked)
    df = spark.createDataFrame([("52.00", 47), ("53.00", 47)], "a string, lim int")
    got = [r[0] for r in df.select(roundup_amount(to_money("a"), F.col("lim"))).collect()]
    assert got == [Decimal("38.00"), Decimal("47.00")]


def test_ratio_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [Decimal("0.13"), Decimal("0.33"), None]

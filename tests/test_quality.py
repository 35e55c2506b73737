from conftest import OPEN, day
from hvault.operators import quality as dq

SAT = "k string, version_id long, hash_diff string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz"


def _sat(spark, rows):
    return spark.createDataFrame([(k, v, h, day(s), day(e) if e is not None else OPEN) for k, v, h, s, e in rows], SAT)


def test_checks_find_broken_rows(spark):
    sat = _sat(spark, [
        ("a", 1, "h", 1, 10), ("a", 1, "h", 5, 12),     # overlap between closed rows
        ("b", 1, "h", 1, 3), ("b", 2, "h", 5, None),     # gap 3 -> 5
        ("c", 1, "h", 1, None), ("c", 2, None, 4, None),  # two open rows, NULL hash
        ("d", 1, "h", 9, 2),                              # from > to
        ("e", 1, "h", 1, 2), ("e", 3, "h", 1, 4),         # duplicate (key, from)
    ])
    assert {r.bk_value for r in dq.overlapping_intervals(sat, "k").collect()} >= {"a"}
    assert {r.bk_value for r in dq.gaps_in_history(sat, "k").collect()} >= {"b"}
    assert {r.bk_value for r in dq.multiple_current_records(sat, "k").collect()} == {"c"}
    assert {r.bk_value for r in dq.null_required_field(sat, "k", "hash_diff").collect()} == {"c"}
    assert {r.bk_value for r in dq.invalid_intervals(sat, "k").collect()} == {"d"}
    assert {r.bk_value for r in dq.duplicate_keys(sat, "k").collect()} == {"e"}
    hub = spark.createDataFrame([("a",), ("b",)], "k string")
    assert {r.bk_value for r in dq.referential_integrity(sat, hub, "k").collect()} == {"c", "d", "e"}


def test_results_summary_and_failures(spark):
    sat = _sat(spark, [("c", 1, "h", 1, None), ("c", 2, "h", 4, None), ("x", 7, "h", 1, None)])
    hub = spark.createDataFrame([("c",), ("x",)], "k string")
    staged = spark.createDataFrame([], "k string, create_dttm string, delete_dttm string")
    res = dq.results({"t": dq.checks_for(sat, "k", hub, staged)}, "2001-01-01 00:00:00")
    by = {r.test_name: r for r in res.collect()}
    assert by["check_multiple_current_records"].result == "FAIL"
    assert by["check_multiple_current_records"].versions == "1#2"
    assert by["check_gaps_in_history"].result == "PASS" and by["check_gaps_in_history"].versions is None
    s = dq.summary(res).first()
    assert (s.total_tests, s.failed_tests) == (8, 1)
    assert [r.test_name for r in dq.failures(res).collect()] == ["check_multiple_current_records"]


def test_one_pass_results_equal_check_by_check(spark):
    sat = _sat(spark, [
        ("a", 1, "h", 1, 10), ("a", 2, "h", 5, 12), ("a", 3, "h", 20, None),
        ("b", 1, "h", 1, 3), ("b", 2, "h", 5, None),
        ("c", 1, "h", 1, None), ("c", 2, None, 4, None),
        ("d", 1, "h", 9, 2),
        ("e", 1, "h", 1, 2), ("e", 3, "h", 1, 4),
    ])
    hub = spark.createDataFrame([("a",), ("b",)], "k string")
    staged = spark.createDataFrame([("a", "2000-01-06 00:00:00", "2000-01-09 00:00:00")], "k string, create_dttm string, delete_dttm string")
    slow = dq.results({"t": dq.checks_for(sat, "k", hub, staged)}, "2001-01-01 00:00:00")
    fast = dq.table_results(sat, "k", hub, staged, "t", "2001-01-01 00:00:00")
    cols = ["table_name", "test_name", "result", "versions", "error_count"]
    assert sorted(map(tuple, slow.select(cols).collect())) == sorted(map(tuple, fast.select(cols).collect()))
    assert {r.test_name for r in fast.collect() if r.result == "FAIL"} == {
        "check_overlapping_intervals", "check_explicit_deletion", "check_multiple_current_records", "check_gaps_in_history",
        "check_referential_integrity", "check_invalid_intervals", "check_duplicate_keys", "check_null_hash_diff",
    }


def _skewed_sat(spark):
    """Key "hot" holds 80 % of the rows; overlaps, gaps, open rows, same starts,
    NULL hashes and invalid intervals everywhere."""
    import random

    rnd = random.Random(11)
    rows = []
    for i in range(2500):
        k = "hot" if i % 5 else f"k{i % 23}"
        s = rnd.randrange(0, 4000)
        e = None if rnd.random() < 0.03 else s + rnd.choice([-2, 0, 1, 3, 8, 40])
        rows.append((k, i % 7, None if rnd.random() < 0.02 else "h", s, e))
    rows += [("hot", 3, "h", 17, 30), ("hot", 3, "h", 17, 30)]  # identical rows
    return _sat(spark, rows)


def test_history_flags_segmented_equal_plain(spark):
    sat = _skewed_sat(spark)
    cols = ["k", "version_id", "hash_diff", "effective_from_dttm", "effective_to_dttm", "_next", "_next_closed", "_n_open", "_n_start"]
    plain = dq.history_flags(sat, "k").select(cols)
    seg = dq.history_flags(sat, "k", hot_keys=True, partitions=11).select(cols)
    assert plain.count() == seg.count() == 2502
    assert plain.exceptAll(seg).count() == 0 and seg.exceptAll(plain).count() == 0


def test_table_results_hot_path_equal_plain(spark):
    sat = _skewed_sat(spark)
    hub = spark.createDataFrame([("hot",), ("k1",), ("k2",)], "k string")
    staged = spark.createDataFrame([("hot", "2000-01-18 00:00:00", "2000-01-20 00:00:00")], "k string, create_dttm string, delete_dttm string")
    cols = ["table_name", "test_name", "result", "versions", "error_count"]
    plain = dq.table_results(sat, "k", hub, staged, "t", "2001-01-01 00:00:00")
    hot = dq.table_results(sat, "k", hub, staged, "t", "2001-01-01 00:00:00", hot_keys=True)
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(map(tuple, hot.select(cols).collect()))
    for fn in (dq.overlapping_intervals, dq.gaps_in_history):
        a, b = fn(sat, "k"), fn(sat, "k", hot_keys=True)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_path_on_vault_tables_equals_plain(spark):
    """The segmented check plan on real satellites (sf0.001, both batches)."""
    from hvault.plans.model import DQ_TABLES, SATS
    from hvault.plans.pipeline import VaultStore
    from hvault.sources.adaptor import derive_sources

    st = VaultStore(spark, derive_sources(spark, "/root/testdata/sf0.001"), mode="reference")
    cols = ["table_name", "test_name", "result", "versions", "error_count"]
    for n in DQ_TABLES[:3]:
        s = SATS[n]
        args = (st.table(n), s.key, st.table(s.hub), st.staged(2)[s.staging], n, "2002-01-01 06:00:00", s.hash_col)
        plain = sorted(map(tuple, dq.table_results(*args).select(cols).collect()))
        hot = sorted(map(tuple, dq.table_results(*args, hot_keys=True).select(cols).collect()))
        assert plain == hot and len(plain) == 8

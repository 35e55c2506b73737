import pytest
from pyspark.sql import functions as F

from conftest import OPEN, day
from hvault.operators.intervals import REFERENCE, STRICT
from hvault.operators.staging import extract_window
from hvault.operators.vault import by_heat, load_hsat, load_hub, load_link

LSAT = "k string, version_id long, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, src_cd string"
LINK = "k string, h1 string, h2 string, load_dttm timestamp_ntz, src_cd string"
STAGED = "k string, h1 string, h2 string, create_dttm timestamp_ntz, delete_dttm timestamp_ntz"
SAT = "k string, version_id long, hash_diff string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, src_cd string, a string"
BATCH = "k string, hash_diff string, create_dttm timestamp_ntz, delete_dttm timestamp_ntz, a string, last_update timestamp_ntz"


def _iv(rows):
    inv = lambda t: "inf" if t is None or t == OPEN else (t - day(0)).days
    return sorted((r.k, inv(r.effective_from_dttm), inv(r.effective_to_dttm)) for r in rows)


def _link(spark, lsat_rows, staged_rows, mode):
    link = spark.createDataFrame([(k, "x", "y", day(0), "CRM") for k in sorted({r[0] for r in lsat_rows})], LINK)
    lsat = spark.createDataFrame([(k, 1, day(s), day(e) if e else OPEN, "CRM") for k, s, e in lsat_rows], LSAT)
    staged = spark.createDataFrame([(k, "x", "y", day(s), day(e)) for k, s, e in staged_rows], STAGED)
    res = load_link(link, lsat, staged, "k", ("h1", "h2"), "CRM", 2, "2001-01-01 00:00:00", mode)
    return res, _iv(res.lsat.collect())


def test_link_deletion_reference_stops_early(spark):
    res, rows = _link(spark, [("k", 1, None)], [("k", 1, 7)], REFERENCE)
    assert not res.loaded and rows == [("k", 1, "inf")]


def test_link_deletion_strict_closes(spark):
    res, rows = _link(spark, [("k", 1, None)], [("k", 1, 7)], STRICT)
    assert rows == [("k", 1, 7)]


def test_link_deletion_beside_new_key(spark):
    _, ref = _link(spark, [("k", 1, None)], [("k", 1, 7), ("m", 2, None)], REFERENCE)
    _, strict = _link(spark, [("k", 1, None)], [("k", 1, 7), ("m", 2, None)], STRICT)
    assert ref == [("k", 1, "inf"), ("m", 2, "inf")]
    assert strict == [("k", 1, 7), ("m", 2, "inf")]


def test_link_earlier_start(spark):
    res, ref = _link(spark, [("k", 5, None)], [("k", 3, None), ("m", 2, None)], REFERENCE)
    _, strict = _link(spark, [("k", 5, None)], [("k", 3, None), ("m", 2, None)], STRICT)
    assert ref == [("k", 3, "inf"), ("k", 5, "inf"), ("m", 2, "inf")]
    assert strict == [("k", 3, "inf"), ("m", 2, "inf")]
    assert sorted(r.k for r in res.link.collect()) == ["k", "m"]


def _sat(spark, target, batch, mode):
    t = spark.createDataFrame([("k", 1, f"h{s}", day(s), day(e) if e else OPEN, "CRM", f"old{s}") for s, e in target], SAT)
    b = spark.createDataFrame([("k", f"n{s}", day(s), day(e), f"new{s}", day(100)) for s, e in batch], BATCH)
    out = load_hsat(t, b, "k", "hash_diff", ["a"], "CRM", 2, mode)
    return out, _iv(out.collect())


@pytest.mark.parametrize("mode,expected", [(REFERENCE, [(5, "inf"), (10, "inf")]), (STRICT, [(5, 10), (10, "inf")])])
def test_satellite_new_version_predecessor_not_resent(spark, mode, expected):
    _, rows = _sat(spark, [(5, None)], [(10, None)], mode)
    assert [r[1:] for r in rows] == expected


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_satellite_predecessor_resent(spark, mode):
    _, rows = _sat(spark, [(5, None)], [(5, None), (10, None)], mode)
    assert [r[1:] for r in rows] == [(5, 10), (10, "inf")]


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_satellite_explicit_deletion(spark, mode):
    _, rows = _sat(spark, [], [(5, 8), (10, None)], mode)
    assert [r[1:] for r in rows] == [(5, 8), (10, "inf")]


def test_satellite_late_rows(spark):
    _, ref = _sat(spark, [(5, 20), (20, None)], [(1, None), (10, None)], REFERENCE)
    _, strict = _sat(spark, [(5, 20), (20, None)], [(1, None), (10, None)], STRICT)
    assert [r[1:] for r in ref] == [(1, 5), (5, 20), (10, 20), (20, "inf")]
    assert [r[1:] for r in strict] == [(1, 5), (5, 10), (10, 20), (20, "inf")]


def test_satellite_attributes_of_existing_start(spark):
    ref, _ = _sat(spark, [(5, None)], [(5, None), (10, None)], REFERENCE)
    strict, _ = _sat(spark, [(5, None)], [(5, None), (10, None)], STRICT)
    pick = lambda df: {r.effective_from_dttm: (r.a, r.version_id) for r in df.collect()}[day(5)]
    assert pick(ref) == ("old5", 2)  # reference keeps the old attributes, updates end and version
    assert pick(strict)[0] == "new5"


def test_satellite_same_start_twice_in_batch_keeps_latest_update(spark):
    t = spark.createDataFrame([], SAT)
    b = spark.createDataFrame([("k", "h1", day(5), None, "first", day(5)), ("k", "h2", day(5), day(9), "second", day(9))], BATCH)
    rows = load_hsat(t, b, "k", "hash_diff", ["a"], "CRM", 1, STRICT).collect()
    assert [(r.a, r.effective_to_dttm) for r in rows] == [("second", day(9))]


def test_hub_dirty_ids_one_row_min_id(spark):
    from hvault.functions import hash_key

    hub = spark.createDataFrame([], "k string, id string, load_dttm timestamp_ntz, src_cd string")
    cand = spark.createDataFrame([("a",), ("A ",)], "id string").select(hash_key("id").alias("k"), "id")
    out, new = load_hub(hub, [cand], "k", "id", "CRM", "2001-01-01 00:00:00")
    rows = out.collect()
    assert len(rows) == 1 and rows[0].id == "A " and rows[0].src_cd == "CRM"
    again, new2 = load_hub(out, [cand], "k", "id", "CRM", "2002-01-01 00:00:00")
    assert again.count() == 1 and new2.count() == 0


def test_extract_window_half_open_drops_null(spark):
    df = spark.createDataFrame([("2000-01-02",), ("2000-01-03",), ("2000-01-06",), (None,)], "last_update string")
    got = [r[0] for r in extract_window(df, "2000-01-03 00:00:00", "2000-01-06 00:00:00").collect()]
    assert got == ["2000-01-03"]


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_satellite_hot_key_path_equals_window_path(spark, monkeypatch, mode):
    import random

    rnd = random.Random(11)
    target, batch = [], []
    for k in ["hot"] * 8 + ["a", "b", "c"]:
        for _ in range(40):
            s = rnd.randrange(0, 400)
            target.append((k, 1, f"h{s}", day(s), day(s + rnd.choice([1, 5, 50])) if rnd.random() < 0.5 else OPEN, "CRM", f"t{s}"))
    for k in ["hot"] * 8 + ["a", "c", "d"]:
        for _ in range(40):
            s = rnd.randrange(0, 450)
            e = day(s + rnd.choice([2, 20])) if rnd.random() < 0.3 else None
            batch.append((k, f"n{s % 7}", day(s), e, f"b{s % 5}", day(rnd.randrange(0, 3))))
    # one target row per (key, start), as a primary key guarantees
    seen, tgt = set(), []
    for r in target:
        if (r[0], r[3]) not in seen:
            seen.add((r[0], r[3]))
            tgt.append(r)
    t = spark.createDataFrame(tgt, SAT)
    b = spark.createDataFrame(batch, BATCH)
    plain = load_hsat(t, b, "k", "hash_diff", ["a"], "CRM", 2, mode)
    hot = load_hsat(t, b, "k", "hash_diff", ["a"], "CRM", 2, mode, hot_keys=True, partitions=7)
    assert plain.count() > 300
    assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0
    named = only_hot_segmented(spark, monkeypatch, "next_value_segmented", lambda k: load_hsat(t, b, "k", "hash_diff", ["a"], "CRM", 2, mode, hot_keys=k, partitions=7))
    assert plain.exceptAll(named).count() == 0 and named.exceptAll(plain).count() == 0
    # the other keys keep the plan of a load without hot keys: one exchange of batch and target by key
    keys = spark.createDataFrame([("hot",)], "k string")
    rest = [load_hsat(x, y, "k", "hash_diff", ["a"], "CRM", 2, mode, small=True) for (x, _), (y, _) in [(by_heat(t, keys, "k")[0], by_heat(b, keys, "k")[0])]][0]
    assert rest._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def only_hot_segmented(spark, monkeypatch, name, load):
    """``load`` with one named hot key, and a check that no other key takes the segmented scan."""
    from hvault.operators import vault

    plain, seen = getattr(vault, name), []

    def spy(df, *args, **kw):
        seen.append({r[0] for r in df.select("k").distinct().collect()})
        return plain(df, *args, **kw)

    monkeypatch.setattr(vault, name, spy)
    out = load(spark.createDataFrame([("hot",)], "k string"))
    assert seen == [{"hot"}]
    return out


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_link_hot_key_path_equals_window_path(spark, monkeypatch, mode):
    import random

    rnd = random.Random(5)
    lsat, staged = [], []
    seen = set()
    for k in ["hot"] * 6 + ["a", "b"]:
        for _ in range(30):
            s = rnd.randrange(0, 300)
            if (k, s) in seen:
                continue
            seen.add((k, s))
            lsat.append((k, 1, day(s), day(s + rnd.choice([1, 3, 40])) if rnd.random() < 0.6 else OPEN, "CRM"))
    for k in ["hot"] * 6 + ["a", "c"]:
        for _ in range(30):
            s = rnd.randrange(0, 350)
            staged.append((k, "x", "y", day(s), day(s + rnd.choice([2, 30])) if rnd.random() < 0.4 else None))
    link = spark.createDataFrame([(k, "x", "y", day(0), "CRM") for k in ["hot", "a", "b"]], LINK)
    ls = spark.createDataFrame(lsat, LSAT)
    st = spark.createDataFrame(staged, STAGED)
    plain = load_link(link, ls, st, "k", ("h1", "h2"), "CRM", 2, "2001-01-01 00:00:00", mode)
    hot = load_link(link, ls, st, "k", ("h1", "h2"), "CRM", 2, "2001-01-01 00:00:00", mode, hot_keys=True, partitions=5)
    assert plain.lsat.exceptAll(hot.lsat).count() == 0 and hot.lsat.exceptAll(plain.lsat).count() == 0
    assert plain.link.exceptAll(hot.link).count() == 0 and plain.lsat.count() > 20
    named = only_hot_segmented(
        spark, monkeypatch, "merge_intervals_segmented",
        lambda k: load_link(link, ls, st, "k", ("h1", "h2"), "CRM", 2, "2001-01-01 00:00:00", mode, hot_keys=k, partitions=5),
    )
    assert plain.lsat.exceptAll(named.lsat).count() == 0 and named.lsat.exceptAll(plain.lsat).count() == 0
    assert plain.link.exceptAll(named.link).count() == 0


def test_key_hot_only_in_stored_history_is_detected(spark):
    """The batch holds one row of key "a", the stored satellite 40: the cheap
    bound trips, the stored table is profiled once and the load takes the
    segmented path; below the bound no profile job runs."""
    from hvault.plans.pipeline import VaultStore

    store = VaultStore(spark, {}, hot_key_rows=5)
    stored = spark.createDataFrame([("a",)] * 40 + [(f"k{i}",) for i in range(20)], "request_hash_key string")
    batch = spark.createDataFrame([("a",), ("k0",), (None,)], "request_hash_key string")

    def keys(hot):
        return sorted(r[0] for r in hot.collect())

    store._prof = {1: {"hsat_request": (3, 1)}, 2: {"hsat_request": (10, 1)}}
    store._top_bound = {0: {}, 1: {"hsat_request": 5}}
    assert keys(store._target_hot(2, "hsat_request", stored, batch)) == ["a"]
    assert store._top_bound[2]["hsat_request"] == 41
    # bound 0 + 1 stays below 5: no profile, not hot, bound carried forward
    store._top_bound = {0: {}}
    assert store._target_hot(1, "hsat_request", stored, batch) is False
    assert store._top_bound[1]["hsat_request"] == 1
    # the carried bound trips, the exact profile stays below it: not hot
    store.hot_key_rows = 20
    many = spark.createDataFrame([(f"k{i % 200}",) for i in range(2000)], "request_hash_key string")
    store._top_bound = {0: {}, 1: {"hsat_request": 25}}
    assert store._target_hot(2, "hsat_request", many, batch) is False
    assert store._top_bound[2]["hsat_request"] == 11
    # the batch's bound trips (keys share a hash cell), the exact profile does not
    store._prof[2] = {"hsat_request": (30, 25)}
    store._top_bound = {0: {}, 1: {}}
    assert store._target_hot(2, "hsat_request", many.limit(0), spark.createDataFrame([(f"k{i}",) for i in range(30)], "request_hash_key string")) is False
    assert store._top_bound[2]["hsat_request"] == 1
    store._prof[2] = {"hsat_request": (10, 1)}
    # the bound is absolute: a key with a small share of a large table is hot when its rows pass it
    share = spark.createDataFrame([("a",)] * 80 + [(f"k{i}",) for i in range(1920)], "request_hash_key string")
    store._top_bound = {0: {}, 1: {"hsat_request": 80}}
    assert keys(store._target_hot(2, "hsat_request", share, batch)) == ["a"]


def test_store_with_every_key_hot_equals_plain_store(spark):
    """Bounds of zero send every history load down the segmented path (batch
    and stored-history profiles both trip); the vault is the same."""
    from hvault.plans.pipeline import VaultStore
    from hvault.sources.adaptor import derive_sources

    src = derive_sources(spark, "/root/testdata/sf0.001")
    plain = VaultStore(spark, src)
    hot = VaultStore(spark, src, hot_key_rows=0)
    for name in ["hsat_request", "hsat_crm_customer", "lsat_cust_x_req", "lsat_acc_x_app"]:
        a, b = plain.table(name), hot.table(name)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert all(hot._top_bound[1][t] >= 1 for t in ["hsat_request", "lsat_cust_x_req"])

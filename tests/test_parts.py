"""A large batch leaves stored parts of the vault where they are: only those that hold its keys are written anew."""

import pytest
from pyspark.sql import functions as F
from test_large_batches import SF, exchanges, plain_joins, rows  # noqa: F401
from test_packed_keys import exchanged

from hvault.operators.intervals import REFERENCE, STRICT
from hvault.plans import bucket_store
from hvault.plans.bucket_store import BucketStore

SCHEMA = "k string, a string"


def of(spark, keys, a="x"):
    return spark.createDataFrame([(k, a) for k in keys], SCHEMA)


def filled(spark, root):
    store = BucketStore(spark, str(root), 4, first=1)
    store.commit(1, {"t": store.write("t", 1, of(spark, [f"k{i}" for i in range(40)]), "k")})
    kept = {"t": store.parts("t", 1)}
    store.commit(2, {"t": store.write("t", 2, of(spark, [f"n{i}" for i in range(40)], "y"), "k")}, kept=kept)
    return store


def test_a_bucket_keeps_its_parts_beside_new_ones(spark, tmp_path):
    store = filled(spark, tmp_path)
    assert store.manifest(2)["t"] == dict.fromkeys(range(4), (1, 2)) == BucketStore(spark, str(tmp_path), 4, first=1).manifest(2)["t"]
    assert store.read("t", SCHEMA, 2).count() == 80 and store.read("t", SCHEMA, 1).count() == 40
    assert store.read_keys("t", SCHEMA, 2, of(spark, ["k3", "n3"]), "k").count() == 2
    store.commit(3, {"t": []})
    assert store.expire(1) == [] and store.read("t", SCHEMA, 3).count() == 80
    # without kept parts the written buckets are replaced
    one = store.write("t", 4, of(spark, ["k0"], "z"), "k")
    store.commit(4, {"t": one})
    assert store.manifest(4)["t"][one[0]] == (4,) and [v for b, v in store.manifest(4)["t"].items() if b != one[0]] == [(1, 2)] * 3


def test_touched_parts_are_those_that_hold_a_key(spark, tmp_path, monkeypatch):
    store = filled(spark, tmp_path)
    bucket = {r.k: r.b for r in store.read("t", SCHEMA, 2).select("k", F.pmod(bucket_store.cell(F.col("k")), F.lit(4)).alias("b")).collect()}
    none = of(spark, ["a", "b", None])
    assert store.touched_parts("t", SCHEMA, 2, none, "k", range(4)) == {}
    # one key of the second bucket: its part only, and nothing outside the asked buckets
    k = next(k for k, b in sorted(bucket.items()) if b == 1 and k.startswith("n"))
    assert store.touched_parts("t", SCHEMA, 2, of(spark, [k]), "k", range(4)) == {1: (2,)}
    assert store.touched_parts("t", SCHEMA, 2, of(spark, [k]), "k", [0, 2]) == {}
    # the first bucket's parts are all touched: so are the others taken to be
    both = [next(k for k, b in sorted(bucket.items()) if b == 0 and k.startswith(p)) for p in "kn"]
    assert store.touched_parts("t", SCHEMA, 2, of(spark, both), "k", range(4)) == store.parts("t", 2)
    # buckets of many parts are written anew as one
    monkeypatch.setattr(bucket_store, "MAX_PARTS", 2)
    assert store.touched_parts("t", SCHEMA, 2, none, "k", range(4)) == store.parts("t", 2)


@pytest.mark.parametrize("mode", [STRICT, REFERENCE])
def test_second_large_batch_adds_to_hubs_links_and_untouched_histories(spark, mode):
    from hvault.plans.pipeline import VaultStore
    from hvault.sources.adaptor import derive_sources

    src = derive_sources(spark, SF)
    plain, large = VaultStore(spark, src, mode), VaultStore(spark, src, mode, max_broadcast_rows=0)
    names = ["hub_transaction", "link_acc_x_trans", "lsat_acc_x_trans", "hsat_transaction", "lsat_cust_x_app", "hsat_cab_customer", "lsat_acc_x_app"]
    plain.vault(2, set(names))
    large.vault(2, set(names))
    for n in names:
        assert rows(plain.table(n)) == rows(large.table(n))
    stored = large.tables
    for n in names[:5]:
        assert all(of in ((1, 2), (2,), (1,)) for of in stored.manifest(2)[n].values()) and (1, 2) in stored.manifest(2)[n].values()
        # no row is stored twice
        both = stored.read_parts(n, large._vaults[2][n].schema, {b: (1,) for b in stored.manifest(1)[n]}).intersect(
            stored.read_parts(n, large._vaults[2][n].schema, {b: (2,) for b, of in stored.manifest(2)[n].items() if 2 in of})
        )
        assert both.isEmpty()
    # re-sent keys: their histories are written anew
    for n in names[5:]:
        assert set(stored.manifest(2)[n].values()) == {(2,)}


@pytest.mark.parametrize("mode", [STRICT, REFERENCE])
def test_first_large_loads_exchange_ids_not_hashes(spark, plain_joins, mode):  # noqa: F811
    """One exchange for a link, its satellite and a hub satellite each, of what their hashes are made of."""
    from hvault.operators.staging import extract, placed, with_hashes
    from hvault.operators.vault import load_hsat, load_link
    from hvault.plans.model import LINKS, SATS, STAGING
    from hvault.plans.pipeline import empty_vault, link_rows, sat_batch
    from hvault.sources.adaptor import derive_sources

    src = derive_sources(spark, SF)
    spec, ln, sat, none = STAGING["service_request"], LINKS["link_cust_x_req"], SATS["hsat_request"], empty_vault(spark)
    df = extract(spec, src["service_request"], {lk.ref: src[lk.ref].localCheckpoint() for lk in spec.lookups}).localCheckpoint()
    staged = {"service_request": with_hashes(spec, df, src["service_request"].columns)}
    there = lambda key: {"service_request": placed(spec, df, src["service_request"].columns, key)}
    link = [
        load_link(none[ln.name], none[ln.lsat], link_rows(ln, staged), ln.key, ln.hub_keys, ln.src_cd, 1, "2000-01-01 00:00:00", mode, False, placed=p)
        for p in (None, link_rows(ln, there(ln.key)))
    ]
    hsat = [
        load_hsat(none[sat.name], sat_batch(sat, rows), sat.key, sat.hash_col, sat.attr_names, sat.src_cd, 1, mode, False, placed=at)
        for rows, at in ((staged, False), (there(sat.key), True))
    ]
    for plain, lean in ((link[0].lsat, link[1].lsat), (link[0].inserted_links, link[1].inserted_links), hsat):
        assert rows(plain) == rows(lean) and plain.count() > 0
        # the anti join of a link takes the stored keys, besides
        moved = [of for of in exchanged(lean) if of != [(ln.key, "binary")]]
        assert not [c for of in moved for c, t in of if "hash" in c or t == "binary"]
    assert exchanges(link[1].lsat) == exchanges(hsat[1]) == 1

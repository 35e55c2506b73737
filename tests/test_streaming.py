"""The streaming folder loader gives the same vault as the batch pipeline."""

import os
import tempfile

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_two_drops_equal_batch_pipeline(spark):
    from hvault.operators.staging import extract_window
    from hvault.plans.pipeline import LOAD_TS, WINDOWS, vault_store
    from hvault.sources.catalogue import CATALOGUE, REFERENCE_LISTS
    from hvault.sources.csv_folder import write_folder
    from hvault.streaming import folder_loader

    store = vault_store(spark, SF)
    scratch = tempfile.mkdtemp(prefix="hvault-stream-")
    drop, vault_root, ckpt = f"{scratch}/drop", f"{scratch}/vault", f"{scratch}/ckpt"
    for i, (lo, hi) in enumerate(WINDOWS):
        for name, df in store.sources.items():
            if name in REFERENCE_LISTS:
                if i == 0:
                    write_folder(df, drop, CATALOGUE[name])
                continue
            write_folder(extract_window(df, lo, hi), drop, CATALOGUE[name], mode="append")
        q = folder_loader.start(spark, drop, vault_root, ckpt, load_ts=lambda bid: LOAD_TS[bid], buckets=4)
        q.awaitTermination(600)
    from hvault.plans.bucket_store import BucketStore

    loaded = BucketStore(spark, vault_root, 4)
    assert loaded.commits() == [0, 1]
    assert not os.listdir(f"{vault_root}/_staging")
    vault, refs = folder_loader.read_snapshot(spark, vault_root, buckets=4)
    assert set(refs) == set(REFERENCE_LISTS)
    log = loaded.log(1).where("version_id IS NOT NULL").select("table_name", "load_dttm", "version_id")
    want_log = store.log().where("version_id IS NOT NULL").select("table_name", "load_dttm", "version_id")
    assert log.exceptAll(want_log).count() == 0 and want_log.exceptAll(log).count() == 0
    for table in ["hub_customer", "link_acc_x_app", "lsat_acc_x_app", "hsat_cab_customer", "hsat_crm_customer", "hsat_transaction"]:
        got = vault[table]
        want = store.table(table)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, table


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_missing_snapshot_is_an_error(spark, tmp_path):
    from hvault.streaming import folder_loader

    vault, refs = folder_loader.read_snapshot(spark, str(tmp_path), -1)
    assert refs == {} and vault["hub_customer"].count() == 0
    with pytest.raises(RuntimeError, match="missing or incomplete"):
        folder_loader.read_snapshot(spark, str(tmp_path), 0)
    lines = spark.createDataFrame([], "value string, entity string")
    with pytest.raises(RuntimeError, match="missing or incomplete"):
        folder_loader.load_micro_batch(lines, 1, str(tmp_path))
    assert not os.listdir(tmp_path)

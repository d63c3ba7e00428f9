"""What the queries that failed by disk or memory at 6 GB shuffle, write and keep."""
import datetime as dt
import time

from pyspark.sql import functions as F
from test_claims import OFFER, REQUEST
from test_order_world_size import _spied
from test_shuffle_once import T0, _plan, _shuffles, _tables, _written

from ridelake import registry
from ridelake.operators import admission
from ridelake.plans.materialize import has_rows, materialize
from ridelake.streaming import jobs


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_written_tables_leave_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffle_files(spark)
    written = materialize(df)
    assert has_rows(df) and not has_rows(df.where("k < 0"))
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert written.count() == 7


def test_finish_reads_admitted_orders_once(spark, tmp_dir):
    day = T0 + dt.timedelta(days=1)
    _tables(spark, tmp_dir, [(1, 1, 5, 3, 1.0, "N", "F", day), (1, 2, 5, 3, 1.0, "N", "F", day), (2, 1, 97, 3, 1.0, "N", "F", day)])
    done = registry.finish_outcomes(spark, tmp_dir)
    plan = _plan(done)
    assert "o_custkey" not in plan and _shuffles(plan, "_order") == 1
    assert sorted((r.order_id, r.outcome) for r in done.collect()) == [
        ("order-1-0", "ORDER_NOT_FOUND"), ("order-1-1", "FINISHED"), ("order-2-1", "ORDER_NOT_FOUND")]
    snap = registry.orders_after_finish(spark, tmp_dir)
    plan = _plan(snap)
    assert "o_custkey" not in plan and _shuffles(plan, "_order") == 0
    assert [(r.id, r.status, r.finish_time) for r in snap.collect()] == [("order-1-1", "FINISHED", day)]


def test_intake_keeps_its_state_on_disk(spark, tmp_dir):
    src, root, schema = f"{tmp_dir}/req", f"{tmp_dir}/job", "order_id string, requested_at timestamp_ntz, seq int, note string"
    parts = [[("a", T0, 2, "x"), ("a", T0, 1, "y"), ("b", None, 5, None), ("", T0, 3, "z"), (None, T0, 4, None)],
             [("a", T0 - dt.timedelta(days=1), 0, "late"), ("c", T0, 6, None), ("", T0, 7, None)]]
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    out = jobs.stream_order_intake(stream, ["seq"], root=root)
    assert spark.conf.get(key) == before and out.columns == stream.columns
    assert sorted(r.seq for r in out.collect()) == [1, 3, 4, 5, 6, 7]
    with open(f"{root}/_checkpoint/offsets/0") as f:
        assert "RocksDBStateStoreProvider" in f.read()


def test_shared_order_ids_read_requests_once(spark, tmp_dir, monkeypatch):
    req = _written(spark, tmp_dir, "req", [
        ("o1", "f1", "u", T0, True, 1), ("o2", "f1", "u", T0, True, 2), ("o1", "f2", "u", T0, True, 3), ("o2", "f2", "u", T0, False, 4),
        ("o2", "f3", "u", T0, True, 5), ("o9", "f4", "u", T0, True, 6), ("o9", "f4", "u", T0, True, 7), ("o1", "f0", "u", T0, True, 8),
        ("", "f1", "u", T0, True, 9)], REQUEST)
    offers = _written(spark, tmp_dir, "offers", [(f"f{k}", "u", "s", T0, 1, 2, 3) for k in (1, 2, 3, 4)], OFFER)
    plans = _spied(monkeypatch, admission)
    out = admission.admit_orders(req, offers, ["seq"])
    # the linked offers are found in the pairs, not in the requests again
    assert plans["admission-pairs"].count("FileScan") == 1
    assert "requested_at" not in plans["admission-linked-offers"] and "hold_success" not in plans["admission-linked-offers"]
    # requests that cannot claim are not shuffled to look for their claim, nor any with its key beside its columns
    plan = _plan(out)
    assert "Union" in plan and "_k#" not in plan
    assert {r.seq: r.outcome for r in out.collect()} == {
        1: "CREATED", 2: "OFFER_ALREADY_USED", 3: "DUPLICATE", 4: "PAYMENT_HOLD_FAILED", 5: "CREATED", 6: "CREATED", 7: "DUPLICATE",
        8: "DUPLICATE", 9: "ORDER_ID_REQUIRED"}

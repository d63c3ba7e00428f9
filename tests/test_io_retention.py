"""File-producing operators: archive (K06, S10, T12), snapshot publish
(K01-K03), layout (L01), container logs (S08) and cleanup (T09, A06)."""

import contextlib
import datetime as dt
import io
import json
import os

from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators import archive, logs, lookup, retention
from ridelake.plans import layout
from ridelake.sources import tables

T0 = dt.datetime(2024, 1, 1, 10, 30)


def _orders(spark):
    rows = [("o1", "u1", "s1", "of1", 10, 20, 100, 20, "FINISHED", T0, T0 + dt.timedelta(seconds=90),
             90, T0, T0),
            ("o2", "u2", "s2", "of2", 10, 20, 100, 20, "ACTIVE", T0 + dt.timedelta(hours=30), None,
             None, T0 + dt.timedelta(hours=30), T0 + dt.timedelta(hours=30)),
            ("o3", "u1", "s3", "of3", 10, 20, 100, 20, "PAYMENT_FAILED", T0 + dt.timedelta(hours=1),
             None, None, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=1))]
    return spark.createDataFrame(rows, schemas.ORDERS)


def _ledger(spark):
    rows = [("txn-o1", "o1", "u1", "HOLD", 100, "SUCCESS", "x", None, T0),
            ("txn-clear-o1", "o1", "u1", "CLEAR", 40, "SUCCESS", "", None, T0),
            ("txn-o2", "o2", "u2", "HOLD", 100, "SUCCESS", "y", None, T0 + dt.timedelta(hours=30))]
    return spark.createDataFrame(rows, schemas.PAYMENT_TRANSACTIONS)


def test_archive_roundtrip_with_partition_pruning(spark, tmp_dir):
    root = os.path.join(tmp_dir, "archive")
    for _ in range(2):  # a batch written again replaces itself
        archive.write_archive(archive.archive_records(_orders(spark), _ledger(spark)), root, "b1")
    hours = {d for d, _, fs in os.walk(root) if any(f.endswith(".json.gz") for f in fs)}
    assert len(hours) == 3        # one folder per order-creation hour
    schema = archive.archive_records(_orders(spark), _ledger(spark)).drop(
        *archive.PARTITION_COLS).schema
    got = archive.read_archive_range(spark, root, schema, "2024-01-01", "2024-01-02")
    assert sorted(r.id for r in got.where("type = 'order'").collect()) == ["o1", "o3"]
    assert got.where("type = 'transaction'").count() == 2
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    assert "PartitionFilters: [" in buf.getvalue() and "yyyy" in buf.getvalue()
    purge = archive.expired_archive_days(spark, root, "2027-06-01")
    assert purge.count() == 2
    hot = _orders(spark).limit(0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        archive.hot_cold_history(hot, _ledger(spark).limit(0), archive.read_archive(spark, root, schema),
                                 "2024-01-01", "2024-01-01 12:00:00", user_id="u1").explain()
    scans = [line for line in buf.getvalue().splitlines() if "FileScan json" in line]
    assert len(scans) >= 2 and all("PartitionFilters: []" not in s and "PartitionFilters: [" in s for s in scans)
    assert archive.purge_archive(spark, root, "2027-06-01") == ["2024-01-01", "2024-01-02"]
    assert archive.expired_archive_days(spark, root, "2027-06-01").count() == 0


def test_cleanup_and_zero_case(spark):
    out = retention.cleanup(_orders(spark), _ledger(spark), "2024-01-02 12:00:00")
    s = out["summary"].first()
    assert (s.orders_deleted, s.ledger_rows_deleted, s.result) == (2, 2, "DELETED")
    assert sorted(r.id for r in out["orders"].collect()) == ["o2"]
    audit = [json.loads(r.log_line) for r in out["audit"].collect()]
    assert {a["order_id"] for a in audit} == {"o1", "o3"}
    doc = [a for a in audit if a["order_id"] == "o3"][0]["order_data"]
    assert doc["finish_time"] is None and doc["current_amount"] == 20
    none = retention.cleanup(_orders(spark), _ledger(spark), "2023-01-01 00:00:00")["summary"].first()
    assert (none.orders_deleted, none.result) == (0, "NO_OLD_ORDERS")


def test_publish_snapshot_writes_manifest_last(spark, tmp_dir):
    base = retention.publish_snapshot({"orders": _orders(spark), "ledger": _ledger(spark)},
                                      tmp_dir, "b1")
    assert spark.read.parquet(os.path.join(base, "orders")).count() == 3
    manifest = spark.read.text(os.path.join(base, "_manifest")).first()[0]
    assert json.loads(manifest)["tables"] == ["ledger", "orders"]


def test_layout_and_lookups(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders_layout")
    layout.write_orders_layout(_orders(spark), path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 3 and "date" in back.columns
    shards = {r.order_id: r.shard for r in lookup.order_shard_map(_orders(spark), 4).collect()}
    assert shards["o1"] == shards["o3"]            # same user, same shard
    ids = spark.createDataFrame([("o1",), ("zz",), ("",)], "order_id string")
    got = {r.order_id: r.outcome for r in lookup.lookup_orders(ids, _orders(spark)).collect()}
    assert got == {"o1": "FOUND", "zz": "NOT_FOUND", "": "ORDER_ID_REQUIRED"}
    top = lookup.latest_order_for_offer(_orders(spark), "of2").collect()
    assert [r.id for r in top] == ["o2"]


def test_container_logs(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.log")
    lines = [{"log": '{"level":"info","event":"request_complete","method":"GET","path":"/orders/o1",'
                     '"status_code":200,"duration_ms":1.5}\n', "stream": "stdout"},
             {"log": '{"level":"info","event":"request_start"}\n', "stream": "stdout"}]
    with open(p, "w") as f:
        for ln in lines:
            f.write(json.dumps(ln) + "\n")
    df = logs.read_container_logs(spark, p)
    recs = logs.parse_request_complete(df).collect()
    assert len(recs) == 1 and recs[0].path == "/orders/o1" and recs[0].duration_ms == 1.5
    drops = {r.reason: r.lines for r in logs.drop_counts(df).collect()}
    assert drops == {"kept": 1, "not_request_complete": 1}


def test_trailing_window_and_daily_layout(spark, tmp_dir):
    df = spark.createDataFrame([(T0 - dt.timedelta(minutes=16),), (T0 - dt.timedelta(minutes=15),),
                                (T0,), (T0 + dt.timedelta(seconds=1),)], "ts timestamp_ntz")
    assert logs.trailing(df, T0.isoformat(sep=" "), 15).count() == 2
    path = os.path.join(tmp_dir, "logs")
    logs.write_daily(df, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("date=")) == [
        "date=2024-01-01"]


def test_cluster_sizing():
    from ridelake.session import cluster_shuffle_partitions
    assert cluster_shuffle_partitions(10 ** 6) == 200
    assert cluster_shuffle_partitions(1024 ** 4) == 8192          # 1 TiB / 128 MiB
    assert cluster_shuffle_partitions(100 * 1024 ** 4) == 819_200


def test_json_dimensions_and_configs_end_to_end(spark, tmp_dir):
    from ridelake import schemas as S
    from ridelake.operators.enrich import price_offer_requests
    from ridelake.sources import tables
    # The reference's dimension documents (JSON arrays) and config.
    docs = {
        "scooters.json": [{"id": "scooter-1", "zone_id": "zone-1", "charge": 85},
                          {"id": "scooter-2", "zone_id": "zone-1", "charge": 45},
                          {"id": "scooter-3", "zone_id": "zone-2", "charge": 90},
                          {"id": "scooter-4", "zone_id": "zone-2", "charge": 25}],
        "zones.json": [{"id": "zone-1", "price_per_minute": 7, "price_unlock": 50, "default_deposit": 200},
                       {"id": "zone-2", "price_per_minute": 10, "price_unlock": 75, "default_deposit": 300}],
        "users.json": [{"id": "user-1", "has_subscription": True, "trusted": True},
                       {"id": "user-2", "has_subscription": False, "trusted": True},
                       {"id": "user-3", "has_subscription": False, "trusted": False},
                       {"id": "user-4", "has_subscription": True, "trusted": False}],
        "configs.json": {"surge": 1.2, "low_charge_discount": 0.7,
                         "low_charge_threshold_percent": 28, "incomplete_ride_threshold_seconds": 5},
    }
    for name, doc in docs.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            json.dump(doc, f, indent=2)
    scooters = tables.read_dimension_json(spark, os.path.join(tmp_dir, "scooters.json"), S.SCOOTERS)
    zones = tables.read_dimension_json(spark, os.path.join(tmp_dir, "zones.json"), S.ZONES)
    users = tables.read_dimension_json(spark, os.path.join(tmp_dir, "users.json"), S.USERS)
    cfg = tables.read_configs_json(spark, os.path.join(tmp_dir, "configs.json"))
    assert scooters.count() == 4 and users.count() == 4
    req = spark.createDataFrame(
        [(f"r{u}", f"user-{u}", "scooter-1") for u in range(1, 5)] + [("r5", "user-3", "scooter-4")],
        "request_id string, user_id string, scooter_id string").withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    got = {r.request_id: (r.price_per_minute, r.price_unlock, r.deposit)
           for r in price_offer_requests(req, scooters, zones, users, cfg).collect()}
    assert [got[f"r{u}"][1] for u in range(1, 5)] == [0, 50, 50, 0]
    assert [got[f"r{u}"][2] for u in range(1, 5)] == [0, 0, 200, 200]
    assert got["r1"][0] == 8            # zone-1: 7 * 1.2 = 8.4 -> 8 (charge 85, no discount)
    assert got["r5"] == (8, 75, 300)    # zone-2, charge 25 < 28: 10 * 1.2 * 0.7 = 8.4 -> 8


def test_json_documents_stay_small(spark):
    from ridelake import registry
    df = spark.range(20_000).select(F.concat(F.lit("user-"), "id").alias("id"), F.lit(True).alias("has_subscription"))
    path = registry._document(df, "test")
    sizes = [t.value.count('"id"') for t in spark.read.text(path).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1500
    assert sorted(tables.read_dimension_json(spark, path, df.schema).collect()) == sorted(df.collect())

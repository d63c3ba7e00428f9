"""Interval joins, quantile sketches, bucketed and sharded layouts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ridelake import registry
from ridelake.operators.lookup import order_shard_map
from ridelake.plans import intervals, layout, sketches

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def _at(s):
    return None if s is None else T0 + dt.timedelta(microseconds=s)


def test_interval_join_equals_all_pairs(spark):
    """One busy key, lengths from a microsecond to a year, empty and reversed
    intervals, nulls and repeated rows."""
    rng = random.Random(7)
    keys = ["hot"] * 6 + ["a", "b", None]
    spans = []
    for i in range(400):
        lo = rng.randrange(10 ** 9)
        size = rng.choice([1, 2, 1000, 10 ** 6, 3 * 10 ** 8, 10 ** 13, 0, -5])
        spans.append((rng.choice(keys), i, lo, lo + size))
    spans += [spans[0], ("hot", 900, None, 5), ("hot", 901, 5, None)]
    pts = [(rng.choice(keys), i, rng.randrange(-10, 11 * 10 ** 8)) for i in range(500)] + [("hot", 500, None)]
    pts += [("hot", 600 + k, s[2]) for k, s in enumerate(spans[:40]) if s[2] is not None]
    pts += [("hot", 700 + k, s[3]) for k, s in enumerate(spans[:40]) if s[3] is not None]
    p = spark.createDataFrame([(k, i, _at(t)) for k, i, t in pts], "k string, p long, t timestamp_ntz")
    s = spark.createDataFrame([(k, i, _at(a), _at(b)) for k, i, a, b in spans],
                              "k string, s long, lo timestamp_ntz, hi timestamp_ntz")
    joined = intervals.interval_join(p, s, ["k"], "t", "lo", "hi")
    want = sorted((pi, si) for pk, pi, t in pts for sk, si, a, b in spans
                  if pk is not None and pk == sk and None not in (t, a, b) and a <= t < b)
    assert sorted((r.p, r.s) for r in joined.collect()) == want and len(want) > 500
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    best = {}
    for pi, si in want:
        best.setdefault(pi, []).append(si)
    start = {si: a for _, si, a, _ in spans}
    got = intervals.latest_interval(p, s, ["k"], "t", "lo", "hi", ["p"], ["s"]).collect()
    assert len(got) == len(pts)
    for r in got:
        of = best.get(r.p, [])
        assert (r.n_live, r.latest_s) == (len(of), max(of, key=lambda x: (start[x], x)) if of else None)


def test_interval_join_of_empty_tables(spark):
    p = spark.createDataFrame([], "k string, p long, t timestamp_ntz")
    s = spark.createDataFrame([], "k string, s long, lo timestamp_ntz, hi timestamp_ntz")
    assert intervals.interval_join(p, s, ["k"], "t", "lo", "hi").count() == 0
    one = spark.createDataFrame([("a", 1, T0)], "k string, p long, t timestamp_ntz")
    assert intervals.latest_interval(one, s, ["k"], "t", "lo", "hi", ["p"], ["s"]).first().n_live == 0
    with pytest.raises(ValueError, match="both sides"):
        intervals.interval_join(one, s.withColumnRenamed("s", "p"), ["k"], "t", "lo", "hi")


def test_sketches_merge_to_any_window_within_the_bound(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("b").alias("route"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
         (F.col("id") % 3600).cast("decimal(18,6)"))).alias("ts"),
        F.when(F.col("id") % 101 > 0, F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double")).alias("v"))
    kept = sketches.minute_sketches(rows, ["route"], "v")
    assert kept.count() == 120
    lo, hi = T0 + dt.timedelta(minutes=20), T0 + dt.timedelta(minutes=35)
    part = kept.where((F.col("minute") >= F.lit(lo)) & (F.col("minute") < F.lit(hi))).withColumn("w", F.lit(1))
    q = sketches.window_quantiles(part, ["route"], "w", [0.5, 0.95, 0.99], ["p50", "p95", "p99"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    exact = rows.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)) & F.col("v").isNotNull())
    for r in q.collect():
        values = sorted(x.v for x in exact.where(F.col("route") == r.route).collect())
        assert r.n == len(values)
        for p, got in ((0.5, r.p50), (0.95, r.p95), (0.99, r.p99)):
            rank = sum(v <= got for v in values) / len(values)
            assert abs(rank - p) <= 2 * sketches.rank_error()


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = registry.orders_with_ledger_bucketed(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.orders_with_ledger_bucketed(spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.where("n_rows > 1").count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_reads_only_the_shards_it_needs(spark, tmp_dir):
    rides = registry.si.rides(spark, SF)
    layout.write_sharded(rides, tmp_dir, 16)
    table, mapped = spark.read.parquet(tmp_dir), order_shard_map(rides, 16)
    wanted = mapped.where("shard in (3, 11)").select("order_id").limit(5)
    ids = spark.createDataFrame([(r.order_id,) for r in wanted.collect()] + [("no-such-order",)], "order_id string")
    found = layout.orders_of_shards(table, mapped, ids)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    rows = found.collect()
    assert {r.id for r in rows} == {r.order_id for r in ids.collect()} - {"no-such-order"}
    assert {r.shard for r in rows} <= {3, 11}
    # rows that left the scan: the named shards only
    scan = found._jdf.queryExecution().executedPlan()
    metrics = _metrics(scan, "numPartitions")
    assert metrics and max(metrics) <= 2


def _metrics(plan, name):
    """Values of a metric in all scans of an executed plan."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith(("Scan parquet", "FileSourceScan")) and "shard" in node.toString():
            metric = node.metrics().get(name)
            if metric.isDefined() and "dynamicpruning" in node.toString().lower():
                out.append(metric.get().value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return out


def test_claims_and_remaining_time_decide_reuse(spark):
    rows = registry.offer_creation_claims(spark, SF).groupBy("outcome").count().collect()
    counts = {r.outcome: r["count"] for r in rows}
    plain = registry.offers.create_offers(
        registry.si.offer_requests(spark, SF), registry.si.scooters(spark, SF), registry.si.zones(spark, SF),
        registry.si.users(spark, SF), ttl_seconds=7 * 86400).where("outcome = 'REUSED'").count()
    assert counts["CREATED"] > 0 and 0 < counts["REUSED"] < plain

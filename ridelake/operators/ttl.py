"""T01/T02/T06 engine: the TTL chain.

Rule.  Within a key, rows are ordered by ``(ts, order_cols)``.  A chain row is
an *anchor* iff it is forced, or no anchor exists yet, or
``ts >= last_anchor_ts + ttl``.  Anchors never extend (this is not a session
window).  Rows that may not become anchors (``eligible`` false, e.g. a failed
offer creation or a read of an unknown order) only observe the chain: they are
*covered* when the latest anchor at or before them satisfies
``ts < anchor_ts + ttl``.

Scalable form: no key's rows are gathered into one task, and at most
``FOLD_MAX_ROWS`` rows of one segment ever share an array:

1. Time buckets.  Every window below is partitioned by ``(key, bucket)``;
   boundary information between buckets travels through small per-bucket
   summaries (one row per key and bucket), so a hot key is spread over as
   many tasks as it has buckets.
2. Gap split.  A row whose gap to the previous chain row is ``>= ttl`` (or
   that is forced, or first) must be an anchor.  Running counts of these
   starts cut every key into independent segments.
3. A segment spanning less than ``ttl`` has exactly one anchor, its first row
   (without per-row ends; with them, every multi-row segment is "dense").
4. Dense segments are solved exactly.  Up to ``FOLD_MAX_ROWS`` rows, the
   segment is sorted into one array and folded with ``aggregate`` (JVM-side,
   one pass).  Beyond that, by pointer doubling: each row points to the first
   later row at or after its TTL end (found with bucketed running counts),
   the anchors are the path from the segment's first row, and the path is
   collected in log2(n) rounds of joins, each round's intermediate written to
   the shared checkpoint folder (lineage cut).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pricing import epoch_micros
from ..plans.materialize import materialize
from ..session import ensure_checkpoint_dir

DEFAULT_BUCKET_SECONDS = 3600
# Dense segments up to this many rows are solved by folding one sorted array
# (bounded memory per group); longer ones by pointer doubling.
FOLD_MAX_ROWS = 2048


def _w(parts, order):
    return Window.partitionBy(*parts).orderBy(*order)


def ttl_chain(df: DataFrame, keys: list[str], ts: str, order_cols: list[str],
              ttl_seconds: int, eligible: Column | None = None,
              force: Column | None = None,
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
              end: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """Mark anchors and coverage of a TTL chain.

    ``(keys, ts, order_cols)`` must identify a row (it is the chain order).
    ``carry`` names columns whose values at the row's latest anchor are added
    as ``anchor_<name>``, in the pass that finds the anchor.
    ``end`` optionally gives, per row, the instant its TTL ends should it
    become an anchor (clamped to ``[ts, ts + ttl]``; default ``ts + ttl``),
    e.g. an offer that stops being reusable once it is claimed.
    Returns ``df`` plus ``is_anchor`` (bool), ``anchor_ts`` (ts of the latest
    anchor at or before the row, or null) and ``covered`` (an anchor exists
    and ``ts`` is before its TTL end, ``anchor_ts + ttl`` by default).
    """
    ttl_us = int(ttl_seconds) * 1_000_000
    b_us = int(bucket_seconds) * 1_000_000
    base = (df.withColumn("_t_us", epoch_micros(F.col(ts)))
            .withColumn("_t_b", F.floor(F.col("_t_us") / F.lit(b_us)).cast("long"))
            .withColumn("_t_el", F.coalesce(eligible, F.lit(True)) if eligible is not None
                        else F.lit(True))
            .withColumn("_t_force", F.coalesce(force, F.lit(False)) if force is not None
                        else F.lit(False)))
    full = F.col("_t_us") + F.lit(ttl_us)
    base = base.withColumn("_t_end", full if end is None else F.least(
        F.greatest(F.coalesce(epoch_micros(end), full), F.col("_t_us")), full))
    # cut lineage: the rows are read by the chain and by the coverage
    base = materialize(base, "ttl-rows")
    ident = keys + ["_t_us"] + order_cols
    order = [F.col("_t_us")] + [F.col(c) for c in order_cols]
    kb = keys + ["_t_b"]

    # an end that follows from the time is not carried: then all passes over
    # the chain below read the same shuffle of its rows
    own_end = [] if end is None else ["_t_end"]
    # (nor are rows without a key or time, which no join below finds again)
    found = F.col("_t_el") | F.col("_t_force")
    for c in kb:
        found = found & F.col(c).isNotNull()
    chain = base.where(found).select(
        *keys, "_t_b", "_t_us", *order_cols, "_t_force", *own_end)

    # 1. one window pass inside (key, bucket): gap to the previous row, and a
    #    running count of the starts it forces (the bucket's first row is
    #    settled from the summary below)
    w_b = _w(kb, order)
    prev_in = F.lag("_t_us").over(w_b)
    c1 = (chain.withColumn("_t_rnb", F.row_number().over(w_b))
          .withColumn("_t_gap", F.col("_t_us") - prev_in))
    inner = (F.col("_t_rnb") > 1) & (F.col("_t_force") | (F.col("_t_gap") >= F.lit(ttl_us)))
    c1 = c1.withColumn("_t_inner", inner).withColumn(
        "_t_cs", F.sum(F.col("_t_inner").cast("long")).over(
            w_b.rowsBetween(Window.unboundedPreceding, 0)))

    # 2. one row per (key, bucket): boundary facts; one small window per key
    #    decides whether each bucket's first row starts a segment and how many
    #    starts precede the bucket
    summ = c1.groupBy(*kb).agg(
        F.max("_t_us").alias("_t_bmax"), F.min("_t_us").alias("_t_bmin"),
        F.max(F.when(F.col("_t_rnb") == 1, F.col("_t_force"))).alias("_t_ff"),
        F.sum(F.col("_t_inner").cast("long")).alias("_t_bin"))
    wk = _w(keys, [F.col("_t_b")])
    pb = F.lag("_t_bmax").over(wk)
    summ = summ.withColumn("_t_fst", (F.col("_t_ff") | pb.isNull()
                                      | (F.col("_t_bmin") - pb >= F.lit(ttl_us))).cast("long"))
    summ = summ.withColumn("_t_before", F.coalesce(F.sum(F.col("_t_fst") + F.col("_t_bin")).over(
        wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    c2 = (c1.join(summ.select(*kb, "_t_fst", "_t_before"), kb, "left")
          .withColumn("_t_start", F.when(F.col("_t_rnb") == 1, F.col("_t_fst") == 1)
                      .otherwise(F.col("_t_inner")))
          .withColumn("_t_seg", F.col("_t_before") + F.col("_t_fst") + F.col("_t_cs"))
          .select(*keys, "_t_b", "_t_us", *order_cols, "_t_start", "_t_seg",
                  full.alias("_t_end") if end is None else "_t_end"))

    # 3. segment extent decides easy vs dense
    ks = keys + ["_t_seg"]
    # with per-row ends a short segment may still hold several anchors
    span_dense = F.max("_t_us") - F.min("_t_us") >= F.lit(ttl_us)
    ext = c2.groupBy(*ks).agg(
        (span_dense if end is None else F.count(F.lit(1)) > 1).alias("_t_dense"),
        F.count(F.lit(1)).alias("_t_n"))
    # cut lineage once rows are segmented and classified: everything below
    # reads this table (the dense checks are plain filters on it)
    c3 = materialize(c2.join(ext, ks, "left"), "ttl-segments")
    easy = c3.where(~F.col("_t_dense")).select(*ident, F.col("_t_start").alias("_t_anchor"))
    dense = c3.where(F.col("_t_dense"))

    # 4. dense segments: a bounded segment is folded in one pass; longer ones
    #    are solved exactly by pointer doubling
    small = dense.where(F.col("_t_n") <= F.lit(FOLD_MAX_ROWS))
    flags = easy.unionByName(_fold_anchors(small, ks, ident, order_cols, ttl_us))
    large = dense.where(F.col("_t_n") > F.lit(FOLD_MAX_ROWS)).drop("_t_dense", "_t_n")
    if large.limit(1).count() > 0:
        flags = flags.unionByName(_dense_anchors(large, keys, order_cols, ttl_us, b_us, ident))

    # 5. coverage for every row (chain rows and observers) from the latest anchor
    # (written once: the running maximum and the bucket summary both read them)
    allrows = materialize(base.join(flags, ident, "left").withColumn(
        "is_anchor", F.coalesce(F.col("_t_anchor"), F.lit(False))).drop("_t_anchor"), "ttl-anchors")
    # chain order first: of several anchors at one instant the last counts
    carried = [F.col(c).alias(f"carry_{c}") for c in carry or []]
    anc = F.when(F.col("is_anchor"), F.struct(
        F.col("_t_us").alias("us"), *[F.col(c).alias(f"order_{c}") for c in order_cols],
        F.col("_t_end").alias("end"), F.col(ts).alias("ts"), *carried))
    cov = allrows.withColumn("_t_in", F.max(anc).over(
        w_b.rowsBetween(Window.unboundedPreceding, 0)))
    s3 = allrows.groupBy(*kb).agg(F.max(anc).alias("_t_blast"))
    s3 = s3.withColumn("_t_plast", F.max("_t_blast").over(
        _w(keys, [F.col("_t_b")]).rowsBetween(Window.unboundedPreceding, -1)))
    cov = cov.join(s3.select(*kb, "_t_plast"), kb, "left")
    last = F.coalesce(F.col("_t_in"), F.col("_t_plast"))
    cov = cov.withColumn("_t_last", last)
    for c in carry or []:
        cov = cov.withColumn(f"anchor_{c}", F.col(f"_t_last.carry_{c}"))
    return (cov.withColumn("anchor_ts", F.col("_t_last.ts"))
            .withColumn("covered", F.col("_t_last").isNotNull()
                        & (F.col("_t_us") < F.col("_t_last.end")))
            .drop("_t_in", "_t_plast", "_t_last", "_t_us", "_t_b", "_t_el", "_t_force",
                  "_t_end"))


def _fold_anchors(small: DataFrame, ks: list[str], ident: list[str], order_cols: list[str],
                  ttl_us: int) -> DataFrame:
    """Exact anchors of bounded dense segments: sort the segment's rows into
    one array (at most ``FOLD_MAX_ROWS``) and fold it with ``aggregate``,
    keeping the current anchor's end and the anchors' row identities."""
    row = F.struct(F.col("_t_us").alias("_t_us"), *[F.col(c) for c in order_cols],
                   F.col("_t_end").alias("_t_end"),
                   F.struct(*[F.col(c) for c in ident]).alias("_id"))
    seg = small.groupBy(*ks).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    id_type = small.select(F.struct(*[F.col(c) for c in ident]).alias("_id")).schema[0].dataType
    init = F.struct(F.lit(None).cast("long").alias("end"),
                    F.array().cast(f"array<{id_type.simpleString()}>").alias("ids"))

    def step(acc, x):
        new = acc["end"].isNull() | (x["_t_us"] >= acc["end"])
        return F.when(new, F.struct(x["_t_end"].alias("end"),
                                    F.array_append(acc["ids"], x["_id"]).alias("ids"))) \
            .otherwise(acc)

    anchors = seg.select(F.explode(F.aggregate("_rows", init, step)["ids"]).alias("_a"))
    anchors = anchors.select("_a.*").withColumn("_t_anchor", F.lit(True))
    return (small.select(*ident).join(anchors, ident, "left")
            .select(*ident, F.coalesce(F.col("_t_anchor"), F.lit(False)).alias("_t_anchor")))


def _dense_anchors(dense: DataFrame, keys, order_cols, ttl_us: int, b_us: int,
                   ident: list[str]) -> DataFrame:
    """Exact anchors of dense segments by pointer doubling."""
    ensure_checkpoint_dir(dense.sparkSession)
    ks = keys + ["_t_seg"]
    ksb = ks + ["_t_b"]
    order = [F.col("_t_us")] + [F.col(c) for c in order_cols]
    # position inside the segment = rows in earlier buckets + rank inside bucket
    d = dense.withColumn("_t_rk", F.row_number().over(_w(ksb, order)) - 1)
    cnt = d.groupBy(*ksb).agg(F.count(F.lit(1)).alias("_t_n"))
    # probe = the instant a row's TTL ends; its successor is the first row at
    # or after the probe, whose position = segment rows strictly before it
    probes = d.select(*ks, "_t_rk", "_t_b", F.col("_t_end").alias("_t_p"))
    probes = probes.select(*ks, F.col("_t_b").alias("_t_sb"), "_t_rk", "_t_p",
                           F.floor(F.col("_t_p") / F.lit(b_us)).cast("long").alias("_t_b"))
    buckets = (cnt.unionByName(probes.select(*ksb).distinct().withColumn("_t_n", F.lit(0)))
               .groupBy(*ksb).agg(F.sum("_t_n").alias("_t_n")))
    buckets = buckets.withColumn("_t_pre", F.coalesce(F.sum("_t_n").over(
        _w(ks, [F.col("_t_b")]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = cnt.groupBy(*ks).agg(F.sum("_t_n").alias("_t_tot"))
    pre = buckets.select(*ksb, "_t_pre")
    d = d.join(pre, ksb, "left").withColumn("_t_pos", F.col("_t_pre") + F.col("_t_rk"))
    # rows strictly before each probe inside the probe's bucket: union data and
    # probes, probes sort first at equal instants
    u = (d.select(*ksb, F.col("_t_us").alias("_t_t"), F.lit(0).alias("_t_isp"),
                  F.col("_t_pos").alias("_t_src"))
         .unionByName(probes.join(pre.withColumnRenamed("_t_b", "_t_sb")
                                  .withColumnRenamed("_t_pre", "_t_spre"), ks + ["_t_sb"])
                      .select(*ksb, F.col("_t_p").alias("_t_t"), F.lit(-1).alias("_t_isp"),
                              (F.col("_t_spre") + F.col("_t_rk")).alias("_t_src"))))
    u = u.withColumn("_t_cntb", F.sum(F.when(F.col("_t_isp") == 0, 1).otherwise(0)).over(
        _w(ksb, [F.col("_t_t"), F.col("_t_isp")]).rowsBetween(Window.unboundedPreceding, 0)))
    jump = (u.where(F.col("_t_isp") == -1)
            .join(pre, ksb, "left")
            .join(total, ks)
            .withColumn("_t_nx", F.greatest(F.col("_t_pre") + F.col("_t_cntb"),
                                            F.col("_t_src") + 1))
            .select(*ks, F.col("_t_src").alias("_t_pos"),
                    F.when(F.col("_t_nx") < F.col("_t_tot"), F.col("_t_nx")).alias("_t_to")))
    jump = materialize(jump, "ttl-jump")
    reached = materialize(jump.where(F.col("_t_pos") == 0).select(*ks, "_t_pos"), "ttl-path")
    while True:
        # reached = {J^m(first) : m < 2^k}; jump = J^(2^k); each round doubles k
        new = materialize(reached.join(jump, ks + ["_t_pos"])
                          .where(F.col("_t_to").isNotNull())
                          .select(*ks, F.col("_t_to").alias("_t_pos")), "ttl-path")
        if new.limit(1).count() == 0:
            break
        reached = materialize(reached.unionByName(new), "ttl-path")
        a, b = jump.alias("a"), jump.alias("b")
        cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ks] + [
            F.col("a._t_to") == F.col("b._t_pos")]
        jump = materialize(a.join(b, cond, "left")
                           .select(*[F.col(f"a.{k}").alias(k) for k in ks], F.col("a._t_pos"),
                                   F.col("b._t_to").alias("_t_to")), "ttl-jump")
    flagged = reached.withColumn("_t_anchor", F.lit(True))
    return (d.join(flagged, ks + ["_t_pos"], "left")
            .select(*ident, F.coalesce(F.col("_t_anchor"), F.lit(False)).alias("_t_anchor")))

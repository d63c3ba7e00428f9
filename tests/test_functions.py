"""Log functions (P06-P15, E15), JSON rendering (P12), payload decoding
(S05-S07) and as-of lookups (J05, J06, T13)."""

import datetime as dt

from pyspark.sql import functions as F

from ridelake.functions import jsonfmt, logfmt
from ridelake.operators import finish, logs, versions
from ridelake.sources import payloads

T0 = dt.datetime(2024, 1, 1)


def test_truncate_counts_bytes(spark):
    body = "é" * 600  # 1200 bytes
    df = spark.createDataFrame([(body,), ("x" * 1000,), ("x" * 1001,)], "b string")
    got = [r[0] for r in df.select(logfmt.truncate_bytes(F.col("b"), 1000)).collect()]
    assert got[0] == "é" * 500 + "...(truncated)"
    assert got[1] == "x" * 1000
    assert got[2] == "x" * 1000 + "...(truncated)"


def test_response_and_request_keys(spark):
    df = spark.createDataFrame([
        ('{"id":"of-1","expires_at":"x","user_id":"u1"}', '{"user_id":"u9","scooter_id":"s1"}'),
        ('{"id":"o-1","status":"ACTIVE"}', '{"order_id":"","offer_id":"of-2"}'),
        ('{"id":"x","order_id":"o-7"}', 'not json')], "resp string, req string")
    req = logfmt.request_keys(F.col("req"))
    resp = logfmt.response_keys(F.col("resp"))
    rows = df.select(logfmt.merged_keys(req, resp).alias("k")).select("k.*").collect()
    assert tuple(rows[0]) == ("u1", None, "of-1", "s1", None)
    assert tuple(rows[1]) == (None, "o-1", "of-2", None, "ACTIVE")
    assert tuple(rows[2]) == (None, "o-7", None, None, None)


def test_route_and_path_ids(spark):
    df = spark.createDataFrame([("POST", "/offers"), ("POST", "/orders"), ("GET", "/orders/o1"),
                                ("POST", "/orders/o1/finish"), ("GET", "/health")],
                               "m string, p string")
    got = df.select(logfmt.route(F.col("m"), F.col("p")),
                    logfmt.path_order_id(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("create_offer", None), ("create_order", None),
                                       ("get_order", "o1"), ("finish_order", "o1"),
                                       ("other", None)]


def test_request_start_query_strings(spark):
    df = spark.createDataFrame([("/orders/o1?a=1&b=2",), ("/orders/o1/finish?",), ("/offers?x=/orders/o2?y\nz",),
                                ("/orders",), (None,)], "uri string")
    got = [tuple(r) for r in logs.request_start_records(df).collect()]
    assert got == [("/orders/o1", "a=1&b=2", "o1"), ("/orders/o1/finish", None, "o1"),
                   ("/offers", "x=/orders/o2?y\nz", None), ("/orders", None, None), (None, None, None)]


def test_payment_ids_of_clear_and_refund(spark):
    feed = spark.createDataFrame(
        [("o1", "charge", False, "c0"), ("o1", "charge", True, "c1"), ("o1", "unhold", False, "u1"),
         ("o2", "charge", True, None)], "order_id string, op string, success boolean, transaction_id string")
    got = {r.order_id: r for r in finish.payment_results(feed).collect()}
    assert (got["o1"].charge_ok, got["o1"].charge_txn_id) == (True, "c1")
    assert (got["o1"].unhold_result, got["o1"].unhold_txn_id) == (False, "u1")
    assert (got["o2"].charge_ok, got["o2"].charge_txn_id, got["o2"].unhold_result) == (True, None, None)
    done = spark.createDataFrame(
        [("o1", "FINISHED", 9, True, False, "u", 5, "c1", "u1"), ("o2", "FINISHED", 9, True, True, "u", 5, None, "u2")],
        "order_id string, outcome string, total_amount int, charge_ok boolean, unhold_ok boolean, order_user_id string,"
        " order_deposit int, charge_txn_id string, unhold_txn_id string").withColumn(
        "requested_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    ids = {r.id: r.external_transaction_id for r in finish.finish_ledger(done).collect()}
    assert sorted(ids.values()) == ["", "", "c1", "u2"]


def test_documents_carry_rfc3339_times(spark):
    doc = ('{"id":"f1","user_id":"u","scooter_id":"s","zone_id":"z","price_per_minute":1,"price_unlock":2,'
           '"deposit":3,"expires_at":"%s"}')
    df = spark.createDataFrame([(doc % t,) for t in ("2024-01-01T03:00:00.5+03:00", "soon")], "value string")
    good, bad = payloads.decode_offers(df).collect()
    assert (good.expires_at, good.created_at, good._corrupt_record) == (dt.datetime(2024, 1, 1, 0, 0, 0, 500000), None, None)
    assert bad.expires_at is None and bad._corrupt_record == doc % "soon"


def test_rfc3339_roundtrip(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00.123456789Z",),
                                ("2024-01-01T10:00:00+03:00",), ("garbage",)], "s string")
    got = [r[0] for r in df.select(logfmt.parse_rfc3339(F.col("s"))).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 0, 0, 123456), dt.datetime(2024, 1, 1, 7), None]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179500),),
                                (dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert [r[0] for r in ts.select(jsonfmt.rfc3339(F.col("t"))).collect()] == [
        "2024-01-01T00:00:07.1795Z", "2024-01-01T00:00:00Z"]


def test_order_json_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None, "o1", "of1", None, None, "s1",
                                 T0, "ACTIVE", "u1")],
                               "ca int, dep int, dur int, ft timestamp_ntz, id string, "
                               "off string, ppm int, pu int, sc string, st timestamp_ntz, "
                               "status string, u string")
    doc = df.select(jsonfmt.order_json(*[F.col(c) for c in df.columns])).first()[0]
    assert doc == ('{"current_amount":null,"duration_seconds":null,"finish_time":null,'
                   '"id":"o1","offer_id":"of1","scooter_id":"s1",'
                   '"start_time":"2024-01-01T00:00:00Z","status":"ACTIVE","user_id":"u1"}')


def test_payload_decoding_classifies_malformed(spark):
    from ridelake.operators.enrich import offer_request_reject
    df = spark.createDataFrame([('{"user_id":"u1","scooter_id":"s1"}',), ("{oops",), (None,),
                                ("[1, 2]",), ('  {"user_id":""}',)], "body string")
    rows = payloads.decode_offer_requests(df).withColumn(
        "reject", offer_request_reject(F.col("user_id"), F.col("scooter_id"),
                                       F.col("_corrupt_record").isNotNull())).collect()
    assert (rows[0].user_id, rows[0]._corrupt_record, rows[0].reject) == ("u1", None, None)
    assert rows[1]._corrupt_record == "{oops" and rows[1].reject == "INVALID_BODY"
    assert rows[2]._corrupt_record == "" and rows[2].reject == "INVALID_BODY"   # no body
    assert rows[3].reject == "INVALID_BODY"                                      # not an object
    assert rows[4].reject == "USER_ID_REQUIRED"
    docs = payloads.decode_offers(spark.createDataFrame([(None,)], "value string")).first()
    assert docs._present is False                                                # absent document


def test_config_and_zone_as_of(spark):
    polls = spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=5), True, 1.5, 0.7, 28, 5),
         (T0 + dt.timedelta(seconds=10), False, None, None, None, None),
         (T0 + dt.timedelta(seconds=20), True, 2.0, 0.7, 28, 7)],
        "polled_at timestamp_ntz, success boolean, surge double, low_charge_discount double, "
        "low_charge_threshold_percent int, incomplete_ride_threshold_seconds int")
    req = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(seconds=12)),
                                 (3, T0 + dt.timedelta(seconds=25))], "r int, ts timestamp_ntz")
    v = versions.config_snapshots(polls)
    got = {r.r: r.surge for r in versions.configs_as_of(req, v).collect()}
    assert got == {1: 1.2, 2: 1.5, 3: 2.0}   # defaults, last good kept through a failure

    fetches = spark.createDataFrame(
        [("z1", T0, True, 7, 50, 200), ("z1", T0 + dt.timedelta(minutes=12), False, None, None, None)],
        "zone_id string, fetched_at timestamp_ntz, success boolean, price_per_minute int, "
        "price_unlock int, default_deposit int")
    zreq = spark.createDataFrame([(1, "z1", T0 + dt.timedelta(minutes=9)),
                                  (2, "z1", T0 + dt.timedelta(minutes=11)),
                                  (3, "z2", T0)], "r int, zone_id string, ts timestamp_ntz")
    zs = {r.r: (r.zone_available, r.price_per_minute)
          for r in versions.zones_as_of(zreq, fetches).collect()}
    assert zs == {1: (True, 7), 2: (False, None), 3: (False, None)}


def test_approx_latency_quantiles_close_to_exact(spark):
    from ridelake.operators import logs
    df = spark.range(0, 20000).select((F.col("id") % 4).alias("g"),
                                      (F.col("id") * 0.37 % 1000).alias("duration_ms"))
    ex = {r.g: r for r in logs.latency_quantiles(df, ["g"]).collect()}
    ap = {r.g: r for r in logs.latency_quantiles(df, ["g"], exact=False).collect()}
    for g in ex:
        assert abs(ex[g].p99 - ap[g].p99) <= 1.0 and abs(ex[g].p50 - ap[g].p50) <= 1.0


def test_truncation_inside_a_character(spark):
    bodies = ["x" + "é" * 600, "é" * 600, "xx" + "漢" * 400, "x" + "👩" * 300, "y" * 1000, "z" * 1001, ""]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    got = [r[0] for r in df.select(logfmt.truncate_bytes(F.col("b"), 1000)).collect()]

    def expected(b):
        raw = b.encode()
        if len(raw) <= 1000:
            return b
        whole = raw[:1000].decode(errors="ignore")
        return whole + "�" * (1000 - len(whole.encode())) + "...(truncated)"

    assert got == [expected(b) for b in bodies]


def test_only_json_strings_are_ids(spark):
    rows = [('{"user_id":5,"offer_id":true,"order_id":"o","scooter_id":{"a":"b"}}', '{"id":7,"status":3}'),
            ('{"user_id":"","offer_id":null,"scooter_id":"\\"s\\""}', '{"id":"i","expires_at":null,"status":"A"}'),
            ("[1]", "oops"), (None, '{"id":"i","order_id":7}')]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(logfmt.request_keys(F.col("a")).alias("q"), logfmt.response_keys(F.col("b")).alias("s")).collect()
    assert [tuple(r.q) for r in got] == [(None, "o", None, None), (None, None, None, '"s"'),
                                         (None,) * 4, (None,) * 4]
    assert [tuple(r.s) for r in got] == [(None,) * 4, (None, "i", None, "A"), (None,) * 4,
                                         ("i", None, None, None)]


def test_json_strings_escape_control_and_html(spark):
    import json
    texts = ["plain", "a\nb\tc\x00\x1f\x0b", 'q"\\u000B\\', "<a>&b  ", "é\x7f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(jsonfmt.json_string(F.col("t")), jsonfmt.json_string(F.col("t"), html=False)).collect()
    assert [json.loads(r[0]) for r in got] == texts and [json.loads(r[1]) for r in got] == texts
    assert got[1][0] == '"a\\nb\\tc\\u0000\\u001f\\u000b"'
    assert got[3][0] == '"\\u003ca\\u003e\\u0026b\\u2028\\u2029"' and got[3][1] == '"<a>&b  "'
    assert all("\n" not in r[0] for r in got)

import json
import math

from pyspark.sql import functions as F

from mobility.operators.ingest import dead_letters, decode_telemetry, valid_condition, valid_events

BASE = {"trip_id": "V0417-9", "driver_id": "D0417", "vehicle_id": "V0417", "zone": "airport", "lat": 7.181,
        "lon": 79.889, "speed": 41.5, "status": "on_trip", "fare": 12.75, "trip_completed": True,
        "timestamp": "2024-03-09T17:45:12.250000+00:00"}


def _with(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is _DROP:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()


def _decode(spark, payloads):
    raw = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, value string")
    return decode_telemetry(raw, keep=["id"]).withColumn("ok", valid_condition())


def test_reference_corruptions_fail_validation(spark):
    good = json.dumps(BASE)
    payloads = [good, good[: len(good) // 2], _with(vehicle_id=_DROP), _with(speed="very_fast")]
    rows = {r.id: r for r in _decode(spark, payloads).collect()}
    assert rows[0].ok and not rows[1].ok and not rows[2].ok and not rows[3].ok
    assert rows[1].vehicle_id is None and rows[1]._corrupt_record is not None  # truncated
    assert rows[2]._corrupt_record is None and rows[2].vehicle_id is None     # missing field
    assert rows[3].speed is None and rows[3].vehicle_id == "V0417"            # wrong type
    assert rows[3]._corrupt_record is not None


def test_payload_edge_cases(spark):
    payloads = [
        _with(extra="x"),                                  # 0 extra field -> valid
        _with(vehicle_id=7),                               # 1 numeric id -> "7", valid
        _with(vehicle_id=""),                              # 2 empty id -> valid
        _with(speed="NaN"),                                # 3 NaN speed -> NaN
        _with(timestamp="2024-01-01T00:00:00"),            # 4 naive timestamp -> UTC
        _with(timestamp="not a time"),                     # 5 bad timestamp -> corrupt
        None,                                              # 6 null payload
        "",                                                # 7 empty text
        "[1, 2]",                                          # 8 JSON array -> corrupt
        json.dumps(BASE) + " trailing",                    # 9 trailing bytes -> valid
    ]
    rows = {r.id: r for r in _decode(spark, payloads).collect()}
    assert rows[0].ok and rows[1].ok and rows[1].vehicle_id == "7" and rows[2].ok
    assert math.isnan(rows[3].speed)
    assert rows[4].ok and str(rows[4].event_ts) == "2024-01-01 00:00:00"
    assert not rows[5].ok and rows[5].event_ts is None
    assert not rows[6].ok and not rows[7].ok and not rows[8].ok
    assert rows[9].ok


def test_split_is_total_and_disjoint(spark):
    good = json.dumps(BASE)
    payloads = [good, good[:10], None, _with(zone=_DROP), _with(status=None)]
    d = _decode(spark, payloads)
    v = valid_events(d, keep=["id"])
    dl = dead_letters(d, keep=["id"])
    assert v.count() + dl.count() == len(payloads)
    assert {r.id for r in v.collect()} & {r.id for r in dl.collect()} == set()
    reasons = {r.id: r.reason for r in dl.collect()}
    assert reasons == {1: "corrupt_payload", 2: "missing_vehicle_id", 3: "missing_zone", 4: "missing_status"}
    assert {r.raw_value for r in dl.where(F.col("id") == 2).collect()} == {""}


def test_fares_that_money_cannot_hold_are_dead_letters(spark):
    payloads = [_with(fare=9_999_999_999.99), _with(fare=1e11), _with(fare=-1e10), _with(fare="NaN"), _with(fare=None), _with(fare=1e300)]
    d = _decode(spark, payloads)
    assert sorted(r.id for r in valid_events(d, keep=["id"]).collect()) == [0, 4]
    reasons = {r.id: r.reason for r in dead_letters(d, keep=["id"]).collect()}
    assert set(reasons) == {1, 2, 3, 5} and {reasons[i] for i in (1, 2, 5)} == {"fare_out_of_range"}

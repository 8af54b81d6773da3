from mobility.operators.dims import ZONES, vehicle_dim, zone_dim


def test_roster_of_scattered_ids(spark):
    ids = spark.createDataFrame([(3,), (999,), (9999,), (14990,), (100000,)], "i long")
    rows = sorted(map(tuple, vehicle_dim(spark, source=ids).collect()))
    assert [r[0] for r in rows] == ["V0003", "V0999", "V100000", "V14990", "V9999"]  # all distinct, none cut
    assert all(r[1] == "D" + r[0][1:] and r[2] in ZONES for r in rows)


def test_ids_wider_than_four_digits_are_not_truncated(spark):
    rows = vehicle_dim(spark, 10001).orderBy("vehicle_id").collect()
    ids = {r.vehicle_id for r in rows}
    assert "V0001" in ids and "V10001" in ids and "D10001" in {r.driver_id for r in rows}


def test_home_zone_by_index(spark):
    r = {x.vehicle_id: x.home_zone for x in vehicle_dim(spark, 5).collect()}
    assert r["V0001"] == "airport" and r["V0005"] == "downtown"


def test_zone_dim_is_broadcast(spark):
    probe = spark.createDataFrame([("airport",)], "zone string")
    plan = probe.join(zone_dim(spark), "zone")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan

import datetime as dt

from servicelake.functions.normalize import anomaly_flag, anomaly_reason, normalize_category


def test_category_rules_first_match_wins(spark):
    cases = {
        "Noise - Residential": "NOISE - RESIDENTIAL",
        "noise residential party": "NOISE - RESIDENTIAL",
        "HEAT/HOT WATER": "HEAT/HOT WATER",
        "Hot Water": "HEAT/HOT WATER",
        "Heat and Rodent": "HEAT/HOT WATER",  # rule order: heat before rodent
        "UNSANITARY CONDITION": "UNSANITARY CONDITION",
        "Illegal Parking": "ILLEGAL PARKING",
        "Water Leak": "WATER LEAK",
        "Rodent": "RODENT",
        "Street Condition": "STREET CONDITION",
        "street condition": "STREET CONDITION",  # exact match is case-sensitive -> fallback upper
        "Sidewalk Condition": "SIDEWALK CONDITION",
        "Root/Sewer/Sidewalk Condition": "ROOT/SEWER/SIDEWALK CONDITION",
        "Homeless Street Condition": "HOMELESS STREET CONDITION",
        "Broken Parking Meter": "BROKEN MUNI METER",
        "  Elevator ": "ELEVATOR",
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r["c"]: r["n"] for r in df.select("c", normalize_category("c").alias("n")).collect()}
    assert got == cases


def test_anomaly_edges(spark):
    d = dt.datetime
    rows = [
        ("same_day_inversion", d(2024, 1, 1, 10), d(2024, 1, 1, 9), "BRONX", True, "retroactively merged case"),
        ("730_days", d(2020, 1, 1), d(2021, 12, 31), "BRONX", False, None),
        ("731_days", d(2020, 1, 1), d(2022, 1, 1), "BRONX", True, "abandoned case never properly closed"),
        ("null_borough", d(2024, 1, 1), d(2024, 1, 2), None, True, "missing borough value"),
        ("blank_borough", d(2024, 1, 1), d(2024, 1, 2), "  ", True, "missing borough value"),
        ("open_ok", d(2024, 1, 1), None, "QUEENS", False, None),
        ("open_no_borough", d(2024, 1, 1), None, None, True, "missing borough value"),
        ("inversion_beats_borough", d(2024, 1, 2), d(2024, 1, 1), None, True, "retroactively merged case"),
    ]
    df = spark.createDataFrame(
        [r[:4] for r in rows], "name string, created_date timestamp_ntz, closed_date timestamp_ntz, borough string"
    )
    got = {
        r["name"]: (r["f"], r["why"])
        for r in df.select("name", anomaly_flag().alias("f"), anomaly_reason().alias("why")).collect()
    }
    for name, *_, flag, why in rows:
        assert got[name] == (flag, why), name

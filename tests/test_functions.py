"""Edge rows of every cleaning function, with hand-computed results."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimworks.functions import casts, geo, messages, ranges, text
from claimworks.schemas import CUSTOMER, strings

D = Decimal

CASES = {
    "lenient_int": (casts.lenient_int,
                    ["12", "12.7", " -3 ", "abc", "", None, "99999999999", "1e3", "7.", "+5"],
                    [12, 12, -3, None, None, None, None, None, 7, 5]),
    "lenient_long": (casts.lenient_long, ["99999999999", "1.9", "x"], [99999999999, 1, None]),
    "decimal": (casts.decimal_or_null, ["1.005", "-1.235", "123456789012.34", "abc", None],
                [D("1.01"), D("-1.24"), None, None, None]),
    "wide_decimal": (lambda c: casts.decimal_or_null(c, 15, 2), ["123456789012.34"],
                     [D("123456789012.34")]),
    "premium": (lambda c: F.abs(casts.decimal_or_null(c)), ["-12.50", "3"], [D("12.50"), D("3.00")]),
    "model_year": (lambda c: ranges.null_below(casts.lenient_int(c), 1980),
                   ["1979", "1980", None], [None, 1980, None]),
    "epoch_days": (casts.date_from_epoch_days, ["19000", "-1", None, "x"],
                   [dt.date(2022, 1, 8), dt.date(1969, 12, 31), None, None]),
    "hour": (lambda c: ranges.clamp(casts.lenient_int(c), 0, 23), ["-1", "24", "23", None],
             [0, 23, 23, None]),
    "latitude": (lambda c: ranges.clamp(casts.double_or_null(c), -90.0, 90.0),
                 ["-91", "90.5", "12.5", "nan", None], [-90.0, 90.0, 12.5, None, None]),
    "longitude": (lambda c: ranges.clamp(casts.double_or_null(c), -180.0, 180.0),
                  ["-181", "181", "7"], [-180.0, 180.0, 7.0]),
    "timestamp": (casts.parse_timestamp,
                  ["2024-01-01 00:00:00", "2024/01/01", "2024-01-01 00:00:00.123", None],
                  [dt.datetime(2024, 1, 1), None, None, None]),
    "boolean": (casts.boolean_or_null, ["true", "t", "1", "maybe", None],
                [True, True, True, None, None]),
    "boolean_words": (casts.boolean_from_words, ["TRUE", "t", "false", None],
                      [True, None, False, None]),
    "whole": (casts.whole_number, ["12", "12.0", "12.5", "1e3", "x", None, " 7 ", "9007199254740993", "inf", "nan"],
              [12, 12, None, 1000, None, None, 7, 9007199254740993, None, None]),
    "day_first": (lambda c: casts.parse_date(c, "d-M-yyyy"),
                  ["01-02-2020", "1-2-2020", "31-02-2020", "2020-02-01", None],
                  [dt.date(2020, 2, 1), dt.date(2020, 2, 1), None, None, None]),
    "iso_date": (casts.parse_date, ["2020-02-01", "2020-02-01 10:00:00", "x"],
                 [dt.date(2020, 2, 1), dt.date(2020, 2, 1), None]),
    "usual_dates": (casts.parse_date, ["2020/02/01", "2/1/2020", "1 Feb 2020", "Feb 1, 2020", "20200201",
                                       "2020-02-01T10:00:00", "soon"], [dt.date(2020, 2, 1)] * 6 + [None]),
    "clean_name": (text.clean_name, [' ""Doe, Jo"', None, "\tAnn\n"], ["Doe Jo", None, "Ann"]),
    "image_name": (text.image_name,
                   ["s3a://b/l/a b.jpg", "/x/a.PNG", "/x/axjpg", "/x/a.jpg.png", "/x/a.jpeg"],
                   ["a b.jpg", "", "axjpg", "a.jpg", ""]),
    "image_name_strict": (lambda c: text.image_name(c, strict=True),
                          ["s3a://b/l/a b.jpg", "/x/a.PNG", "/x/axjpg", "/x/a.jpeg"],
                          ["a b.jpg", "a.PNG", None, "a.jpeg"]),
    "label": (text.training_label, ["/t/1-dent.png", "/t/2-dent (2).png", "/t/x.JPG"],
              ["dent", "dent", ""]),
    "is_image": (text.is_image_path, ["/a.JPG", "/a.jpeg", "/a.txt", "/a.jpg.gz"],
                 [True, True, False, False]),
    "null_token": (text.null_if_token, ["null", "NA", "", "x", None], [None, None, None, "x", None]),
    "firstname": (lambda c: text.name_part(c, 0), ["Ann", "A B C", "", " A", None],
                  ["Ann", "A", "", "", None]),
    "lastname": (lambda c: text.name_part(c, 1), ["Ann", "A B C", "", " A", None],
                 [None, "B", None, "A", None]),
}


@pytest.mark.parametrize("name", CASES)
def test_function(either_ansi, name):
    fn, given, expected = CASES[name]
    df = either_ansi.createDataFrame(list(enumerate(given)), "i int, c string")
    rows = df.select("i", fn(F.col("c")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in rows] == expected


def test_address(spark):
    df = spark.createDataFrame([("Bronx", "10451"), (None, "10451"), (None, None)], "b string, z string")
    rows = df.select(text.join_address("b", "z").alias("r")).collect()
    assert [r["r"] for r in rows] == ["Bronx, 10451", "10451", ""]


def test_json_out_drops_nulls_and_defaults_the_key(spark):
    df = spark.createDataFrame([("x", None, 1.5), (None, "q", None)], "a string, b string, n double")
    rows = messages.encode_messages(df, "a").collect()
    assert [(r["key"], json.loads(r["value"])) for r in rows] == [
        ("x", {"a": "x", "n": "1.5"}), ("default", {"b": "q"})]


def test_telematics_map(either_ansi):
    df = either_ansi.createDataFrame(
        [('{"chassis_no":"x","speed":"1.5","latitude":2}',), ("garbage",)], "value string")
    rows = messages.parse_telematics(df).collect()
    assert rows[0].asDict() == {
        "chassis_no": "x", "latitude": "2", "longitude": None, "event_timestamp": None, "speed": "1.5"}
    assert all(v is None for v in rows[1])


def test_envelope(either_ansi):
    good = json.dumps({"before": None, "after": {"customer_id": "1", "name": "A"},
                       "source": {"table": "customer"}, "op": "c", "ts_ms": 5})
    gone = json.dumps({"before": {"customer_id": "1"}, "after": None,
                       "source": {"table": "customer"}, "op": "d", "ts_ms": 6})
    df = either_ansi.createDataFrame(
        [(good, 1), (None, 2), ("garbage", 3), (gone, 4)], "value string, offset long")
    parsed = messages.parse_envelopes(df)
    images = messages.row_images(messages.route(parsed, "customer"), CUSTOMER)
    rows = sorted(images.collect(), key=lambda r: r["ts_ms"])
    assert [(r["op"], r["image"]["customer_id"], r["image"]["name"]) for r in rows] == [
        ("c", "1", "A"), ("d", "1", None)]
    expanded = messages.expand_images(images)
    assert expanded.columns == ["op", *strings(*CUSTOMER.names).names]
    assert messages.known_tables(parsed, {"policy": None}).count() == 0


def test_binary_message_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"speed":"3"}'),)], "value binary")
    assert messages.parse_telematics(df).first()["speed"] == "3"


def test_geocoders_agree(spark):
    df = spark.createDataFrame([("Bronx, 10451",), ("",), (None,), ("Bronx, 10451",)], "address string")
    native = df.select("address", geo.hashed_lat_long("address").alias("lat_long"))
    by_udf = geo.geocode(df, "address", geo.geocode_udf(geo.hash_geocoder))
    key = lambda r: (r["address"] or "~", str(r["lat_long"]))
    assert sorted(native.collect(), key=key) == sorted(by_udf.collect(), key=key)
    assert by_udf.schema["lat_long"].dataType == native.schema["lat_long"].dataType
    place = native.filter("address = ''").first()["lat_long"]
    assert -90 <= place["latitude"] <= 90 and -180 <= place["longitude"] <= 180


def test_failed_lookup_spoils_only_its_address(spark):
    def make():
        import pandas as pd

        def locate(addresses):
            if (addresses == "bad").any():
                raise ValueError("no such place")
            return pd.DataFrame({"latitude": [1.0] * len(addresses), "longitude": [2.0] * len(addresses)})

        return locate

    df = spark.createDataFrame([("a",), ("bad",), ("b",)], "address string").coalesce(1)
    rows = geo.geocode(df, "address", geo.geocode_udf(make)).collect()
    found = {r["address"]: tuple(r["lat_long"]) for r in rows}
    assert found == {"a": (1.0, 2.0), "b": (1.0, 2.0), "bad": (None, None)}


def test_places_table(spark):
    places = spark.createDataFrame([("a", 1.0, 2.0)], "address string, latitude double, longitude double")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "address string")
    rows = geo.geocode_from_table(df, "address", places).collect()
    assert {r["address"]: tuple(r["lat_long"]) for r in rows} == {
        "a": (1.0, 2.0), "z": (None, None), None: (None, None)}

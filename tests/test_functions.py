from anemoi.functions.expressions import missing_as_null, parse_timestamp


def test_missing_as_null(spark):
    df = spark.createDataFrame([(0.0,), (float("nan"),), (None,), (2.5,), (-1.0,)], "v double")
    got = [r[0] for r in df.select(missing_as_null("v")).collect()]
    assert got == [None, None, None, 2.5, -1.0]
    kept = [r[0] for r in df.select(missing_as_null("v", zero_is_missing=False)).collect()]
    assert kept[0] == 0.0 and kept[1] is None


def test_parse_timestamp_layouts(spark):
    rows = [("2022-03-01 00:00:00",), ("2022-03-01T05:06:07",), ("01/03/2022 00:00:00",),
            ("12/31/2022 23:59",), ("not a date",), (None,), ("2022-13-01 00:00:00",), ("31/12/2022 10:00:00",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert str(got[0]) == "2022-03-01 00:00:00"
    assert str(got[1]) == "2022-03-01 05:06:07"
    assert str(got[2]) == "2022-01-03 00:00:00"       # month first by default
    assert str(got[3]) == "2022-12-31 23:59:00"
    assert got[4] is None and got[5] is None and got[6] is None and got[7] is None
    dayfirst = [r[0] for r in df.select(parse_timestamp("s", day_first=True)).collect()]
    assert str(dayfirst[2]) == "2022-03-01 00:00:00"
    assert str(dayfirst[7]) == "2022-12-31 10:00:00"

"""Column functions: keys, casts, clocks, tails (fixture values worked out by hand)."""

import math

from pyspark.sql import functions as F

from fipsight.functions import (bool_text_flag, composite_id, day_of_year0, equals_flag,
                                fips_from_float_text, fips_from_parts, hours_between, pad_min,
                                parse_timestamp, response_minutes, safe_double, t_tail,
                                year_of_id)


def test_pad_keeps_long_text(spark):
    df = spark.createDataFrame([("1", "73"), ("01", "073"), ("6", "12345")], "s string, c string")
    got = [tuple(r) for r in df.select(pad_min("s", 2), pad_min("c", 3),
                                       fips_from_parts("s", "c")).collect()]
    assert got == [("01", "073", "01073"), ("01", "073", "01073"), ("06", "12345", "0612345")]


def test_fips_from_float_text(spark):
    df = spark.createDataFrame([("1001.0",), ("1.0",), ("49049",), ("FIPS",), (None,)], "f string")
    got = [r[0] for r in df.select(fips_from_float_text("f")).collect()]
    assert got == ["01001", "1", "49049", None, None]


def test_composite_id_and_year(spark):
    df = spark.createDataFrame([(1002.0, 2008)], "case double, year int")
    r = df.select(composite_id("case", "year").alias("id")).select("id", year_of_id("id")).first()
    assert tuple(r) == ("10022008", 2008)


def test_safe_double(spark):
    df = spark.createDataFrame([("70",), ("",), (" 1 ",), ("abc",), ("nan",), ("inf",)], "v string")
    got = [r[0] for r in df.select(safe_double("v")).collect()]
    assert got == [70.0, None, 1.0, None, None, None]
    got2 = [r[0] for r in df.select(safe_double("v", finite_only=False)).collect()]
    assert math.isnan(got2[4]) and got2[5] == float("inf")


def test_flags(spark):
    df = spark.createDataFrame([("R", "False"), ("L", "True"), (None, None), ("r", "x")],
                               "side string, b string")
    got = [tuple(r) for r in df.select(equals_flag("side", "R"), bool_text_flag("b")).collect()]
    assert got == [(1, 0), (0, 1), (0, 1), (0, 1)]


def test_dates_fixture(spark):
    df = spark.createDataFrame([("2016-03-01 00:00:00", "2016-03-01 01:07:12"),
                                ("2015-01-01 10:00:00", "2015-01-01 10:00:09"),
                                ("bad", "2015-01-01 10:00:00")], "s string, e string")
    s, e = parse_timestamp("s"), parse_timestamp("e")
    got = [tuple(r) for r in df.select(F.year(s), F.month(s), day_of_year0(s),
                                       hours_between(s, e)).collect()]
    assert got[0] == (2016, 3, 60, 1.12)
    assert got[1] == (2015, 1, 0, 0.0)
    assert got[2] == (None, None, None, None)


def test_hours_half_even(spark):
    # 0.125 h = 450 s -> 12.5 hundredths -> half-even 0.12 ; 0.375 h -> 0.38
    df = spark.createDataFrame([("2020-01-01 00:00:00", "2020-01-01 00:07:30"),
                                ("2020-01-01 00:00:00", "2020-01-01 00:22:30")], "s string, e string")
    got = [r[0] for r in df.select(hours_between(parse_timestamp("s"),
                                                 parse_timestamp("e"))).collect()]
    assert got == [0.12, 0.38]


def test_response_minutes_fixture(spark):
    rows = [("10", "05", "10", "15", 10), ("23", "50", "00", "10", 20),
            ("10", "30", "10", "20", 10), ("10", "00", "99", "99", None),
            ("24", "00", "01", "00", None), (None, None, None, None, None),
            ("12", "00", "11", "59", 1439)]
    df = spark.createDataFrame(rows, "ch string, cm string, ah string, am string, want int")
    got = df.select(response_minutes("ah", "am", "ch", "cm").alias("m"), "want").collect()
    assert [r.m for r in got] == [r.want for r in got]
    assert all(r.m is None or 0 <= r.m <= 1439 for r in got)


# Published sample results that the p-values must equal.
GOLD_BETAS = [0.1953718, 0.13067577, 0.25432685, 0.17172011, 0.82247048, -0.32328639,
              0.1149682, -0.04738236, 0.50077324, 0.27765478]
GOLD_P = [8.668711e-06, 8.762447e-04, 1.305886e-07, 4.796106e-05, 2.162769e-19, 1.329548e-09,
          2.521899e-03, 1.100518e-01, 6.865257e-14, 2.642504e-08]
GOLD_SE = 0.03777595527855161


def test_t_tail_golden(spark):
    df = spark.createDataFrame([(b / GOLD_SE, 28) for b in GOLD_BETAS], "t double, dof int")
    got = [r[0] for r in df.select(t_tail("t", "dof")).collect()]
    for g, w in zip(got, GOLD_P):
        assert abs(g - w) / w < 1e-5
    # order property: larger |beta| -> smaller p
    order_b = sorted(range(10), key=lambda i: -abs(GOLD_BETAS[i]))
    order_p = sorted(range(10), key=lambda i: got[i])
    assert order_b == order_p


def test_t_tail_two_sided_and_reference_point(spark):
    df = spark.createDataFrame([(1.812461, 10), (None, 10), (1.0, 0)], "t double, dof int")
    one = [r[0] for r in df.select(t_tail("t", "dof")).collect()]
    two = [r[0] for r in df.select(t_tail("t", "dof", tails=2)).collect()]
    assert abs(one[0] - 0.05) < 1e-6 and abs(two[0] - 0.1) < 2e-6
    assert one[1] is None and one[2] is None


def test_package_pickled_by_value():
    """Executors need not have the package: its functions travel by value to Python workers."""
    import fipsight.operators.select as sel
    from pyspark import cloudpickle
    assert cloudpickle.cloudpickle._is_registered_pickle_by_value(sel)

"""Absolute dates in free order, against outcomes written by hand."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civiclens.functions import celltypes as ct
from civiclens.functions.dates import parse_date

D = dt.datetime(2019, 1, 5)
DATES = {
    "20190105": D, "2019-01-05": D, "2019/1/5": D, "2019.01.05": D, "01/05/2019": D, "1/5/2019": D, "1/5/19": D,
    "05.01.2019": dt.datetime(2019, 5, 1), "13/1/2019": dt.datetime(2019, 1, 13), "Sat Jan 5 2019": D,
    "Saturday, January 5, 2019": D, "Sat, 05 Jan 2019": D, "5 Jan 2019": D, "5-JAN-19": D, "05Jan2019": D,
    "Jan. 5, 2019": D, "January 5th, 2019": D, "the 5 Jan 2019": None, "5th of January 2019": D, "2019 Jan 5": D,
    "2019-Jan-05": D, "Jan 2019 5": D, "5 2019 Jan": D, "Sept 3, 2018": dt.datetime(2018, 9, 3),
    "5 Jan 2019 10:30 PM": D.replace(hour=22, minute=30), "Jan 5 2019 12:00 AM": D, "Jan 5 2019 12:15 pm": D.replace(hour=12, minute=15),
    "10:30 5 Jan 2019": D.replace(hour=10, minute=30), "2019-01-05T10:30:07": D.replace(hour=10, minute=30, second=7),
    "2019-01-05 10:30:07.25": D.replace(hour=10, minute=30, second=7, microsecond=250000),
    "2019-01-05 10:30:07,123456789": D.replace(hour=10, minute=30, second=7, microsecond=123456),
    "20190105T103007": D.replace(hour=10, minute=30, second=7), "20190105 10:30": D.replace(hour=10, minute=30),
    "201901051030": D.replace(hour=10, minute=30), "20190105103007": D.replace(hour=10, minute=30, second=7),
    "1/5/2019 3 PM": D.replace(hour=15), "2019-01-05T10:30Z": D.replace(hour=10, minute=30),
    "2019-01-05 10:30 UTC": D.replace(hour=10, minute=30), "2019-01-05T10:30:00+02:00": D.replace(hour=8, minute=30),
    "2019-01-05 10:30 -0130": D.replace(hour=12), "2019-01-05 10:30 GMT+03": D.replace(hour=13, minute=30),
    "Sat Jan  5 10:30:00 EST 2019": D.replace(hour=10, minute=30), "10:30 SAT 5 JAN 2019": D.replace(hour=10, minute=30),
    "2/29/2020": dt.datetime(2020, 2, 29),
    # none: not there, partial, or no date at all
    "2/29/2019": None, "2019-13-45": None, "31 Apr 2019": None, "32 Jan 2019": None, "Jan 5": None, "Jan 2019": None,
    "Mon": None, "10:30": None, "2019": None, "201901": None, "1.2.3": None, "1.2.2003.4": None, "25-989-741-2988": None,
    "Room 5, 2019": None, "12-ABC-99": None, "Customer#000000001": None, "Jan 5 2019 13:00 PM": None,
    "Jan 5 2019 24:00": None, "Jan 5 2019 10:60": None, "10:30 11:30 5 Jan 2019": None, "2019-01-05 10:30 +19:00": None,
    "Mayor 5 2019": None, "5 Marsh 2019": None, "": None, None: None, "0-0-0": None, "20191305": None,
}


def test_dates_by_hand(spark):
    df = spark.createDataFrame([(v,) for v in DATES], "v string")
    text = F.date_format(parse_date(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    got = {r.v: r.t for r in df.select("v", text.alias("t")).collect()}
    want = {v: d and d.strftime("%Y-%m-%d %H:%M:%S.%f") for v, d in DATES.items()}
    assert {v: (got[v], want[v]) for v in want if got[v] != want[v]} == {}


def test_order_of_types_stays(spark):
    df = spark.createDataFrame([("20190105",), ("Sat Jan 5 2019",), ("1.2.3",)], "v string")
    assert [r.t for r in df.select(ct.cell_type(F.col("v")).alias("t")).collect()] == ["int", "date", "text"]
    named = ct.cell_type(F.col("v"), date_by_name=F.lit(True))
    assert [r.t for r in df.select(named.alias("t")).collect()] == ["date", "date", "date"]


def test_given_formats_only(spark):
    df = spark.createDataFrame([("2019-01-05",), ("5 Jan 2019",)], "v string")
    got = [r.t for r in df.select(ct.date_value(F.col("v"), ["yyyy-M-d"]).alias("t")).collect()]
    assert got == [D, None] or [g and g.date() for g in got] == [D.date(), None]


FORMS = ["%Y-%m-%d", "%m/%d/%Y", "%d %b %Y", "%B %d, %Y", "%a %b %d %Y", "%A, %d %B %Y", "%Y/%m/%d %H:%M:%S", "%Y%m%d",
         "%d-%b-%Y %I:%M %p", "%b %d %Y %I:%M:%S %p", "%H:%M %d %B %Y", "%Y%m%dT%H%M%S", "%Y-%m-%dT%H:%M:%SZ"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.datetimes(dt.datetime(1000, 1, 1), dt.datetime(9999, 12, 31)), st.sampled_from(FORMS)),
                min_size=300, max_size=300))
def test_written_dates_come_back(spark, cases):
    rows = [(d.strftime(f).replace(d.strftime("%Y"), f"{d.year:04d}", 1), dt.datetime.strptime(d.strftime(f), f)) for d, f in cases]
    df = spark.createDataFrame([(t, d.strftime("%Y-%m-%d %H:%M:%S")) for t, d in rows], "t string, want string")
    got = F.date_format(parse_date(F.col("t")), "yyyy-MM-dd HH:mm:ss")
    bad = df.filter(~got.eqNullSafe(F.col("want"))).collect()
    assert bad == []


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text("0123456789-/:. JanfebTZ+pm,", max_size=24), min_size=300, max_size=300))
def test_no_text_is_an_error(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select(parse_date(F.col("t")).alias("d")).where("year(d) between 1 and 9999 or d is null").count() == len(texts)

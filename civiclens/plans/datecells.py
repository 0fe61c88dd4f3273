"""Query over the date grammar: order dates written in many absolute forms,
and texts that look like dates, against outcomes written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclens.functions import celltypes as ct
from civiclens.plans.catalog import register
from civiclens.sources.tables import Tables

# Form of the row with o_orderkey % 16 = place: Spark pattern, DuckDB pattern.
# The time is 10:30 PM where a form has one.
FORMS = (
    ("yyyy-MM-dd", "%Y-%m-%d"),
    ("EEE MMM d yyyy", "%a %b %-d %Y"),
    ("EEEE, d MMMM yyyy", "%A, %-d %B %Y"),
    ("d MMM yyyy h:mm a", "%-d %b %Y %-I:%M %p"),
    ("HH:mm d-MMM-yyyy", "%H:%M %-d-%b-%Y"),
    ("yyyy.MM.dd", "%Y.%m.%d"),
    ("MMM. d, yyyy", "%b. %-d, %Y"),
    ("EEE MMM d HH:mm:ss 'EST' yyyy", "%a %b %-d %H:%M:%S EST %Y"),
    ("yyyyMMdd'T'HHmmss", "%Y%m%dT%H%M%S"),
    ("yyyyMMdd HH:mm", "%Y%m%d %H:%M"),
    ("M/d/yyyy", "%-m/%-d/%Y"),
    # no dates: partial, impossible or other texts
    ("MMMM yyyy", "%B %Y"),
    ("EEEE HH:mm", "%A %H:%M"),
    ("yyyy-13-dd", "%Y-13-%d"),
    ("'Room' d, yyyy", "Room %-d, %Y"),
    ("MMM d", "%b %-d"),
)
N_DATES, WITH_TIME = 11, (3, 4, 7, 8, 9)

_SQL_FORM = " ".join(f"WHEN {i} THEN strftime(ts, '{d}')" for i, (_, d) in enumerate(FORMS))
_SQL = f"""
WITH o AS (SELECT o_orderkey, o_orderkey % {len(FORMS)} AS form, CAST(o_orderdate AS DATE) + INTERVAL 81000 SECOND AS ts
           FROM orders)
SELECT o_orderkey, CASE form {_SQL_FORM} END AS cell,
       CASE WHEN form < {N_DATES} THEN 'date' ELSE 'text' END AS cell_type,
       CASE WHEN form IN {WITH_TIME} THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            WHEN form < {N_DATES} THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS instant
FROM o
"""


@register("date_forms", _SQL)
def q_date_forms(spark, sf_dir):
    """Cell type and instant of absolute dates in many forms."""
    form = F.col("o_orderkey") % len(FORMS)
    ts = F.expr("CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 81000 SECOND")
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", form.alias("form"), ts.alias("ts"))
    cell = F.lit(None).cast("string")
    for i, (pattern, _) in enumerate(FORMS):
        cell = F.when(F.col("form") == i, F.date_format("ts", pattern)).otherwise(cell)
    cells = orders.select("o_orderkey", cell.alias("cell"))
    return cells.select("o_orderkey", "cell", ct.cell_type("cell").alias("cell_type"),
                        F.date_format(ct.date_value("cell"), "yyyy-MM-dd HH:mm:ss").alias("instant"))

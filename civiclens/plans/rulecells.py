"""Queries that bring out both answers of every semantic rule.

Every customer gives one cell to each column below.  What the cell looks
like depends on the customer's market segment, and the outcome is written
down next to the column by hand: ``y`` (the rule's label), ``n`` (``Other``)
or ``-`` (an empty cell, ``NULL``), one letter per segment.  The oracle
counts customers per outcome and knows nothing of the rule table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclens.functions.validators import draft_rule_table
from civiclens.operators import semantic as sem
from civiclens.plans.catalog import register
from civiclens.sources.tables import Tables

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

# SQL pieces both engines read alike.
_K = "CAST(c_custkey AS STRING)"
_DIGITS = f"lpad({_K}, 10, '0')"


def _one_of(words: str) -> str:
    """A word of a comma-separated list, another one for every customer."""
    n = len(words.split(","))
    return f"split_part('{words}', ',', CAST(c_custkey % {n} AS INT) + 1)"


_STREET = _one_of("street,avenue,boulevard,road,roadway,court,highway,lane,pavement,place,route,"
                  "thoroughfare,track,trail,artery,byway,drag,drive,parkway,passage,row,stroll,"
                  "terrace,turf,trace,turnpike,way")
_SCHOOL = _one_of("university,school,institute,academy,college")
_LEVEL = _one_of("elementary,middle,high,yabc,k")
_SUBJECT = _one_of("social studies,mathematics,math,english,science")
_BOROUGH = _one_of("bronx,brooklyn,manhattan,queens,staten island,1,2,3,4,5,mn,bx,bk,qn,si,m,x,r,k,q")
_AGENCY = _one_of("NYPD,DOT,FDNY,DOE,HPD,TLC,DSNY,311,Brooklyn,NYCEM")
_PHONE = [f"substr({_DIGITS}, {a}, {n})" for a, n in ((1, 3), (4, 3), (7, 4))]

# (column, label, outcome per segment, cell per segment)
CELLS = [
    ("first_name", "person_name", "yyn-n",
     ("c_mktsegment", "'Smith, ' || lower(c_mktsegment)", "c_name", "''", "'Mary Ann ' || c_mktsegment")),
    ("business_name", "business_name", "yn-yn",
     ("c_name", "'7'", "''", "'ab'", "substr(c_mktsegment, 1, 1)")),
    ("street_name", "street_name", "yynn-",
     (f"{_K} || ' Market ' || {_STREET}", f"'West' || upper({_STREET})", "c_name", "c_mktsegment", "NULL")),
    ("school_name", "school_name", "yynn-",
     (f"{_SCHOOL} || ' of ' || c_name", f"'PS 12 ' || upper({_SCHOOL})", "c_mktsegment", "c_name", "''")),
    ("park_name", "park_playground", "yny-n",
     ("c_name", "'abc'", "'abcd'", "''", "substr(c_mktsegment, 1, 3)")),
    ("school_level", "school_level", "yynn-",
     (_LEVEL, f"'Grade ' || upper({_LEVEL})", "'PS 12'", "c_name", "''")),
    ("subject", "subject_in_school", "yny-n",
     (_SUBJECT, "'PE'", "'art'", "NULL", "substr(c_mktsegment, 1, 2)")),
    ("interest", "area_of_study", "yny-n", ("c_mktsegment", "'law'", "c_name", "''", "'Ed.'")),
    ("agency_id", "city_agency", "yyn-y", (_AGENCY, _K, "'dob'", "''", "c_name")),
    ("house_number", "house_number", "yynn-", (_K, "c_mktsegment", f"'#' || {_K}", f"' ' || {_K}", "''")),
    ("prem_typ_desc", "location_type", "yny-n",
     ("c_mktsegment", _K, f"'#' || {_K}", "''", f"{_K} || ' ' || c_mktsegment")),
    ("phone", "phone_number", "yynn-",
     (f"'(' || {_PHONE[0]} || ') ' || {_PHONE[1]} || '-' || {_PHONE[2]}",
      f"{_PHONE[0]} || '.' || {_PHONE[1]} || '.' || {_PHONE[2]}", _DIGITS, "c_name", "''")),
    ("website", "website", "yynn-",
     (f"'https://www.' || lower(c_mktsegment) || '.com/' || {_K}", "lower(c_mktsegment) || '-shop.org'",
      "c_name", "'http:// ' || lower(c_mktsegment) || '.com'", "''")),
    ("latitude", "lat_coordinates", "yynn-",
     ("CAST(c_custkey % 91 AS STRING)", "'-' || CAST(c_custkey % 90 AS STRING) || '.25'",
      "CAST(c_custkey + 91 AS STRING)", "c_name", "''")),
    ("longitude", "lon_coordinates", "yynn-",
     ("CAST(c_custkey % 181 AS STRING)", "'-' || CAST(c_custkey % 180 AS STRING) || '.5'",
      "CAST(c_custkey + 181 AS STRING)", "c_mktsegment", "''")),
    ("location", "lat_lon_cord", "yynn-",
     (f"'(40.' || {_K} || ', -73.' || {_K} || ')'", f"'40.' || {_K} || ' -73.5'", f"'40.' || {_K}",
      "'95.5, -73.5'", "''")),
    ("zip", "zip_code", "yynn-",
     (f"lpad({_K}, 5, '0')", f"' ' || lpad({_K}, 5, '0') || '-1234'", "'123'", "c_mktsegment", "''")),
    ("borough", "borough", "yynn-", (_BOROUGH, f"upper({_BOROUGH})", "c_mktsegment", "c_name", "''")),
    ("city", "city", "yynn-", ("c_mktsegment", "lower(c_mktsegment)", _K, "'New York'", "''")),
    ("neighborhood", "neighborhood", "yynn-", ("c_mktsegment", "c_name", _K, "'#' || c_mktsegment", "''")),
    ("address", "address", "yynn-",
     (f"{_K} || ' Main St, NY ' || lpad({_K}, 5, '0')", "c_name", "c_mktsegment", "'12 Main St'", "''")),
    ("building_classification", "building_classification", "yny-n",
     ("c_mktsegment", "'A'", f"'B' || {_K}", "''", "'7'")),
    ("color", "color", "yny-n",
     ("lower(c_mktsegment)", _K, f"'#' || {_K}", "''", f"{_K} || c_mktsegment")),
    ("vehicle_make", "car_make", "yny-n", ("c_mktsegment", _K, "c_name", "''", "'4x4'")),
    ("vehicle_type", "vehicle_type", "yny-n", ("c_mktsegment", "'V'", "c_name", "NULL", "'1'")),
]

# The drafts' own rules; business and school names are accepted unless empty.
DRAFT_CELLS = [
    ("first_name", "person_name", "yynn-",
     ("c_mktsegment", "'Smith, ' || lower(c_mktsegment)", "'Smith,  ' || lower(c_mktsegment)", "c_name", "''")),
    ("business", "business_name", "yyy--", ("c_name", "'7'", _K, "''", "NULL")),
    ("school", "school_name", "yyy--", ("c_name", "'7'", _K, "''", "NULL")),
    ("zipcode", "ny_zipcode", "ynnn-",
     (f"'1' || lpad({_K}, 4, '0')", f"'2' || lpad({_K}, 4, '0')", f"'1' || lpad({_K}, 5, '0')",
      f"' 1' || lpad({_K}, 4, '0')", "''")),
    # no special draft rule: the ordinary one decides
    ("color", "color", "yny-n",
     ("lower(c_mktsegment)", _K, f"'#' || {_K}", "''", f"{_K} || c_mktsegment")),
]


def _cell(forms) -> str:
    return "CASE c_mktsegment " + " ".join(
        f"WHEN '{s}' THEN {form}" for s, form in zip(SEGMENTS, forms)) + " END"


def cell_frame(spark, sf_dir, cells):
    """The customers' cells as one wide string table."""
    return Tables(spark, sf_dir).customer.select(
        *[F.expr(_cell(forms)).cast("string").alias(name) for name, _, _, forms in cells])


def _outcome_sql(cells) -> str:
    rows = ", ".join(f"('{name}', '{label}', '{marks}')" for name, label, marks, _ in cells)
    places = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SEGMENTS, 1))
    return f"""
WITH expected AS (SELECT * FROM (VALUES {rows}) AS v(column_name, label, marks)),
seg AS (SELECT CASE c_mktsegment {places} END AS place, count(*) AS n FROM customer GROUP BY 1),
outcome AS (
  SELECT column_name,
         CASE substr(marks, place, 1) WHEN 'y' THEN label WHEN 'n' THEN 'Other' ELSE 'NULL' END AS semantic_type,
         n
  FROM expected, seg)
SELECT 'customer' AS dataset_name, column_name, semantic_type, semantic_type AS label,
       CAST(sum(n) AS BIGINT) AS count
FROM outcome GROUP BY ALL"""


@register("semantic_rules", _outcome_sql(CELLS))
def q_semantic_rules(spark, sf_dir):
    """T1.1-T1.25: accepted, rejected and empty cells of every rule."""
    return sem.semantic_labels(cell_frame(spark, sf_dir, CELLS), "customer")


@register("semantic_draft_rules", _outcome_sql(DRAFT_CELLS))
def q_semantic_draft_rules(spark, sf_dir):
    """T5, T1.a-T1.c: the drafts' rules, accepted, rejected and empty cells."""
    return sem.semantic_labels(cell_frame(spark, sf_dir, DRAFT_CELLS), "customer",
                               rules=draft_rule_table())

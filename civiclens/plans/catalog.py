"""Registered queries over the driver tables.

Each entry pairs a Spark query ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL (or ``None`` when SQL cannot express it; those are
tested against brute force in ``tests/``).  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.operators import relational as rel
from civiclens.operators import profile as prof
from civiclens.operators import rules
from civiclens.operators import semantic as sem
from civiclens.operators import textml
from civiclens.operators import resolve
from civiclens.functions.text import remove_substrings
from civiclens.functions.validators import draft_rule_table, semantic_label_sql
from civiclens.operators._plan import global_ntile, materialize
from civiclens.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------
# V family: relational summaries
# --------------------------------------------------------------------------

@register("anti_join", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date
FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_anti_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    open_orders = rel.unresolved(t.orders, t.lineitem, "o_orderkey", "l_orderkey")
    return open_orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                              F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


@register("count_by_key", """
SELECT l_returnflag, count(*) AS num FROM lineitem GROUP BY l_returnflag
""")
def q_count_by_key(spark, sf_dir):
    return rel.count_by(Tables(spark, sf_dir).lineitem, "l_returnflag")


@register("sum_avg_by_key", """
SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total,
       round(avg(o_totalprice), 2) AS average
FROM orders GROUP BY o_orderpriority
""")
def q_sum_avg_by_key(spark, sf_dir):
    return rel.sum_avg_by(Tables(spark, sf_dir).orders, "o_orderpriority", "o_totalprice")


@register("bucket_count", """
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'MACHINERY' ELSE 'Other' END AS bucket,
       count(*) AS num
FROM customer GROUP BY 1
""")
def q_bucket_count(spark, sf_dir):
    return rel.bucket_count(Tables(spark, sf_dir).customer, "c_mktsegment", "MACHINERY")


_ORDER_COUNTS = """
(SELECT o_custkey, o_orderstatus, count(*) AS num FROM orders GROUP BY 1, 2)
"""


@register("argmax_ties", f"""
SELECT o_custkey, o_orderstatus, num FROM {_ORDER_COUNTS} c
WHERE num = (SELECT max(num) FROM {_ORDER_COUNTS} m)
""")
def q_argmax_ties(spark, sf_dir):
    return rel.most_frequent(Tables(spark, sf_dir).orders, ["o_custkey", "o_orderstatus"])


@register("top20", f"""
SELECT o_custkey, o_orderstatus, num FROM {_ORDER_COUNTS} c
ORDER BY num DESC, o_custkey, o_orderstatus LIMIT 20
""")
def q_top20(spark, sf_dir):
    return rel.top_k(Tables(spark, sf_dir).orders, ["o_custkey", "o_orderstatus"], 20)


# The weekend days of the reference's month (March 2016) and
# the numbers of weekend and weekday days it divides by.
WEEKEND_DAYS = (5, 6, 12, 13, 19, 20, 26, 27)
N_WEEKEND_DAYS = 8
N_WEEKDAYS = 23


@register("calendar_average", """
SELECT o_orderpriority,
       round(sum(CASE WHEN day(o_orderdate) IN (5, 6, 12, 13, 19, 20, 26, 27) THEN 1 ELSE 0 END) / 8.0, 2)
         AS weekend_average,
       round(sum(CASE WHEN day(o_orderdate) NOT IN (5, 6, 12, 13, 19, 20, 26, 27) THEN 1 ELSE 0 END) / 23.0, 2)
         AS weekday_average
FROM orders GROUP BY o_orderpriority
""")
def q_calendar_average(spark, sf_dir):
    return rel.calendar_average(Tables(spark, sf_dir).orders, "o_orderpriority", "o_orderdate",
                                WEEKEND_DAYS, N_WEEKEND_DAYS, N_WEEKDAYS)


def _orders_by_region_nation(t: Tables) -> DataFrame:
    return (t.orders.select("o_custkey", F.year("o_orderdate").alias("year"))
            .join(t.customer.select("c_custkey", "c_nationkey"),
                  F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("year", "r_name", "n_name"))


@register("topk_per_group", """
SELECT year, r_name, n_name, num, rank FROM (
  SELECT year, r_name, n_name, num,
         CAST(row_number() OVER (PARTITION BY year, r_name ORDER BY num DESC, n_name) AS INTEGER) AS rank
  FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, r_name, n_name, count(*) AS num
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3)
) WHERE rank <= 3
""")
def q_topk_per_group(spark, sf_dir):
    return rel.top_k_per_group(_orders_by_region_nation(Tables(spark, sf_dir)),
                               ["year", "r_name"], "n_name", k=3)


@register("lookup_fill", """
WITH c AS (
  SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS zip,
         CASE WHEN c_acctbal < 0 THEN 'Unspecified' ELSE c_mktsegment END AS borough
  FROM customer),
lk AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS k, max(r_name) AS v
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT c_custkey, zip, borough,
       CASE WHEN zip IS NOT NULL AND borough = 'Unspecified' THEN lk.v ELSE borough END
         AS borough_filled
FROM c LEFT JOIN lk ON c.zip = lk.k
""")
def q_lookup_fill(spark, sf_dir):
    t = Tables(spark, sf_dir)
    complaints = t.customer.select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("zip"),
        F.when(F.col("c_acctbal") < 0, F.lit("Unspecified"))
         .otherwise(F.col("c_mktsegment")).alias("borough"))
    lookup = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("n_nationkey").cast("string").alias("zip"), "r_name"))
    return rel.fill_from_lookup(complaints, "zip", "borough", lookup, "zip", "r_name",
                                out="borough_filled")


# DuckDB (RE2) spelling of the whitespace class in functions/text.py.
_DUCK_WS = ("[\\s\\v\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
            "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+")


@register("word_count", f"""
SELECT word, count(*) AS num FROM (
  SELECT lower(regexp_replace(regexp_replace(tok, '^[[:punct:]]+', ''), '[[:punct:]]+$', '')) AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '{_DUCK_WS}')) AS tok FROM conversations)
) WHERE word <> '' GROUP BY word
""")
def q_word_count(spark, sf_dir):
    return rel.word_count(Tables(spark, sf_dir).conversations, "text")


# --------------------------------------------------------------------------
# R family: frequent itemsets, rules, protection
# --------------------------------------------------------------------------

# Parameters of the registered rule queries.  The driver tables are
# uniform, so a low support keeps every level populated.
RULE_SUPP = 100
RULE_CONF = 0.1
RULE_PROT = 1.0
RULE_PROTECTED = "status"
RULE_CONSEQUENT = "vdecile"
RULE_CONF_ROUNDED = 0.11

# Integer codes of the categorical attributes.
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
STATUS_CODES = {"F": 1, "O": 2, "P": 3}
RULE_ATTRS = ["priority", "region", "segment", "status", "vdecile"]


def _code(col: str, codes: dict[str, int]):
    expr = None
    for k, v in codes.items():
        expr = (F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v))
    return expr


def order_items(spark: SparkSession, sf_dir: str, keep: bool = False) -> DataFrame:
    """Long (uid, attr, val) view of orders: priority, region, segment,
    status and the price decile (ntile 10 by totalprice, orderkey).  ``keep``:
    the rows are melted from a table that is computed once, one row an order."""
    t = Tables(spark, sf_dir)
    orders = global_ntile(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                        "o_totalprice"),
        10, ["o_totalprice", "o_orderkey"], "vdecile")
    wide = (orders
            .join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
                  F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation.select("n_nationkey", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("uid"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
                    F.col("n_regionkey").alias("region"),
                    _code("c_mktsegment", SEGMENT_CODES).alias("segment"),
                    _code("o_orderstatus", STATUS_CODES).alias("status"),
                    "vdecile"))
    return rules.long_items(materialize(wide) if keep else wide, "uid", RULE_ATTRS)


def _sql_case(col: str, codes: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in codes.items()) + " END"


_ITEMS_SQL = f"""
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS vdecile
  FROM orders),
base AS (
  SELECT o_orderkey AS uid,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
         n_regionkey AS region,
         {_sql_case('c_mktsegment', SEGMENT_CODES)} AS segment,
         {_sql_case('o_orderstatus', STATUS_CODES)} AS status,
         CAST(vdecile AS INTEGER) AS vdecile
  FROM o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
item AS (
  SELECT uid, unnest([{{attr: 'priority', val: priority}}, {{attr: 'region', val: CAST(region AS INTEGER)}},
                      {{attr: 'segment', val: segment}}, {{attr: 'status', val: status}},
                      {{attr: 'vdecile', val: vdecile}}]) AS i
  FROM base),
basket AS (SELECT uid, list(i) AS held FROM item WHERE i.val IS NOT NULL GROUP BY uid),
-- how many uids hold each item, each pair in name order, and each such pair
-- together with the consequent's item
one AS (SELECT x, count(*) AS n FROM (SELECT unnest(held) AS x FROM basket) GROUP BY x),
two AS (
  SELECT x, y, count(*) AS n
  FROM (SELECT x, unnest(held) AS y FROM (SELECT held, unnest(held) AS x FROM basket))
  WHERE x.attr < y.attr GROUP BY x, y),
three AS (
  SELECT x, y, z, count(*) AS n
  FROM (SELECT x, y, unnest(held) AS z
        FROM (SELECT held, x, unnest(held) AS y FROM (SELECT held, unnest(held) AS x FROM basket)))
  WHERE x.attr < y.attr AND x.attr < z.attr AND y.attr <> z.attr AND z.attr = '@CONSEQUENT@'
  GROUP BY x, y, z),
rule_one AS (
  SELECT x, y, two.n, two.n / one.n AS conf FROM two JOIN one USING (x)
  WHERE y.attr = '@CONSEQUENT@' AND two.n >= @SUPP@ AND two.n / one.n >= @CONF@),
rule_two AS (
  SELECT x, y, z, three.n, three.n / two.n AS conf FROM three JOIN two USING (x, y)
  WHERE three.n >= @SUPP@ AND three.n / two.n >= @CONF@),
rule_protected AS (
  SELECT w.x, w.y, w.z, w.n, w.conf, w.conf / s.conf AS prot
  FROM rule_two w JOIN rule_one s ON w.x = s.x AND w.z = s.y
  WHERE w.y.attr = '@PROTECTED@' AND w.conf / s.conf >= @PROT@)
"""
for _mark, _value in (("@CONSEQUENT@", RULE_CONSEQUENT), ("@PROTECTED@", RULE_PROTECTED),
                      ("@SUPP@", RULE_SUPP), ("@CONF@", RULE_CONF), ("@PROT@", RULE_PROT)):
    _ITEMS_SQL = _ITEMS_SQL.replace(_mark, str(_value))

_PAIR_SQL = "x.attr AS attr1, x.val AS val1, y.attr AS attr2, y.val AS val2"
_TRIPLE_SQL = _PAIR_SQL + ", z.attr AS attr3, z.val AS val3"


def _rules_query(name: str, select_sql: str, build):
    @register(name, _ITEMS_SQL + select_sql)
    def q(spark, sf_dir):
        return build(_Levels(spark, sf_dir))
    q.__name__ = f"q_{name}"
    return q


class _Levels:
    """The levels a query needs, each computed once: the table of the items
    and the small frequent tables are checkpointed when a later level reads
    them again; the query's own result stays lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._read = lambda keep: order_items(spark, sf_dir, keep)
        self._items = None
        self._f1 = self._f2 = self._f3 = self._baskets = None

    @property
    def baskets(self) -> DataFrame:
        """The frequent items of every uid, grouped by one shuffle for the
        pairs and the triples."""
        if self._baskets is None:
            self._baskets = rules.grouped_baskets(self.items, self.f1(), RULE_CONSEQUENT)
        return self._baskets

    @property
    def items(self) -> DataFrame:
        """The long table, of rows materialised on first use by a level that is
        read again (a query that only counts items scans it once)."""
        if self._items is None:
            self._items = self._read(True)
        return self._items

    def f1(self, keep: bool = True):
        if self._f1 is None:
            if not keep:
                return rules.frequent_items(self._read(False), RULE_SUPP)
            f1 = rules.frequent_items(self.items, RULE_SUPP)
            if not keep:
                return f1
            self._f1 = materialize(f1)
        return self._f1

    def f2(self, keep: bool = True):
        if self._f2 is None:
            f2 = rules.frequent_pairs(self.items, self.f1(), RULE_SUPP, grouped=self.baskets)
            if not keep:
                return f2
            self._f2 = materialize(f2)
        return self._f2

    def f3(self, keep: bool = True):
        if self._f3 is None:
            f3 = rules.frequent_triples(self.items, self.f1(), None, RULE_SUPP, RULE_CONSEQUENT,
                                        grouped=self.baskets)
            if not keep:
                return f3
            self._f3 = materialize(f3)
        return self._f3


def _f1(lv):
    return lv.f1(keep=False)


def _f2(lv):
    return lv.f2(keep=False)


def _f3(lv):
    return lv.f3(keep=False)


def _r2(lv):
    return rules.rules2(lv.f1(), lv.f2(), RULE_CONF, RULE_CONSEQUENT)


def _r3(lv):
    return rules.rules3(lv.f2(), lv.f3(), RULE_CONF, RULE_CONSEQUENT)


def _pd(lv):
    return rules.protected_rules(_r2(lv), _r3(lv), RULE_PROT, RULE_PROTECTED)


_rules_query("freq_items", f"SELECT x.attr AS attr, x.val AS val, n AS supp FROM one WHERE n >= {RULE_SUPP}", _f1)
_rules_query("freq_pairs", f"SELECT {_PAIR_SQL}, n AS supp FROM two WHERE n >= {RULE_SUPP}", _f2)
_rules_query("freq_triples", 
             f"SELECT {_TRIPLE_SQL}, n AS supp FROM three WHERE n >= {RULE_SUPP}", _f3)
_rules_query("rules2", f"SELECT {_PAIR_SQL}, n AS supp, conf FROM rule_one", _r2)
_rules_query("rules3", f"SELECT {_TRIPLE_SQL}, n AS supp, conf FROM rule_two", _r3)
_rules_query("protected_rules",
             f"SELECT {_TRIPLE_SQL}, n AS supp, conf, prot FROM rule_protected", _pd)


# --------------------------------------------------------------------------
# P family: per-column profiling of string tables (customer and events)
# --------------------------------------------------------------------------

def _dec_text(c):
    return F.col(c).cast("decimal(12,2)").cast("string")


def profile_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The two profiled datasets as all-string tables.  ``error_code`` is
    empty except for errors; ``mixed`` holds int, real, date, text and empty
    cells in one column."""
    t = Tables(spark, sf_dir)
    customer = t.customer.select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        _dec_text("c_acctbal").alias("c_acctbal"), "c_mktsegment")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    user = F.col("user_id").cast("string")
    et = F.col("event_type")
    events = t.events.select(
        F.col("event_id").cast("string").alias("event_id"), ts.alias("ts"),
        user.alias("user_id"), "event_type", _dec_text("value").alias("value"), "props",
        F.when(et == "error", user).otherwise(F.lit("")).alias("error_code"),
        F.when(et == "view", user).when(et == "click", _dec_text("value"))
         .when(et == "purchase", ts).when(et == "signup", et)
         .otherwise(F.lit("")).alias("mixed"))
    return {"customer": customer, "events": events}


def profile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    tabs = profile_tables(spark, sf_dir)
    cells = None
    for name, df in tabs.items():
        m = prof.melt_cells(df, name)
        cells = m if cells is None else cells.unionByName(m)
    return cells


_DUCK_INT = r"\s*[+-]?\d+(?:_\d+)*\s*"
_DUCK_REAL = r"\s*[+-]?(?:\d+(?:_\d+)*\.(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?\s*"
_DUCK_DATE_FORMATS = ["%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d",
                      "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y"]
_DUCK_FMT_LIST = "[" + ", ".join(f"'{f}'" for f in _DUCK_DATE_FORMATS) + "]"

_CELLS_SQL = f"""
WITH cells AS (
  SELECT 'customer' AS dataset_name, column_name, value FROM (
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer)
  UNPIVOT INCLUDE NULLS (value FOR column_name IN (c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment))
  UNION ALL
  SELECT 'events' AS dataset_name, column_name, value FROM (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           CAST(user_id AS VARCHAR) AS user_id, event_type,
           CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value, props,
           CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) ELSE '' END AS error_code,
           CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR)
                WHEN event_type = 'click' THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
                WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                WHEN event_type = 'signup' THEN event_type ELSE '' END AS mixed
    FROM events)
  UNPIVOT INCLUDE NULLS (value FOR column_name IN (event_id, ts, user_id, event_type, value, props, error_code, mixed))
),
typed AS (
  SELECT dataset_name, column_name, coalesce(value, '') AS value,
         CASE WHEN value IS NULL OR value = '' THEN 'empty'
              WHEN regexp_full_match(value, '{_DUCK_INT}') THEN 'int'
              WHEN regexp_full_match(value, '{_DUCK_REAL}') THEN 'real'
              WHEN try_strptime(trim(value), {_DUCK_FMT_LIST}) IS NOT NULL THEN 'date'
              ELSE 'text' END AS cell_type,
         TRY_CAST(regexp_replace(value, '\\s|_', '', 'g') AS DOUBLE) AS num,
         try_strptime(trim(value), {_DUCK_FMT_LIST}) AS ts
  FROM cells)
"""


@register("unpivot_cells", _CELLS_SQL + """
SELECT dataset_name, column_name, value, cell_type FROM typed
""")
def q_unpivot_cells(spark, sf_dir):
    cells = prof.cell_table(profile_cells(spark, sf_dir))
    return cells.select("dataset_name", "column_name",
                        F.coalesce("value", F.lit("")).alias("value"), "cell_type")


@register("cell_types", _CELLS_SQL + """
SELECT dataset_name, column_name, cell_type, count(*) AS num
FROM typed GROUP BY ALL
""")
def q_cell_types(spark, sf_dir):
    return prof.type_counts(profile_cells(spark, sf_dir))


@register("profile_counts", _CELLS_SQL + """
SELECT dataset_name, column_name,
       count(*) FILTER (WHERE cell_type <> 'empty') AS number_non_empty_cells,
       count(*) FILTER (WHERE cell_type = 'empty') AS number_empty_cells,
       count(*) AS number_cells,
       count(DISTINCT value) AS number_distinct_values
FROM typed GROUP BY ALL
""")
def q_profile_counts(spark, sf_dir):
    return prof.column_counts(prof.value_frequencies(profile_cells(spark, sf_dir)))


@register("profile_top5", _CELLS_SQL + """
SELECT dataset_name, column_name, value, freq, rank FROM (
  SELECT dataset_name, column_name, value, freq,
         CAST(row_number() OVER (PARTITION BY dataset_name, column_name ORDER BY freq DESC, value) AS INTEGER) AS rank
  FROM (SELECT dataset_name, column_name, value, count(*) AS freq FROM typed GROUP BY ALL)
) WHERE rank <= 5
""")
def q_profile_top5(spark, sf_dir):
    return prof.frequent_values(prof.value_frequencies(profile_cells(spark, sf_dir)), 5)


@register("profile_numeric", _CELLS_SQL + """
, s AS (
  SELECT dataset_name, column_name, cell_type, count(*) AS count, max(num) AS max_value,
         min(num) AS min_value, avg(num) AS mean
  FROM typed WHERE cell_type IN ('int', 'real') GROUP BY ALL),
d AS (
  SELECT t.dataset_name, t.column_name, t.cell_type, sum((t.num - s.mean) * (t.num - s.mean)) AS ss
  FROM typed t JOIN s USING (dataset_name, column_name, cell_type) GROUP BY ALL)
SELECT dataset_name, column_name, cell_type, count, max_value, min_value,
       round(mean, 4) AS mean, round(sqrt(ss / count), 4) AS stddev,
       round(sqrt(ss), 4) AS root_sum_sq_dev
FROM s JOIN d USING (dataset_name, column_name, cell_type)
""")
def q_profile_numeric(spark, sf_dir):
    typed = prof.typed_frequencies(prof.value_frequencies(profile_cells(spark, sf_dir)))
    return prof.numeric_stats(typed).select(
        "dataset_name", "column_name", "cell_type", "count", "max_value", "min_value",
        F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
        F.round("root_sum_sq_dev", 4).alias("root_sum_sq_dev"))


@register("profile_long_ints", """
WITH cells AS (
  SELECT 'orders' AS dataset_name, 'o_serial' AS column_name,
         CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '' END || o_custkey
           || lpad(CAST(o_orderkey AS VARCHAR), 40, '0') AS value
  FROM orders),
n AS (
  SELECT *, value LIKE '-%' AS negative, length(value) AS len FROM cells)
SELECT dataset_name, column_name, count(*) AS count,
       first(value ORDER BY negative, CASE WHEN negative THEN len ELSE -len END,
             CASE WHEN negative THEN '' ELSE value END DESC, value) AS max_int,
       first(value ORDER BY NOT negative, CASE WHEN negative THEN -len ELSE len END,
             CASE WHEN negative THEN value ELSE '' END DESC, value) AS min_int
FROM n GROUP BY ALL
""")
def q_profile_long_ints(spark, sf_dir):
    """Integers of more than 40 digits keep their exact extremes."""
    serial = Tables(spark, sf_dir).orders.select(F.concat(
        F.when(F.col("o_orderstatus") == "F", "-").otherwise(""), F.col("o_custkey").cast("string"),
        F.lpad(F.col("o_orderkey").cast("string"), 40, "0")).alias("o_serial"))
    typed = prof.typed_frequencies(prof.value_frequencies(prof.melt_cells(serial, "orders")))
    return prof.numeric_stats(typed).select("dataset_name", "column_name", "count", "max_int", "min_int")


@register("profile_text", _CELLS_SQL + """
SELECT dataset_name, column_name, count(*) AS count,
       first(value ORDER BY length(value), value) AS shortest_value,
       first(value ORDER BY length(value) DESC, value) AS longest_value,
       round(avg(length(value)), 4) AS average_length
FROM typed WHERE cell_type = 'text' GROUP BY ALL
""")
def q_profile_text(spark, sf_dir):
    typed = prof.typed_frequencies(prof.value_frequencies(profile_cells(spark, sf_dir)))
    return prof.text_stats(typed).withColumn("average_length", F.round("average_length", 4))


@register("profile_dates", _CELLS_SQL + """
SELECT dataset_name, column_name, count(*) AS count,
       first(value ORDER BY ts DESC, value DESC) AS max_value,
       first(value ORDER BY ts, value) AS min_value
FROM typed WHERE cell_type = 'date' GROUP BY ALL
""")
def q_profile_dates(spark, sf_dir):
    typed = prof.typed_frequencies(prof.value_frequencies(profile_cells(spark, sf_dir)))
    return prof.date_stats(typed)


_TYPE_COUNTS_SQL = """
, tc AS (
  SELECT dataset_name, column_name, cell_type, count(*) AS n
  FROM typed WHERE cell_type <> 'empty' GROUP BY ALL),
cols AS (
  SELECT dataset_name, column_name,
         count(*) FILTER (WHERE cell_type = 'empty') AS e, count(*) AS n_all
  FROM typed GROUP BY ALL)
"""


@register("profile_summary", _CELLS_SQL + _TYPE_COUNTS_SQL + """
SELECT c.dataset_name, c.column_name,
       round(c.e / c.n_all, 6) AS sparsity,
       round(CASE WHEN count(tc.n) <= 1 THEN 1.0 ELSE max(tc.n) / sum(tc.n) END, 6) AS cleanliness,
       count(tc.n) AS n_types
FROM cols c LEFT JOIN tc USING (dataset_name, column_name)
GROUP BY c.dataset_name, c.column_name, c.e, c.n_all
""")
def q_profile_summary(spark, sf_dir):
    s = prof.profile_summary(prof.type_counts(profile_cells(spark, sf_dir)))
    return s.select("dataset_name", "column_name", F.round("sparsity", 6).alias("sparsity"),
                    F.round("cleanliness", 6).alias("cleanliness"),
                    F.col("n_types").cast("long").alias("n_types"))


@register("profile_type_totals", _CELLS_SQL + """
SELECT CASE cell_type WHEN 'int' THEN 'INTEGER (LONG)' WHEN 'real' THEN 'REAL'
                      WHEN 'date' THEN 'DATE/TIME' ELSE 'TEXT' END AS data_type,
       count(*) AS num
FROM typed WHERE cell_type <> 'empty' GROUP BY 1
""")
def q_profile_type_totals(spark, sf_dir):
    return prof.type_totals(prof.type_counts(profile_cells(spark, sf_dir)))


@register("profile_documents")
def q_profile_documents(spark, sf_dir):
    """Nested per-dataset documents (rows-only check; the flat pieces above
    are checked value by value)."""
    return prof.profile_documents(profile_cells(spark, sf_dir))




# --------------------------------------------------------------------------
# T family: semantic typing and scoring
# --------------------------------------------------------------------------

# (dataset, table, [(source column, kind, name given to the column)]).
# Column names are chosen so that every rule family of the rule table is
# exercised; 'flag' has no rule and is labelled with its own name.
SEMANTIC_COLUMNS = [
    ("pages", "pages", [("url", "s", "website"), ("page_id", "s", "house_number"),
                        ("html", "s", "prem_typ_desc")]),
    ("region", "region", [("r_name", "s", "city"), ("r_regionkey", "s", "borough")]),
    ("nation", "nation", [("n_name", "s", "neighborhood"), ("n_nationkey", "s", "zip")]),
    ("customer", "customer", [("c_name", "s", "business_name"), ("c_acctbal", "dec", "latitude"),
                              ("c_mktsegment", "s", "vehicle_type"), ("c_custkey", "s", "agency_id"),
                              ("c_nationkey", "s", "color")]),
    ("events", "events", [("props", "s", "location"), ("value", "dec", "longitude"),
                          ("event_type", "s", "school_level"), ("user_id", "s", "phone"),
                          ("ts", "ts", "address")]),
    ("conversations", "conversations", [("role", "s", "last_name"), ("text", "s", "street_name"),
                                        ("turn", "s", "subject")]),
    ("part", "part", [("p_name", "s", "park_name"), ("p_type", "s", "vehicle_make"),
                      ("p_brand", "s", "building_classification"), ("p_size", "s", "interest")]),
    ("supplier", "supplier", [("s_name", "s", "school_name")]),
    ("documents", "documents", [("text", "s", "address"), ("lang", "s", "city")]),
    ("lineitem", "lineitem", [("l_partkey", "s", "zip_code"), ("l_returnflag", "s", "flag")]),
]


def _spark_text(col: str, kind: str):
    if kind == "dec":
        return _dec_text(col)
    if kind == "ts":
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.col(col).cast("string")


def _sql_text(col: str, kind: str) -> str:
    if kind == "dec":
        return f"CAST(CAST({col} AS DECIMAL(12,2)) AS VARCHAR)"
    if kind == "ts":
        return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CAST({col} AS VARCHAR)"


def semantic_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the SEMANTIC_COLUMNS with its label, one job."""
    t = Tables(spark, sf_dir)
    out = None
    for ds, table, cols in SEMANTIC_COLUMNS:
        wide = getattr(t, table).select(*[_spark_text(c, k).alias(n) for c, k, n in cols])
        m = sem.label_wide(wide, ds)
        out = m if out is None else out.unionByName(m)
    return out


def _semantic_cells_sql() -> str:
    parts = []
    for ds, table, cols in SEMANTIC_COLUMNS:
        sel = ", ".join(f"{_sql_text(c, k)} AS {n}" for c, k, n in cols)
        names = ", ".join(n for _, _, n in cols)
        parts.append(f"SELECT '{ds}' AS dataset_name, column_name, value FROM (SELECT {sel} FROM {table}) "
                     f"UNPIVOT INCLUDE NULLS (value FOR column_name IN ({names}))")
    return "cells AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


_SEMANTIC_SQL = f"""
WITH {_semantic_cells_sql()},
labelled AS (
  SELECT dataset_name, column_name,
  {semantic_label_sql('column_name', 'value')} AS semantic_type
  FROM cells)
"""


@register("semantic_labels", _SEMANTIC_SQL + """
SELECT dataset_name, column_name, semantic_type, semantic_type AS label, count(*) AS count
FROM labelled GROUP BY ALL
""")
def q_semantic_labels(spark, sf_dir):
    return sem.count_labels(semantic_labelled(spark, sf_dir))


@register("semantic_documents")
def q_semantic_documents(spark, sf_dir):
    """Nested per-dataset documents (rows-only; values checked above)."""
    return sem.semantic_documents(sem.count_labels(semantic_labelled(spark, sf_dir)))


# Document rules used as a stand-in classifier for scoring: a document is
# predicted 'quality' when it has at least this many characters.
QUALITY_MIN_CHARS = 1000


def _doc_predictions(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.when(F.col("n_chars") >= QUALITY_MIN_CHARS, F.lit("quality"))
         .otherwise(F.lit("low_quality")).alias("label"))


def _doc_truth(t: Tables) -> DataFrame:
    q = t.labels.select("doc_id", F.when(F.col("quality") == 1, F.lit("quality"))
                        .otherwise(F.lit("low_quality")).alias("label"))
    tox = t.labels.filter(F.col("toxic") == 1).select("doc_id", F.lit("toxic").alias("label"))
    return q.unionByName(tox)


@register("label_scores", f"""
WITH p AS (
  SELECT DISTINCT CASE WHEN n_chars >= {QUALITY_MIN_CHARS} THEN 'quality' ELSE 'low_quality' END AS label,
         doc_id FROM documents),
t AS (
  SELECT DISTINCT label, doc_id FROM (
    SELECT CASE WHEN quality = 1 THEN 'quality' ELSE 'low_quality' END AS label, doc_id FROM labels
    UNION ALL SELECT 'toxic' AS label, doc_id FROM labels WHERE toxic = 1)),
nt AS (SELECT label, count(*) AS n_true FROM t GROUP BY label),
np AS (SELECT label, count(*) AS n_pred FROM p GROUP BY label),
hit AS (SELECT label, count(*) AS n_correct FROM p JOIN t USING (label, doc_id) GROUP BY label)
SELECT nt.label, coalesce(n_correct, 0) AS n_correct, n_pred, n_true,
       CASE WHEN n_pred IS NULL OR n_pred = 0 THEN NULL ELSE coalesce(n_correct, 0) / n_pred END AS precision,
       coalesce(n_correct, 0) / n_true AS recall
FROM nt LEFT JOIN np USING (label) LEFT JOIN hit USING (label)
""")
def q_label_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sem.score_labels(_doc_predictions(t), _doc_truth(t), ["doc_id"])


@register("clf_metrics", f"""
WITH d AS (
  SELECT CAST(quality AS DOUBLE) AS y,
         CASE WHEN n_chars >= {QUALITY_MIN_CHARS} THEN 1.0 ELSE 0.0 END AS p
  FROM labels JOIN documents USING (doc_id)),
conf AS (SELECT y, p, count(*) AS n FROM d GROUP BY y, p),
classes AS (SELECT y AS cls FROM conf UNION SELECT p FROM conf),
per AS (
  SELECT cls,
         coalesce((SELECT sum(n) FROM conf WHERE y = cls AND p = cls), 0) AS tp,
         coalesce((SELECT sum(n) FROM conf WHERE p = cls), 0) AS n_pred,
         coalesce((SELECT sum(n) FROM conf WHERE y = cls), 0) AS support
  FROM classes),
m AS (
  SELECT *, CASE WHEN n_pred = 0 THEN NULL ELSE tp / n_pred END AS precision,
            CASE WHEN support = 0 THEN NULL ELSE tp / support END AS recall
  FROM per),
f AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN NULL ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM m)
SELECT cls AS label, CAST(tp AS BIGINT) AS tp, CAST(n_pred AS BIGINT) AS n_pred,
       CAST(support AS BIGINT) AS support, precision, recall, f1,
       sum(tp) OVER () / sum(support) OVER () AS accuracy,
       sum(coalesce(f1, 0) * support) OVER () / sum(support) OVER () AS weighted_f1
FROM f
""")
def q_clf_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = (t.labels.join(t.documents, "doc_id")
         .select(F.col("quality").cast("double").alias("label"),
                 F.when(F.col("n_chars") >= QUALITY_MIN_CHARS, 1.0).otherwise(0.0).alias("prediction")))
    return sem.classification_metrics(d)




# --------------------------------------------------------------------------
# M family: text classification, explanations, feature clean-up
# (model fitting is iterative: rows-only checks, brute-force tests in tests/)
# --------------------------------------------------------------------------

EXPLAIN_FEATURES = 6
EXPLAIN_SAMPLES = 5000
CORRECTED_MIN_CONF = 0.1
CLEANUP_WORDS = 8


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return (t.documents.join(t.labels, "doc_id")
            .select(F.when(F.col("quality") == 1, F.lit("quality"))
                     .otherwise(F.lit("low_quality")).alias("category"),
                    "text", F.col("doc_id").alias("id")))


def _fit_predict(spark, sf_dir):
    train, test = textml.split_train_test(labelled_documents(spark, sf_dir))
    model = textml.fit(train)
    return train, test, model, textml.predict(model, test)


@register("text_classifier")
def q_text_classifier(spark, sf_dir):
    _, _, _, pred = _fit_predict(spark, sf_dir)
    return pred.select("id", "category", "label", "prediction", "conf")


def _explanations(spark, sf_dir):
    train, test, model, pred = _fit_predict(spark, sf_dir)
    # scored once; every consumer reads the written predictions
    pred = materialize(pred.select("id", "text", "category", "label", "prediction", "conf"))
    wrong = textml.misclassified(pred).select("id", "text", "conf")
    exp = textml.explain(model, wrong.select("id", "text"), EXPLAIN_FEATURES, EXPLAIN_SAMPLES)
    return train, test, model, pred, exp.join(wrong.select("id", "conf"), "id")


@register("explain_words")
def q_explain_words(spark, sf_dir):
    return _explanations(spark, sf_dir)[4].select("id", "conf", "rank", "word", "weight")


@register("word_weights")
def q_word_weights(spark, sf_dir):
    return textml.word_weights(_explanations(spark, sf_dir)[4])


@register("clean_and_refit")
def q_clean_and_refit(spark, sf_dir):
    """Remove the words that explanations name most often from the training
    texts, refit, and compare.  The word list is a top-k report (k words),
    the only thing brought to the driver."""
    train, test, _, pred, exp = _explanations(spark, sf_dir)
    top = (textml.word_weights(exp)
           .orderBy(F.col("frequency").desc(), F.col("weight").desc(), F.col("word"))
           .limit(CLEANUP_WORDS).collect())
    words = [r.word for r in top]
    _, new_pred = textml.clean_and_refit(train, test, words)
    # scored once, as the first predictions are
    new_pred = materialize(new_pred.select("id", "label", "prediction"))
    def metrics(p: DataFrame, name: str) -> DataFrame:
        right = (F.col("label") == F.col("prediction")).cast("double")
        m = p.agg(F.avg(right).alias("accuracy"),
                  F.sum(1.0 - right).alias("n_errors"))
        return m.unpivot([], ["accuracy", "n_errors"], "metric", "value").withColumn(
            "model", F.lit(name))
    fixed = (textml.corrected(pred, new_pred, CORRECTED_MIN_CONF)
             .agg(F.count(F.lit(1)).cast("double").alias("value"))
             .select(F.lit("n_corrected").alias("metric"), "value", F.lit("after").alias("model")))
    return (metrics(pred, "before").unionByName(metrics(new_pred, "after")).unionByName(fixed)
            .withColumn("removed_words", F.lit(",".join(words))))


# Words removed by the registered query (common in the driver's prose).
QUERY_REMOVED_WORDS = ("the", "and", "des", "und", "que")


@register("remove_words", "SELECT doc_id, " + "".join("replace(" for _ in QUERY_REMOVED_WORDS)
          + "text" + "".join(f", '{w}', '')" for w in QUERY_REMOVED_WORDS)
          + " AS text, CAST(length(" + "".join("replace(" for _ in QUERY_REMOVED_WORDS)
          + "text" + "".join(f", '{w}', '')" for w in QUERY_REMOVED_WORDS)
          + ") AS INTEGER) AS n_chars_clean FROM documents")
def q_remove_words(spark, sf_dir):
    clean = remove_substrings(F.col("text"), QUERY_REMOVED_WORDS)
    return Tables(spark, sf_dir).documents.select(
        "doc_id", clean.alias("text"), F.length(clean).alias("n_chars_clean"))




# --------------------------------------------------------------------------
# Fuzzy name resolution.  Stand-in on the driver tables: within each
# nation (the "dataset"), the whole name of every customer (the "given name")
# is resolved to the closest market segment of that nation (its "headers",
# ordered by the first customer that has it).
# --------------------------------------------------------------------------

def _customer_names(t: Tables) -> DataFrame:
    return t.customer.select("c_nationkey", F.col("c_name").alias("given_name"))


def _nation_segments(t: Tables) -> DataFrame:
    return (t.customer.groupBy("c_nationkey", F.col("c_mktsegment").alias("column_name"))
            .agg(F.min("c_custkey").alias("position")))


_LCS_SQL = """CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0 ELSE
 list_reduce(range(1, length(a) + 1), lambda prev, i:
   list_reduce(range(1, length(b) + 1), lambda cur, j:
     list_concat(cur, [CASE WHEN substr(a, i, 1) = substr(b, j, 1) THEN prev[j] + 1
                            ELSE greatest(prev[j + 1], cur[j]) END]), [0]),
   list_transform(range(0, length(b) + 1), lambda x: 0))[length(b) + 1] END"""


@register("fuzzy_column", f"""
WITH t AS (SELECT DISTINCT c_nationkey, c_name AS given_name FROM customer),
c AS (SELECT c_nationkey, c_mktsegment AS column_name, min(c_custkey) AS position
      FROM customer GROUP BY 1, 2),
p AS (
  SELECT t.c_nationkey, t.given_name, c.column_name, c.position,
         length(t.given_name) + length(c.column_name) - 2 * (
           SELECT {_LCS_SQL} FROM (SELECT t.given_name AS a, c.column_name AS b)) AS distance
  FROM t JOIN c USING (c_nationkey))
SELECT c_nationkey, given_name, column_name AS resolved_name, CAST(distance AS INTEGER) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey, given_name ORDER BY distance, position) AS rn
  FROM p) WHERE rn = 1
""")
def q_fuzzy_column(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return resolve.resolve_names(_customer_names(t), _nation_segments(t), ["c_nationkey"])


# --------------------------------------------------------------------------
# Variants checked against SQL as well
# --------------------------------------------------------------------------

@register("row_index", """
SELECT o_orderkey, o_totalprice,
       row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS id
FROM orders
""")
def q_row_index(spark, sf_dir):
    """Reproducible 0-based row index over a declared total order."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return rel.row_index(orders, ["o_totalprice", "o_orderkey"])


@register("rules2_rounded", _ITEMS_SQL + f"""
SELECT {_PAIR_SQL}, two.n AS supp, round(two.n / one.n, 2) AS conf
FROM two JOIN one USING (x)
WHERE y.attr = '{RULE_CONSEQUENT}' AND two.n >= {RULE_SUPP}
  AND round(two.n / one.n, 2) >= {RULE_CONF_ROUNDED}
""")
def q_rules2_rounded(spark, sf_dir):
    """Rule variant: the confidence is rounded to 2 decimals."""
    lv = _Levels(spark, sf_dir)
    return rules.rules2(lv.f1(), lv.f2(), RULE_CONF_ROUNDED, RULE_CONSEQUENT, conf_decimals=2)


# Rule drafts without a condition on the order of names: the consequent is
# an attribute in the middle, so items on both sides of it stand on the left.
MIDDLE_CONSEQUENT = "segment"
CONSEQUENT_VALUES = (1, 3)
LOOSE_PROT = 1.0

_ANY_SQL = _ITEMS_SQL[:_ITEMS_SQL.index("-- how many uids")] + f"""
pair AS (SELECT uid, x, y FROM (SELECT uid, x, unnest(held) AS y
           FROM (SELECT uid, held, unnest(held) AS x FROM basket)) WHERE x.attr <> y.attr),
n1 AS (SELECT i AS x, count(DISTINCT uid) AS n FROM item WHERE i.val IS NOT NULL GROUP BY i),
n2 AS (SELECT x, y, count(*) AS n FROM pair GROUP BY x, y),
n3 AS (SELECT p.x, p.y, q.y AS z, count(*) AS n FROM pair p JOIN pair q ON p.uid = q.uid AND p.x = q.x
       WHERE p.y.attr <> q.y.attr AND q.y.attr = '{MIDDLE_CONSEQUENT}' AND p.x.attr < p.y.attr
       GROUP BY p.x, p.y, q.y),
left_one AS (
  SELECT x, y, n2.n, n2.n / n1.n AS conf FROM n2 JOIN n1 USING (x)
  WHERE y.attr = '{MIDDLE_CONSEQUENT}' AND n2.n >= {RULE_SUPP} AND n2.n / n1.n >= {RULE_CONF}),
left_two AS (
  SELECT x, y, z, n3.n, n3.n / n2.n AS conf FROM n3 JOIN n2 USING (x, y)
  WHERE n3.n >= {RULE_SUPP} AND n3.n / n2.n >= {RULE_CONF})
"""


def _any_levels(spark, sf_dir):
    return rules.mine_rules(order_items(spark, sf_dir, keep=True), RULE_SUPP, RULE_CONF, RULE_PROT,
                            MIDDLE_CONSEQUENT, RULE_PROTECTED, any_position=True, keep_items=False)


@register("rules2_any_position", _ANY_SQL + f"SELECT {_PAIR_SQL}, n AS supp, conf FROM left_one")
def q_rules2_any_position(spark, sf_dir):
    """V2: left items before and after the consequent."""
    return _any_levels(spark, sf_dir).r2


@register("rules3_any_position", _ANY_SQL + f"SELECT {_TRIPLE_SQL}, n AS supp, conf FROM left_two")
def q_rules3_any_position(spark, sf_dir):
    return _any_levels(spark, sf_dir).r3


@register("protected_any_position", _ANY_SQL + f"""
SELECT DISTINCT {_TRIPLE_SQL.replace('x.', 'w.x.').replace('y.', 'w.y.').replace('z.', 'w.z.')},
       w.n AS supp, w.conf AS conf, w.conf / s.conf AS prot
FROM left_two w JOIN left_one s ON s.y = w.z AND s.x = CASE WHEN w.x.attr = '{RULE_PROTECTED}' THEN w.y
                                                            WHEN w.y.attr = '{RULE_PROTECTED}' THEN w.x END
WHERE w.conf / s.conf >= {RULE_PROT}
""")
def q_protected_any_position(spark, sf_dir):
    """The protected attribute as either left item."""
    return _any_levels(spark, sf_dir).pd_r3


@register("rules2_values", _ANY_SQL + f"""
SELECT {_PAIR_SQL}, n AS supp, conf FROM left_one
WHERE y.val IN {CONSEQUENT_VALUES} AND conf > {RULE_CONF}
""")
def q_rules2_values(spark, sf_dir):
    """V5: only some values of the consequent, thresholds exceeded."""
    lv = _any_levels(spark, sf_dir)
    return rules.rules2(lv.f1, lv.f2, RULE_CONF, MIDDLE_CONSEQUENT, strict=True,
                        consequent_values=CONSEQUENT_VALUES)


@register("protected_loose", _ITEMS_SQL + f"""
SELECT DISTINCT w.x.attr AS attr1, w.x.val AS val1, w.y.attr AS attr2, w.y.val AS val2,
       w.z.attr AS attr3, w.z.val AS val3, w.n AS supp, w.conf AS conf,
       round(w.conf / s.conf, 2) AS prot
FROM rule_two w JOIN rule_one s ON w.x.attr = s.x.attr AND w.x.val = s.x.val AND w.z.attr = s.y.attr
WHERE w.y.attr = '{RULE_PROTECTED}' AND round(w.conf / s.conf, 2) > {LOOSE_PROT}
""")
def q_protected_loose(spark, sf_dir):
    """V3, V4: the base rule may have another value of the consequent; the
    ratio is rounded, exceeded, and each row returned once."""
    lv = _Levels(spark, sf_dir)
    return rules.protected_rules(_r2(lv), _r3(lv), LOOSE_PROT, RULE_PROTECTED,
                                 match_consequent_value=False, strict=True, prot_decimals=2)


_DRAFT_COLUMNS = [("customer", "customer", [("c_name", "s", "business"), ("c_custkey", "s", "zip")]),
                  ("conversations", "conversations", [("role", "s", "first_name")]),
                  ("lineitem", "lineitem", [("l_partkey", "s", "zipcode")])]


def _draft_cells_sql() -> str:
    parts = []
    for ds, table, cols in _DRAFT_COLUMNS:
        sel = ", ".join(f"{_sql_text(c, k)} AS {n}" for c, k, n in cols)
        names = ", ".join(n for _, _, n in cols)
        parts.append(f"SELECT '{ds}' AS dataset_name, column_name, value FROM (SELECT {sel} FROM {table}) "
                     f"UNPIVOT INCLUDE NULLS (value FOR column_name IN ({names}))")
    return "cells AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


@register("semantic_draft_labels", f"""
WITH {_draft_cells_sql()},
labelled AS (
  SELECT dataset_name, column_name,
  {semantic_label_sql('column_name', 'value', draft_rule_table())} AS semantic_type
  FROM cells)
SELECT dataset_name, column_name, semantic_type, semantic_type AS label, count(*) AS count
FROM labelled GROUP BY ALL
""")
def q_semantic_draft_labels(spark, sf_dir):
    """T5: the drafts' reduced rule table (name rules first, NY zip codes)."""
    t = Tables(spark, sf_dir)
    out = None
    for ds, table, cols in _DRAFT_COLUMNS:
        wide = getattr(t, table).select(*[_spark_text(c, k).alias(n) for c, k, n in cols])
        m = sem.label_wide(wide, ds, rules=draft_rule_table())
        out = m if out is None else out.unionByName(m)
    return sem.count_labels(out)




_NAME_DATE_SQL = " OR ".join(f"contains(lower(column_name), '{w}')"
                             for w in ("date", "year", "time", "month", "day", "period"))


@register("cell_types_by_name", f"""
WITH cells AS (
  SELECT 'orders' AS dataset_name, column_name, value FROM (
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderpriority AS order_period,
           o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer_day
    FROM orders)
  UNPIVOT INCLUDE NULLS (value FOR column_name IN (order_date, order_period, status, customer_day))),
typed AS (
  SELECT dataset_name, column_name,
         CASE WHEN value IS NULL OR value = '' THEN 'empty'
              WHEN {_NAME_DATE_SQL} THEN 'date'
              WHEN regexp_full_match(value, '{_DUCK_INT}') THEN 'int'
              WHEN regexp_full_match(value, '{_DUCK_REAL}') THEN 'real'
              WHEN try_strptime(trim(value), {_DUCK_FMT_LIST}) IS NOT NULL THEN 'date'
              ELSE 'text' END AS cell_type
  FROM cells)
SELECT dataset_name, column_name, cell_type, count(*) AS num FROM typed GROUP BY ALL
""")
def q_cell_types_by_name(spark, sf_dir):
    """The draft rule that types non-numeric cells of date-named
    columns as dates."""
    o = Tables(spark, sf_dir).orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderpriority").alias("order_period"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").cast("string").alias("customer_day"))
    typed = prof.typed_frequencies(prof.value_frequencies(prof.melt_cells(o, "orders")),
                                   date_by_name=True)
    return (typed.groupBy("dataset_name", "column_name", "cell_type")
                 .agg(F.sum("freq").cast("long").alias("num")))




def _semantic_wide(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = Tables(spark, sf_dir)
    return {ds: getattr(t, table).select(*[_spark_text(c, k).alias(n) for c, k, n in cols])
            for ds, table, cols in SEMANTIC_COLUMNS}


_HEADER_ROWS = ", ".join(f"('{ds}', '{n}', {i})" for ds, _, cols in SEMANTIC_COLUMNS
                         for i, (_, _, n) in enumerate(cols))


@register("semantic_targets", f"""
WITH {_semantic_cells_sql()},
headers AS (SELECT * FROM (VALUES {_HEADER_ROWS}) AS h(dataset_name, column_name, position)),
targets AS (SELECT DISTINCT dataset_name, replace(column_name, '_', ' ') AS given_name FROM headers),
pairs AS (
  SELECT t.dataset_name, t.given_name, h.column_name, h.position,
         length(t.given_name) + length(h.column_name) - 2 * (
           SELECT {_LCS_SQL} FROM (SELECT t.given_name AS a, h.column_name AS b)) AS distance
  FROM targets t JOIN headers h USING (dataset_name)),
chosen AS (
  SELECT DISTINCT dataset_name, column_name FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset_name, given_name ORDER BY distance, position) AS rn
    FROM pairs) WHERE rn = 1),
labelled AS (
  SELECT dataset_name, column_name,
  {semantic_label_sql('column_name', 'value')} AS semantic_type
  FROM cells WHERE (dataset_name, column_name) IN (SELECT dataset_name, column_name FROM chosen))
SELECT dataset_name, column_name, semantic_type, semantic_type AS label, count(*) AS count
FROM labelled GROUP BY ALL
""")
def q_semantic_targets(spark, sf_dir):
    """Given names (headers with spaces for underscores) resolved to
    the closest header of their dataset, then only those columns labelled."""
    frames = _semantic_wide(spark, sf_dir)
    targets = sem.header_table(spark, frames).select(
        "dataset_name", F.regexp_replace("column_name", "_", " ").alias("given_name"))
    return sem.label_target_frames(spark, frames, targets)


FLAGSHIP = "profile_documents"

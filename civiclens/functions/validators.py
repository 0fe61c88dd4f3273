"""Semantic-type rules: a column-name predicate chooses a validator, the
validator labels each non-empty cell.

Validators are Catalyst expressions (no Python per row).  The reference
used Python ``re.match`` (prefix match, Unicode classes, ``$`` also before
a final newline); the Java patterns below are anchored with ``^`` and use
``(?U)`` for Unicode classes and ``(?d)`` so that only ``\\n`` ends a line.

Every rule also carries an RE2/DuckDB spelling for the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Street keywords.  The reference's list lacks two commas, which glues
# 'place'+'route' and 'passage'+'row'; STREET_WORDS_AS_WRITTEN keeps that
# spelling for strict reproduction, STREET_WORDS is the intended list.
STREET_WORDS = (
    "street", "avenue", "boulevard", "road", "roadway", "court", "highway", "lane",
    "pavement", "place", "route", "thoroughfare", "track", "trail", "artery", "byway",
    "drag", "drive", "parkway", "passage", "row", "stroll", "terrace", "turf", "trace",
    "turnpike", "way",
)
STREET_WORDS_AS_WRITTEN = (
    "street", "avenue", "boulevard", "road", "roadway", "court", "highway", "lane",
    "pavement", "placeroute", "thoroughfare", "track", "trail", "artery", "byway",
    "drag", "drive", "parkway", "passagerow", "stroll", "terrace", "turf", "trace",
    "turnpike", "way",
)
SCHOOL_WORDS = ("university", "school", "institute", "academy", "college")
SCHOOL_LEVEL_WORDS = ("elementary", "middle", "high", "yabc", "k")
SUBJECT_WORDS = ("social studies", "mathematics", "math", "english", "science")
# Borough names and codes, lower-cased (the reference compared a lower-cased
# value with upper-case codes M, X, R, K, Q, which could never match).
BOROUGH_VALUES = (
    "bronx", "brooklyn", "manhattan", "queens", "staten island", "1", "2", "3", "4", "5",
    "mn", "bx", "bk", "qn", "si", "m", "x", "r", "k", "q",
)
# City agency abbreviations, case-sensitive, in the reference's order.
AGENCY_VALUES = (
    "NYCOA", "AJC", "OATH", "DFTA", "MOA", "BPL", "DOB", "BIC", "CFB", "CIDI", "OCME",
    "ACS", "CLERK", "DCP", "CUNY", "DCAS", "CECM", "CEC", "CSC", "CCRB", "CGE", "CCPC", "CAU",
    "CB", "COMP", "COIB", "DCA", "DCWP", "MOCS", "BOC", "DOC", "DCLA", "MODA", "DDC", "Brooklyn",
    "Manhattan", "DOE", "BOE", "MOEC", "DEP", "EEPC", "DOF", "FDNY", "GNYC", "DOHMH", "DHS", "NYCHA",
    "HPD", "HRO", "HRA", "CCHR", "MOIA", "IBO", "MOIP", "DOITT", "MOIGA", "DOI", "MACJ", "OLR", "LPC",
    "LAW", "BPL", "NYPL", "QL", "LOFT", "OMB", "MCCM", "OM", "IA", "MOPD", "OER", "MOSPCE", "OMWBE",
    "OSP", "ENDGBV", "MOME", "NYCGO", "NYCEDC", "NYCERS", "SERVICE", "TFA", "NYPL", "OPS", "DPR",
    "OPA", "NYPD", "PPF", "DOP", "PPB", "BCPA", "KCPA", "NYCountyPA", "QPA", "RCPA", "QPL", "DORIS",
    "RGB", "STAR", "DSNY", "SCA", "SBS", "DSS", "OSE", "SNP", "BSA", "TAT", "TC", "TLC", "DOT", "DVS",
    "NYWB", "NYW", "DYCD", "311", "NYCEM",
)

# Python float() grammar restricted to finite decimal forms (nan/inf are
# never inside a coordinate range anyway).
_D = r"\d+(?:_\d+)*"
PY_FLOAT = rf"^\s*[+-]?(?:(?:{_D})?\.{_D}|{_D}\.?)(?:[eE][+-]?{_D})?\s*$"


# ---------------------------------------------------------------------------
# Validator kinds: each renders to a Spark Column and to DuckDB SQL
# ---------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _float_in(v: Column, lo: float, hi: float) -> Column:
    num = F.regexp_replace(v, r"(?U)\s|_", "").try_cast("double")
    return v.rlike("(?U)" + PY_FLOAT) & num.between(lo, hi)


def _sql_float_in(v: str, lo: float, hi: float) -> str:
    num = f"TRY_CAST(regexp_replace({v}, '\\s|_', '', 'g') AS DOUBLE)"
    return f"(regexp_matches({v}, {_sql_str(PY_FLOAT)}) AND {num} BETWEEN {lo} AND {hi})"


@dataclass(frozen=True)
class Validator:
    kind: str
    args: tuple = ()

    def spark(self, v: Column) -> Column:
        k, a = self.kind, self.args
        if k == "len":
            return F.length(v) >= a[0]
        if k == "contains":
            low = F.lower(v)
            cond = None
            for w in a[0]:
                c = low.contains(w)
                cond = c if cond is None else cond | c
            if len(a) > 1:  # "or at least n characters"
                cond = cond | (F.length(v) >= a[1])
            return cond
        if k == "regex":
            return v.rlike(a[0])
        if k == "in_lower":
            return F.lower(v).isin(list(a[0]))
        if k == "float_range":
            return _float_in(v, a[0], a[1])
        if k == "two_coords":
            found = F.regexp_extract_all(v, F.lit(r"(?dU)-?\d+.\d+"), 0)
            return ((F.size(found) == 2)
                    & _float_in(F.element_at(found, 1), -90, 90)
                    & _float_in(F.element_at(found, 2), -180, 180))
        if k == "agency":
            return v.isin(list(AGENCY_VALUES)) | v.rlike(r"(?U)^\d+\z") | (F.length(v) >= 10)
        raise ValueError(k)

    def sql(self, v: str) -> str:
        k, a = self.kind, self.args
        if k == "len":
            return f"length({v}) >= {a[0]}"
        if k == "contains":
            parts = [f"contains(lower({v}), {_sql_str(w)})" for w in a[0]]
            if len(a) > 1:
                parts.append(f"length({v}) >= {a[1]}")
            return "(" + " OR ".join(parts) + ")"
        if k == "regex":
            return f"regexp_matches({v}, {_sql_str(a[1])})"
        if k == "in_lower":
            return f"lower({v}) IN (" + ", ".join(_sql_str(x) for x in a[0]) + ")"
        if k == "float_range":
            return _sql_float_in(v, a[0], a[1])
        if k == "two_coords":
            found = f"regexp_extract_all({v}, '-?\\d+.\\d+')"
            return (f"(len({found}) = 2 AND {_sql_float_in(f'{found}[1]', -90, 90)}"
                    f" AND {_sql_float_in(f'{found}[2]', -180, 180)})")
        if k == "agency":
            return (f"({v} IN (" + ", ".join(_sql_str(x) for x in AGENCY_VALUES) + ")"
                    f" OR regexp_matches({v}, '^\\d+$') OR length({v}) >= 10)")
        raise ValueError(k)


@dataclass(frozen=True)
class Rule:
    label: str
    name_any: tuple  # alternatives; each a tuple of substrings that must all occur
    validator: Validator = field(default=Validator("len", (1,)))

    def name_spark(self, lname: Column) -> Column:
        cond = None
        for group in self.name_any:
            g = None
            for w in group:
                c = lname.contains(w)
                g = c if g is None else g & c
            cond = g if cond is None else cond | g
        return cond

    def name_matches(self, name: str) -> bool:
        low = name.lower()
        return any(all(w in low for w in group) for group in self.name_any)

    def name_sql(self, lname: str) -> str:
        alts = ["(" + " AND ".join(f"contains({lname}, {_sql_str(w)})" for w in g) + ")"
                for g in self.name_any]
        return "(" + " OR ".join(alts) + ")"


def _re(java: str, re2: str) -> Validator:
    return Validator("regex", (java, re2))


_FIRST_NON_DIGIT = _re(r"(?U)^\D", r"^\D")


def rule_table(strict_reference: bool = False) -> list[Rule]:
    """Ordered rules; the first whose name predicate holds is used."""
    street = STREET_WORDS_AS_WRITTEN if strict_reference else STREET_WORDS
    return [
        Rule("person_name", (("name", "first"), ("name", "last"), ("name", "family"),
                             ("name", "middle")),
             _re(r"(?dU)^[a-zA-Z]+,?\s*?[a-zA-Z]*$", r"^[a-zA-Z]+,?\s*?[a-zA-Z]*$")),
        Rule("business_name", (("name", "business"),), Validator("len", (2,))),
        Rule("street_name", (("name", "street"),), Validator("contains", (street,))),
        Rule("school_name", (("name", "school"),), Validator("contains", (SCHOOL_WORDS,))),
        Rule("park_playground", (("park",),), Validator("len", (4,))),
        Rule("school_level", (("school", "level"), ("school", "type")),
             Validator("contains", (SCHOOL_LEVEL_WORDS,))),
        Rule("subject_in_school", (("subject",),), Validator("contains", (SUBJECT_WORDS, 3))),
        Rule("area_of_study", (("interest",),), Validator("len", (4,))),
        Rule("city_agency", (("agency",),), Validator("agency")),
        Rule("house_number", (("house", "number"),), _re(r"(?U)^\w", r"^\w")),
        Rule("location_type", (("prem_typ_desc",),), _FIRST_NON_DIGIT),
        Rule("phone_number", (("phone",), ("phone number",), ("tel",)),
             _re(r"(?U)^\(?\d{3}[-.)] ?\d{3}[-.]\d{4}", r"^\(?\d{3}[-.)] ?\d{3}[-.]\d{4}")),
        # Same language as the reference's URL pattern; the label part is
        # written without nested optional repeats, which backtrack
        # exponentially in Java on long non-matching strings.
        Rule("website", (("website",), ("web",), ("url",)),
             _re(r"(?dU)^(?:https?://)?(?:www\.)?(?:[a-zA-Z0-9]++(?:-[a-zA-Z0-9]++)*+\.)+\w{2,}(?:/\S*)?$",
                 r"^(https?://)?(www\.)?([a-zA-Z0-9]+(-?[a-zA-Z0-9])*\.)+\w{2,}(/\S*)?$")),
        Rule("lat_coordinates", (("latitude",),), Validator("float_range", (-90, 90))),
        Rule("lon_coordinates", (("longitude",),), Validator("float_range", (-180, 180))),
        Rule("lat_lon_cord", (("location",), ("lat_lon",)), Validator("two_coords")),
        Rule("zip_code", (("zip",), ("zipcode",), ("zip code",), ("zip_code",)),
             _re(r"(?U)^\s*\d{5}", r"^\s*\d{5}")),
        Rule("borough", (("borough",),), Validator("in_lower", (BOROUGH_VALUES,))),
        Rule("city", (("city",),), _re(r"^\p{L}+\z", r"^\pL+$")),
        Rule("neighborhood", (("neighborhood",),), _re(r"^[a-zA-Z]", r"^[a-zA-Z]")),
        Rule("address", (("address",),), _re(r"(?dU)^[^\n]*\d{5}", r"^[^\n]*\d{5}")),
        Rule("building_classification", (("building", "classification"),), Validator("len", (2,))),
        Rule("color", (("color",),), _FIRST_NON_DIGIT),
        Rule("car_make", (("vehicle", "make"),), _FIRST_NON_DIGIT),
        Rule("vehicle_type", (("vehicle", "type"),), Validator("len", (2,))),
    ]


def draft_rule_table() -> list[Rule]:
    """The reduced rule table of the reference's drafts: name rules first,
    a stricter person-name pattern, New York zip codes (5 digits starting
    with 1), and business/school names accepted when non-empty."""
    return [
        Rule("person_name", (("name", "first"), ("name", "last"), ("name", "family"),
                             ("name", "middle")),
             _re(r"(?dU)^[a-zA-Z]+,? ?[a-zA-Z]*$", r"^[a-zA-Z]+,? ?[a-zA-Z]*$")),
        Rule("business_name", (("business",),), Validator("len", (1,))),
        Rule("school_name", (("school",),), Validator("len", (1,))),
        Rule("ny_zipcode", (("zip",),), _re(r"^1\d{4}$", r"^1\d{4}$")),
    ] + [r for r in rule_table() if r.label not in
         ("person_name", "business_name", "school_name", "zip_code")]


NULL_LABEL, OTHER_LABEL = "NULL", "Other"


def semantic_label(name: Column, value: Column, rules: Sequence[Rule] | None = None) -> Column:
    """Label of one cell: 'NULL' when empty, the column name when no rule
    applies, the rule's label when its validator passes, else 'Other'.

    With a literal ``name`` Catalyst folds the name predicates, leaving only
    the chosen validator in the generated code.
    """
    rules = rule_table() if rules is None else rules
    lname = F.lower(name)
    expr = F.when(value.isNull() | (value == ""), F.lit(NULL_LABEL))
    for r in rules:
        expr = expr.when(r.name_spark(lname),
                         F.when(r.validator.spark(value), F.lit(r.label)).otherwise(F.lit(OTHER_LABEL)))
    return expr.otherwise(name)


def choose_rule(name: str, rules: Sequence[Rule] | None = None) -> Rule | None:
    """The rule for a known column name (first match), or None."""
    rules = rule_table() if rules is None else rules
    return next((r for r in rules if r.name_matches(name)), None)


def column_label(name: str, value: Column, rules: Sequence[Rule] | None = None) -> Column:
    """:func:`semantic_label` for a column whose name is known when the plan
    is built: the rule is chosen here, once, and only its validator runs."""
    rule = choose_rule(name, rules)
    expr = F.when(value.isNull() | (value == ""), F.lit(NULL_LABEL))
    if rule is None:
        return expr.otherwise(F.lit(name))
    return expr.when(rule.validator.spark(value), F.lit(rule.label)).otherwise(F.lit(OTHER_LABEL))


def rule_index(name: Column, rules: Sequence[Rule] | None = None) -> Column:
    """Index of the first rule whose name predicate holds (NULL: none)."""
    rules = rule_table() if rules is None else rules
    lname = F.lower(name)
    expr = None
    for i, r in enumerate(rules):
        cond = r.name_spark(lname)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def label_by_rule(name: Column, value: Column, rule: Column,
                  rules: Sequence[Rule] | None = None) -> Column:
    """:func:`semantic_label` when the rule index of the column is already
    known (see :func:`rule_index`): per cell only the chosen validator runs."""
    rules = rule_table() if rules is None else rules
    expr = F.when(value.isNull() | (value == ""), F.lit(NULL_LABEL)).when(rule.isNull(), name)
    for i, r in enumerate(rules):
        expr = expr.when(rule == i, F.when(r.validator.spark(value), F.lit(r.label))
                         .otherwise(F.lit(OTHER_LABEL)))
    return expr


def semantic_label_sql(name: str, value: str, rules: Sequence[Rule] | None = None) -> str:
    """DuckDB spelling of :func:`semantic_label` (for the SQL oracle)."""
    rules = rule_table() if rules is None else rules
    lname = f"lower({name})"
    parts = [f"CASE WHEN {value} IS NULL OR {value} = '' THEN 'NULL'"]
    for r in rules:
        parts.append(f"WHEN {r.name_sql(lname)} THEN CASE WHEN {r.validator.sql(value)} "
                     f"THEN {_sql_str(r.label)} ELSE 'Other' END")
    parts.append(f"ELSE {name} END")
    return "\n  ".join(parts)

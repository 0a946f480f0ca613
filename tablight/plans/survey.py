"""The fraud-survey cleaning spec and a dirty survey table derived from the
driver tables.

The survey CSV has ten columns; the derived view below gives the same ten
columns (snake_case names) with the same kinds of dirt, computed from
``orders JOIN customer`` so that its size grows with the data. The view is
written once as SQL text that Spark and DuckDB evaluate identically
(only ``%``, ``CASE``, ``floor``, ``CAST`` and string literals).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablight.operators.clean import Rule
from tablight.sources.tables import table

# ---------------------------------------------------------------------------
# The reference's cleaning maps, stated as they are.
# ---------------------------------------------------------------------------
EDUCATION_MAP = {
    "U": "University", "S": "School", "C": "College",
    "UG": "University", "PG": "University",
    "HS": "School", "Uni": "University",
    "School": "School", "College": "College",
    "University": "University", "college": "College",
    "school": "School", "university": "University",
    "CollegeU": "College", "Coll": "College",
    "UniversityS": "University",
}
AREA_MAP = {
    "U": "Urban", "R": "Rural", "u": "Urban", "r": "Rural",
    "Urban": "Urban", "Rural": "Rural", "rurak": "Rural",
}
GENDER_REPLACE = {
    "m": "Male", "f": "Female",
    "male": "Male", "female": "Female",
    "pns": "Prefer not to say", "prefer not to say": "Prefer not to say",
    "nan": "Prefer not to say", "none": "Prefer not to say",
    "": "Prefer not to say",
}
VALID_GENDERS = ("Male", "Female", "Prefer not to say")
GENDER_DEFAULT = "Prefer not to say"
YES_NO_MAP = {"Y": "Yes", "N": "No", "1": "Yes", "0": "No", "Yes": "Yes", "No": "No"}
LABEL_MAP = {"Yes": 1.0, "No": 0.0}
# Display names of the label values.
LABEL_NAMES = {0.0: "Not Fraud", 1.0: "Fraud"}
# The five categorical columns tested against the label, in the reference's order.
CATEGORICAL_TESTED = ("Education", "Gender", "Area", "Home Owner", "Employed")
# ---------------------------------------------------------------------------

SURVEY_COLUMNS = (
    "Income", "Area", "Employed", "Education", "Home Owner",
    "Gender", "Balance", "Age", "Colour", "Fraud",
)
SNAKE = {c: c.lower().replace(" ", "_") for c in SURVEY_COLUMNS}


def survey_spec(names: dict | None = None) -> dict[str, Rule]:
    """The reference's cleaning rules keyed by column name (optionally renamed)."""
    n = names or {c: c for c in SURVEY_COLUMNS}
    yes_no = Rule(kind="map", mapping=YES_NO_MAP, impute="mode")
    return {
        n["Income"]: Rule(kind="numeric", impute="median"),
        n["Area"]: Rule(kind="map", mapping=AREA_MAP, impute="mode"),
        n["Employed"]: yes_no,
        n["Education"]: Rule(kind="map", mapping=EDUCATION_MAP, impute="mode"),
        n["Home Owner"]: yes_no,
        n["Gender"]: Rule(
            kind="replace", mapping=GENDER_REPLACE, lower=True, allowed=VALID_GENDERS,
            default=GENDER_DEFAULT, impute="const", fill=GENDER_DEFAULT,
        ),
        n["Balance"]: Rule(kind="numeric", impute="median"),
        n["Age"]: Rule(kind="numeric", impute="mean"),
        n["Colour"]: Rule(kind="keep", impute="mode"),
        n["Fraud"]: Rule(kind="label", mapping=YES_NO_MAP, then=LABEL_MAP, impute="mode", default=0.0),
    }


def snake_spec() -> dict[str, Rule]:
    return survey_spec(SNAKE)


# Dirty survey rows from orders x customer. Every expression is plain SQL that
# Spark and DuckDB read the same way.
DIRTY_SURVEY_EXPRS = {
    "row_id": "o_orderkey",
    "income": (
        "CASE WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN NULL "
        "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END"
    ),
    "area": (
        "CASE WHEN o_orderstatus = 'F' THEN (CASE o_orderkey % 5 WHEN 0 THEN 'Rural' WHEN 1 THEN 'R' "
        "WHEN 2 THEN 'r' WHEN 3 THEN 'rurak' ELSE 'Rurak' END) "
        "WHEN o_orderstatus = 'O' THEN (CASE o_orderkey % 4 WHEN 0 THEN 'Urban' WHEN 1 THEN 'U' "
        "WHEN 2 THEN 'u' ELSE NULL END) "
        "ELSE (CASE o_orderkey % 6 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Rural' WHEN 2 THEN 'U' "
        "WHEN 3 THEN 'R' WHEN 4 THEN 'Urban ' ELSE 'u' END) END"
    ),
    "employed": (
        "CASE o_custkey % 8 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN 'Yes' WHEN 3 THEN 'No' "
        "WHEN 4 THEN '1' WHEN 5 THEN '0' WHEN 6 THEN 'y' ELSE NULL END"
    ),
    "education": (
        "CASE (o_orderkey + c_nationkey) % 12 WHEN 0 THEN 'School' WHEN 1 THEN 'University' "
        "WHEN 2 THEN 'S' WHEN 3 THEN 'U' WHEN 4 THEN 'Uni' WHEN 5 THEN 'Uni ' WHEN 6 THEN 'S ' "
        "WHEN 7 THEN 'C ' WHEN 8 THEN 'Coll ' WHEN 9 THEN 'Coll' WHEN 10 THEN 'College' ELSE NULL END"
    ),
    "home_owner": (
        "CASE WHEN o_orderstatus = 'F' THEN (CASE o_custkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'No' "
        "WHEN 2 THEN '0' WHEN 3 THEN 'Y' ELSE ' ' END) "
        "ELSE (CASE o_custkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'Yes' WHEN 2 THEN '1' WHEN 3 THEN 'y' "
        "WHEN 4 THEN 'N' ELSE NULL END) END"
    ),
    "gender": (
        "CASE o_custkey % 9 WHEN 0 THEN 'F' WHEN 1 THEN 'Male' WHEN 2 THEN 'M' WHEN 3 THEN 'Female' "
        "WHEN 4 THEN 'PNS' WHEN 5 THEN ' ' WHEN 6 THEN NULL WHEN 7 THEN 'male' ELSE 'FEMALE' END"
    ),
    "balance": (
        "CASE WHEN o_custkey % 17 = 0 THEN ' ' WHEN o_custkey % 19 = 0 THEN NULL "
        "WHEN o_custkey % 23 = 0 THEN 'n/a' "
        "ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) END"
    ),
    "age": (
        "CASE WHEN o_orderkey % 29 = 0 THEN ' ' WHEN o_orderkey % 31 = 0 THEN NULL "
        "WHEN o_orderkey % 37 = 0 THEN 'abc' "
        "WHEN o_orderstatus = 'F' THEN CAST(18 + (o_custkey % 12) AS STRING) "
        "ELSE CAST(25 + ((o_custkey + o_orderkey) % 40) AS STRING) END"
    ),
    "colour": (
        "CASE c_nationkey % 11 WHEN 0 THEN 'Black' WHEN 1 THEN 'White' WHEN 2 THEN 'Grey' "
        "WHEN 3 THEN 'Red' WHEN 4 THEN 'Yellow' WHEN 5 THEN 'Blue' WHEN 6 THEN 'Pink' "
        "WHEN 7 THEN 'Green' WHEN 8 THEN 'White ' WHEN 9 THEN 'Purple' ELSE NULL END"
    ),
    "fraud": (
        "CASE WHEN o_orderstatus = 'F' THEN (CASE o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN '1' "
        "WHEN 2 THEN 'Yes' WHEN 3 THEN 'yes' WHEN 4 THEN 'N' ELSE 'Y' END) "
        "WHEN o_orderstatus = 'O' THEN (CASE o_orderkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN '0' "
        "WHEN 2 THEN 'No' WHEN 3 THEN 'Y' ELSE NULL END) "
        "ELSE (CASE o_orderkey % 4 WHEN 0 THEN 'y' WHEN 1 THEN 'No' WHEN 2 THEN '1' ELSE 'N' END) END"
    ),
}

DIRTY_COLUMNS = tuple(DIRTY_SURVEY_EXPRS)


def dirty_survey_sql() -> str:
    """The view as one SELECT over ``orders`` and ``customer`` (DuckDB / Spark SQL)."""
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in DIRTY_SURVEY_EXPRS.items())
    return f"SELECT\n  {cols}\nFROM orders JOIN customer ON o_custkey = c_custkey"


def dirty_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty survey rows as a DataFrame (join + one projection)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.selectExpr(*[f"{e} AS {n}" for n, e in DIRTY_SURVEY_EXPRS.items()])


def clean_survey(spark: SparkSession, sf_dir: str):
    """Dirty view -> cleaned survey table (CleanResult)."""
    from tablight.operators.clean import clean

    return clean(dirty_survey(spark, sf_dir), snake_spec())

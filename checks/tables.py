"""Inputs of the checks: the given tables, and résumé-shaped text derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilrank.session import spread

_Q = "chr(39)"  # a single quote, written the same way for both SQL engines
_FIRST = "split_part('Ann,Boris,Clara,Dmitri,Elena', ',', CAST(k % 5 + 1 AS INT))"
_LAST = "split_part('Miller,Novak,Ortega,Patel', ',', CAST(k % 4 + 1 AS INT))"


def _s(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _pad(expression: str, width: int) -> str:
    return f"lpad({_s(expression)}, {width}, '0')"


_DAY, _MONTH, _YEAR = _pad("k % 28 + 1", 2), _pad("k % 12 + 1", 2), _s("1960 + k % 40")
_AGE, _FIRM = _s("20 + k % 40"), _s("k % 11")

# (condition or None, text); a line whose condition fails is left out.
_LINES = (
    (None, f"'Full Name: ' || {_FIRST} || ' ' || {_LAST}"),
    (None, "'Sector: ' || c_mktsegment"),
    ("k % 5 = 1", "'Referee: Ann B. Novak'"),
    ("k % 4 = 0", f"'Father' || {_Q} || 's Name: Karl Miller'"),
    ("k % 4 = 1", f"'Mother' || {_Q} || 's Name: Eva Novak'"),
    ("k % 9 <> 0", f"'Email: user' || {_s('k')} || '@mail' || {_s('k % 7')} || '.example.com'"),
    ("k % 3 <> 0", f"'Phone: 555-' || {_pad('k % 1000', 3)} || '-' || {_pad('k % 10000', 4)}"),
    ("k % 8 = 3", "'Tel: 12-34 56 78'"),
    ("k % 4 = 0", f"'linkedin.com/in/user-' || {_s('k')}"),
    ("k % 4 = 1", f"'github.com/user' || {_s('k')}"),
    ("k % 4 = 2", f"'twitter.com/u_' || {_s('k')}"),
    ("k % 4 = 3", f"'facebook.com/u.' || {_s('k')}"),
    ("k % 4 = 0", f"'Date of Birth: ' || {_DAY} || '/' || {_MONTH} || '/' || {_YEAR}"),
    ("k % 4 = 1", f"'DOB: ' || {_YEAR} || '-' || {_MONTH} || '-' || {_DAY}"),
    ("k % 4 = 2", f"'Birth Date: March ' || {_s('k % 28 + 1')} || ', ' || {_YEAR}"),
    ("k % 4 = 3",
     f"'Date of Birth (Gender): ' || {_YEAR} || '-' || {_MONTH} || '-' || {_DAY} || ' (M)'"),
    ("k % 2 = 0", "'Gender: Male'"),
    ("k % 2 = 1", "'Gender-Female'"),
    ("k % 3 = 0", "'Marital Status: Single'"),
    ("k % 3 = 1", "'Marital Status: Married'"),
    ("k % 2 = 0", "'Nationality: ' || n_name"),
    ("k % 10 = 0", f"'Photo: img_' || {_s('k')} || '.jpg'"),
    ("k % 3 = 0", f"'Address: ' || {_s('k')} || ' Old Mill'"),
    ("k % 3 = 1", f"{_s('k')} || ' Long Hill Road'"),
    ("k % 3 = 2", f"{_s('k')} || '/B, Green Park, Pune, India'"),
    ("k % 4 = 0", "'June 2010 to May 2014'"),
    ("k % 4 = 1", "'2010 to 2014'"),
    ("k % 4 = 2", "'2010 - 2014'"),
    ("k % 4 = 3", "'since Mar 2015'"),
    ("k % 2 = 1", "'2016 to present'"),
    ("k % 4 = 0", f"'Company Name: Firm ' || {_FIRM}"),
    ("k % 4 = 1", f"'Employer: Firm ' || {_FIRM}"),
    ("k % 4 = 2", f"'Worked at Acme ' || {_FIRM} || ' Ltd'"),
    ("k % 4 = 3", f"'company - Firm ' || {_FIRM}"),
    ("k % 3 = 0", "'University of Pune'"),
    ("k % 3 = 1", "'School: Hill Top'"),
    ("k % 3 = 2", "'Delhi Public School'"),
    ("k % 13 = 0", "'7 Near the old temple behind the water tank opposite the new bus stand and the '"
                   " || 'big vegetable market of the Long Hill Road'"),
    ("k % 13 = 1", "'Worked at Acme and Sons Trading and Shipping and Storage and Insurance and '"
                   " || 'Banking and Travel and Computer Services of Pune Ltd'"),
    ("k % 13 = 2", "'Aa Bb Cc Dd Ee Ff Gg Hh Ii Jj University'"),
    ("k % 3 = 0", f"'Age: ' || {_AGE}"),
    ("k % 3 = 1", f"{_AGE} || ' years old'"),
    ("k % 3 = 2", f"'age ' || {_AGE}"),
)

_TEXT = "concat_ws(chr(10), " + ",\n  ".join(
    text if condition is None else f"CASE WHEN {condition} THEN {text} END"
    for condition, text in _LINES
) + ")"

# Blank, empty and missing cells appear in some rows of the wide form.
_WIDE = {
    "id": "k",
    "job_description": f"CASE WHEN k % 7 = 0 THEN NULL ELSE {_TEXT} END",
    "skill_details": "CASE WHEN k % 5 = 0 THEN '' WHEN k % 5 = 1 THEN ' ' || chr(10) || ' ' "
                     "ELSE 'skills for ' || c_mktsegment END",
    "education": "CASE WHEN k % 3 = 0 THEN NULL ELSE 'degree from ' || n_name END",
    "company_code": "k % 11",
    "note": "'not content'",
}

_BASE = """(SELECT c_custkey AS k, c_mktsegment, n_name
   FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

RESUMES_SQL = f"SELECT k AS doc_id, c_mktsegment AS category, {_TEXT} AS text FROM {_BASE} AS base"
WIDE_SQL = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _WIDE.items()) + f" FROM {_BASE} AS base"
)
BLANKS_SQL = f"""SELECT doc_id,
  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN ''
       WHEN doc_id % 17 = 0 THEN ' ' || chr(10) || ' ' ELSE text END AS text
  FROM ({RESUMES_SQL}) AS resumes"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def _derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(
        sql.replace("FROM customer JOIN nation", "FROM {customer} JOIN {nation}"),
        customer=spread(table(spark, sf_dir, "customer"), "c_custkey"),
        nation=table(spark, sf_dir, "nation"),
    )


def resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, category, text)``: one text with labelled fields per customer."""
    return _derived(spark, sf_dir, RESUMES_SQL)


def wide_resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, WIDE_SQL)


def blank_resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, BLANKS_SQL)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all résumés; the latter have negative keys."""
    labelled = resumes(spark, sf_dir).select((-1 - F.col("doc_id")).alias("doc_id"), "text")
    return documents(spark, sf_dir).select("doc_id", "text").unionByName(labelled)


def categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source as category."""
    return documents(spark, sf_dir).select("doc_id", F.col("source").alias("category"), "text")


def assigned_jds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with one job description: ``(doc_id, text, item_id, jd_text)``."""
    jds = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("jd_text"))
    n = jds.agg(F.count(F.lit(1)).alias("n")).scalar()
    docs = documents(spark, sf_dir).select("doc_id", "text", (F.col("doc_id") % n).alias("item_id"))
    return docs.join(jds, "item_id")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels with a rule's guess: the share of distinct words."""
    from veilrank.functions.text import words

    docs = documents(spark, sf_dir).select("doc_id", words(F.lower("text")).alias("w"))
    p = F.coalesce(
        F.try_divide(F.size(F.array_distinct("w")).cast("double"), F.size("w")), F.lit(0.0)
    )
    scored = docs.select("doc_id", p.alias("p_match"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return labels.join(scored, "doc_id").withColumn(
        "prediction", F.when(F.col("p_match") >= 0.5, 1).otherwise(0)
    )

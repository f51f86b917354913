"""Scalar text functions: cleaning, identity, tokens, pair text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilrank.catalog import RULES, SEPARATOR
from veilrank.functions.matching import UNICODE, spark_pattern

_RULE = {r.rule_id: r for r in RULES}

# A run of non-spaces with an "@" after its first and before its last character, taken whole.
# Starting only at the head of a run keeps this linear on long runs without an "@".
_EMAIL_RUN = UNICODE + r"(?<!\S)\S[^\s@]*+@\S+"
_DIGIT_RUN = UNICODE + r"\b\d{10,}\b"
_WORD = r"[\p{L}\p{N}]+"


def lowercase(text: Column) -> Column:
    return F.lower(text)


def scrub_email(text: Column) -> Column:
    """Every run of non-spaces around an ``@`` becomes ``<EMAIL>``."""
    return F.regexp_replace(text, _EMAIL_RUN, "<EMAIL>")


def scrub_phone(text: Column) -> Column:
    """Every free-standing run of ten or more digits becomes ``<PHONE>``."""
    return F.regexp_replace(text, _DIGIT_RUN, "<PHONE>")


def scrub(text: Column) -> Column:
    """Lower-case first, so the placeholders stay upper-case."""
    return scrub_phone(scrub_email(lowercase(text)))


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(UNICODE + r"\A\s*\z")


def resume_id(text: Column) -> Column:
    """Stable id: hash of the first e-mail, else of the first two-word name, else of the text."""
    email = F.regexp_extract(text, spark_pattern(_RULE["email"]), 0)
    name = F.regexp_extract(text, spark_pattern(_RULE["name_two"]), 0)
    return (
        F.when(
            text.contains("@") & (email != ""),
            F.concat(F.lit("email-"), F.substring(F.md5(email), 1, 8)),
        )
        .when(name != "", F.concat(F.lit("name-"), F.substring(F.md5(name), 1, 8)))
        .when(
            text.isNotNull(), F.concat(F.lit("resume-"), F.substring(F.md5(text), 1, 12))
        )
    )


def argmax_label(scores: Column) -> Column:
    """Index of the largest value, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def pair_text(jd: Column, resume: Column, separator: str = SEPARATOR) -> Column:
    return F.concat_ws(separator, jd, resume)


def words(text: Column) -> Column:
    """Runs of letters and digits, in order."""
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def distinct_words(text: Column) -> Column:
    return F.array_distinct(words(text))


def tokens(text: Column) -> Column:
    """White-space separated tokens, without empty ones."""
    return F.array_remove(F.split(text, UNICODE + r"\s+", -1), "")


def kept_tokens(n_jd: Column, n_resume: Column, budget: int) -> tuple[Column, Column]:
    """How many tokens of each side fit a shared budget when the longer side is cut first."""
    half = F.lit((budget + 1) // 2)
    keep_jd = F.least(n_jd, F.greatest(F.lit(budget) - n_resume, half))
    keep_resume = F.least(n_resume, F.lit(budget) - keep_jd)
    return keep_jd, keep_resume


def token_budget(jd: Column, resume: Column, budget: int) -> tuple[Column, Column]:
    """Both texts cut to a shared budget of tokens, ``(jd_cut, resume_cut)``, the longer first."""
    a, b = tokens(jd), tokens(resume)
    keep_a, keep_b = kept_tokens(F.size(a), F.size(b), budget)
    return (
        F.array_join(F.slice(a, F.lit(1), keep_a), " ").alias("jd_cut"),
        F.array_join(F.slice(b, F.lit(1), keep_b), " ").alias("resume_cut"),
    )


def preview_line(score: Column, text: Column, width: int = 80) -> Column:
    return F.format_string("%.4f | %s…", score, F.substring(text, 1, width))

"""Column choice, audits and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilrank.catalog import CONTENT_KEYWORDS
from veilrank.functions.text import is_blank, scrub


def derive_clean_columns(
    df: DataFrame, category: str = "category", resume: str = "resume"
) -> DataFrame:
    return df.withColumns(
        {"jd_clean": scrub(F.col(category)), "resume_clean": scrub(F.col(resume))}
    )


def discover_content_columns(df: DataFrame, key: str = "id") -> list[str]:
    """Columns named like résumé content; else every column but ``id`` and the key.  Runs no job."""
    keys = {"id", key.lower()}
    columns = [c for c in df.columns if c.lower() not in keys]
    return [c for c in columns if any(k in c.lower() for k in CONTENT_KEYWORDS)] or columns


def combine_content(df: DataFrame, columns: list[str]) -> Column:
    """The columns' texts joined by a blank line, without null and blank ones."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat_ws("\n\n", *[F.when(~is_blank(t), t) for t in texts])


def choose_content(
    df: DataFrame,
    content_column: str | None = "content",
    output: str = "combined_content",
    key: str = "id",
) -> tuple[DataFrame, str]:
    """The given column if the table has it, else the combined content columns; never the key."""
    if content_column is not None and content_column in df.columns:
        return df, content_column
    return df.withColumn(output, combine_content(df, discover_content_columns(df, key))), output


def null_audit(df: DataFrame, fail: bool = False) -> DataFrame:
    """Null cells per column, ``(column_name, n_null)``, in one pass.

    With ``fail`` the pass runs at once and nulls raise ``ValueError``.
    """
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns]
    )
    audit = counts.select(F.inline(rows))
    if fail:
        bad = [r.column_name for r in audit.where("n_null > 0").collect()]
        if bad:
            raise ValueError(f"null cells in columns: {', '.join(bad)}")
    return audit


def filled_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-blank cells per column, ``(column_name, n_filled)``, in one pass."""
    counts = df.agg(
        *[F.count_if(~is_blank(F.col(c).cast("string"))).alias(c) for c in columns]
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def keep_features(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Drop everything but the label and the features."""
    keep = {label, *features}
    return df.drop(*[c for c in df.columns if c not in keep])


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def row_and_column_counts(df: DataFrame, sample_size: int | None = None) -> DataFrame:
    """Rows, columns and rows a sample would hold."""
    n = F.count(F.lit(1))
    sampled = n if sample_size is None else F.least(n, F.lit(sample_size))
    return df.agg(
        n.alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        sampled.cast("long").alias("n_sampled"),
    )



"""CSV, Parquet and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_redacted(df: DataFrame, path: str, format: str = "csv", mode: str = "errorifexists"):
    """CSV with a header and every cell quoted, or any Spark format such as ``parquet``.

    CSV cannot tell empty text from null; Parquet can.
    """
    writer = df.write.mode(mode)
    if format == "csv":
        # Keep white space at the ends of cells.
        writer = (
            writer.option("header", True)
            .option("encoding", "UTF-8")
            .option("quoteAll", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(format).save(path)


def write_entities_json(
    df: DataFrame, path: str, rid: str = "resume_id", entities: str = "entities",
    mode: str = "errorifexists",
):
    """One JSON line ``{"resume_id": …, "entities": {type: [text, …]}}`` per résumé id."""
    df.selectExpr(f"`{rid}` AS resume_id", f"`{entities}` AS entities").write.mode(mode).json(path)

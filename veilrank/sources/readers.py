"""CSV and text file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RESUME_SCHEMA = StructType(
    [StructField("Category", StringType()), StructField("Resume", StringType())]
)
CORRUPT = "_corrupt_record"


def with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])


def read_csv_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RESUME_SCHEMA,
    header: bool = True,
) -> DataFrame:
    """Every record, with ``rejected`` true for those with more cells than columns.

    Records with too few cells are kept, their missing cells null.
    """
    raw = (
        spark.read.schema(with_corrupt(schema))
        .option("header", header)
        .option("encoding", "UTF-8")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    rejected = too_many_cells(F.col(CORRUPT), F.col(schema.names[-1]), len(schema.names))
    return raw.withColumn("rejected", rejected).drop(CORRUPT)


def too_many_cells(record: Column, last: Column, columns: int) -> Column:
    """Whether a flagged record has too many cells: separators outside quotes tell.

    The last column takes part because Spark refuses to read the flag alone, as a plain count
    of the records would.
    """
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*+"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    short = last.isNull() & (cells < columns)
    return F.when(record.isNull() | short, False).otherwise(cells > columns)


def read_resume_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RESUME_SCHEMA,
    header: bool = True,
) -> DataFrame:
    """CSV with a header, UTF-8 and quoted multi-line cells; over-long records are left out.

    A file is read by one task; ``split_csv.read_csv_split`` reads a large one by many.
    """
    records = read_csv_with_rejects(spark, path, schema, header)
    return records.where(~F.col("rejected")).drop("rejected")


def read_csv_with_causes(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RESUME_SCHEMA,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The records that fit the schema, and the rejects: ``(record, column, cell, cause)``.

    Every cell is read as text and cast where that is possible, so a record whose number or date
    cannot be read is told with its cell instead of losing the value.  A reject has one row for each
    cell at fault (``not a <type>``), or one for a record with too many cells; ``record`` has its cells as text.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = read_csv_with_rejects(spark, path, text, header)
    record = F.struct(*schema.names).alias("record")
    fault = "array<struct<column:string,cell:string,cause:string>>"
    typed = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    faults = F.array_compact(F.array(*(
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("cell"),
                     F.lit(f"not a {f.dataType.simpleString()}").alias("cause")),
        ) for f in typed
    )).cast(fault))
    nothing = F.lit(None).cast("string")
    many = F.array(F.struct(nothing.alias("column"), nothing.alias("cell"), F.lit("too many cells").alias("cause")))
    read = raw.withColumn("_faults", F.when(F.col("rejected"), many.cast(fault)).otherwise(faults))
    good = read.where(F.size("_faults") == 0).select(
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields)
    )
    return good, read.select(record, F.explode("_faults").alias("_fault")).select("record", "_fault.*")


def read_text_docs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One document per UTF-8 text file, ``(path, text)``, line ends as LF."""
    files = spark.read.text(paths, wholetext=True)
    text = F.regexp_replace("value", r"\r\n?", "\n")
    return files.select(F.col("_metadata.file_path").alias("path"), text.alias("text"))

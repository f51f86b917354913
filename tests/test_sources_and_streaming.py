import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veilrank import session
from veilrank.plans.redaction_job import redaction_table
from veilrank.sources import readers, split_csv, writers
from veilrank.functions.text import resume_id
from veilrank.operators.entities import entities_by_resume, entity_map
from veilrank.streaming.incremental import (
    compact_entities,
    incremental_entities,
    incremental_redact,
    latest_entities,
    stream_parquet,
)


def test_csv_round_trip(spark, tmp_path):
    rows = [("HR", 'say "hi",\nnow '), ("", None), (None, ""), ("é", "a\r\nb"), (" x", "\\")]
    df = spark.createDataFrame(rows, readers.RESUME_SCHEMA)
    writers.write_redacted(df, str(tmp_path / "csv"))
    got = readers.read_resume_csv(spark, str(tmp_path / "csv"))
    want = [tuple(cell or None for cell in row) for row in rows]  # empty comes back as null
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert got.count() == 5 and got.select("Category").distinct().count() == 4


def test_bad_rows(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        'Category,Resume\nHR,ok\nHR,a,b,c\nshort\nIT,"x, ""y"",\nz"\nLaw,a,\n"Q, R",t\n',
        encoding="utf8",
    )
    rows = readers.read_csv_with_rejects(spark, str(path)).collect()
    kept = {(r.Category, r.Resume) for r in rows if not r.rejected}
    assert kept == {("HR", "ok"), ("short", None), ("IT", 'x, "y",\nz'), ("Q, R", "t")}
    assert sum(r.rejected for r in rows) == 2
    assert readers.read_resume_csv(spark, str(path)).count() == 4


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("a\r\nb\rc".encode())
    (tmp_path / "b.txt").write_bytes("é\n".encode())
    got = readers.read_text_docs(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert {r.path[-5:]: r.text for r in got.collect()} == {"a.txt": "a\nb\nc", "b.txt": "é\n"}


def test_entities_json(spark, tmp_path):
    df = spark.createDataFrame([("id-1", {"age": ["4"], "gender": ["男"]})],
                               "rid string, found map<string,array<string>>")
    writers.write_entities_json(df, str(tmp_path / "j"), "rid", "found")
    (line,) = spark.read.text(str(tmp_path / "j")).collect()
    assert "男" in line.value
    assert json.loads(line.value) == {
        "resume_id": "id-1", "entities": {"age": ["4"], "gender": ["男"]}
    }


def test_stream_equals_batch_and_restarts_cleanly(spark, texts, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = texts("Ann Lee", "plain", None)
    first.write.parquet(source)

    def run():
        stream = stream_parquet(spark, source, first.schema, files_per_batch=1)
        incremental_redact(stream, out, state, partitions=2).awaitTermination()
        return spark.read.parquet(out).select("doc_id", "anonymized_content", "entities")

    def batch(df):
        return redaction_table(df, "text").select("doc_id", "anonymized_content", "entities")

    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(run()) == rows(batch(first))
    assert rows(run()) == rows(batch(first))  # nothing new, nothing twice
    more = texts("Bob Ray b@c.org").withColumn("doc_id", F.lit(9).cast("long"))
    more.write.mode("append").parquet(source)
    assert rows(run()) == rows(batch(first.union(more)))


def test_shared_folder_comes_from_the_session(spark, texts):
    shared = session.shared_dir(spark)
    assert session.scratch_path(spark, "x").startswith(shared)
    df = texts("a", "b")
    stored = session.materialize(df, "t")
    assert all(shared in f for f in stored.inputFiles())
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))


def test_spread_goes_by_bytes_and_not_by_files(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for name, files in (("one", 1), ("many", 2 * cores)):
        spark.range(100).repartition(files).write.parquet(str(tmp_path / name))
        small = session.spread(spark.read.parquet(str(tmp_path / name)), "id")
        assert small.rdd.getNumPartitions() == cores


def test_csv_rejects_tell_cell_and_cause(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,when,note\n1,2020-01-31,"two\nlines"\nx2,2020-02-30,both\n3,,short\n4,2020-01-01,a,extra\n5\n'
    )
    schema = StructType.fromDDL("id int, when date, note string")
    good, rejects = readers.read_csv_with_causes(spark, str(tmp_path / "a.csv"), schema)
    assert good.schema == schema
    assert sorted((r.id, str(r.when), r.note) for r in good.collect()) == [
        (1, "2020-01-31", "two\nlines"), (3, "None", "short"), (5, "None", None)]
    told = sorted((r.record.id, r["column"] or "", r.cell or "", r.cause) for r in rejects.collect())
    assert told == [("4", "", "", "too many cells"), ("x2", "id", "x2", "not a int"), ("x2", "when", "2020-02-30", "not a date")]


def test_split_csv_equals_whole_files_at_any_range_size(spark, tmp_path):
    rows = [(i, f"c{i % 7}", 'say "hi",\n' * (i % 5) + "x" * (i * 37 % 300) + ("\r\n\n,é" if i % 3 else "")) for i in range(200)]
    schema = StructType.fromDDL("id long, kind string, note string")
    spark.createDataFrame(rows, schema).coalesce(2).write.option("header", True).option("quote", '"').option(
        "escape", '"').csv(str(tmp_path / "csv"))
    (tmp_path / "csv" / "extra.csv").write_text(
        'id,kind,note\r\n900,a,b,c\r\n\r\n901,short\r\n902,"q, ""r""\n\n' + "long line\n" * 300 + '",z\r\n903,,', "utf8")
    whole = readers.read_csv_with_rejects(spark, str(tmp_path / "csv"), schema)
    want = sorted(map(str, whole.collect()))
    assert len(want) == 204 and whole.where("rejected").count() == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (40, 333, 4096, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = split_csv.read_csv_split(spark, str(tmp_path / "csv"), schema)
            assert got.schema == whole.schema
            assert sorted(map(str, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_split_csv_of_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Category,Resume\n")
    assert split_csv.read_csv_split(spark, str(tmp_path / "a.csv")).count() == 0


def test_latest_entities_in_any_order_and_after_restarts(spark, tmp_path):
    rows = [(1, "a@b.co Age: 31"), (2, "plain"), (3, "a@b.co Age: 44"), (4, "c@d.org"), (5, None), (6, "a@b.co Age: 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def lines(df):
        return sorted((r.resume_id or "", r.doc_id, str(r.entities)) for r in df.collect())

    def batch(df):
        named = df.select("doc_id", resume_id(F.col("text")).alias("resume_id"), entity_map(F.col("text")).alias("entities"))
        return lines(entities_by_resume(named, "doc_id", "resume_id", "entities"))

    for n, order in enumerate(((1, 2, 3, 4, 5, 6), (6, 3, 1, 5, 4, 2))):
        source, out, state = (str(tmp_path / f"{name}{n}") for name in ("in", "out", "state"))
        for i, own in enumerate(order):
            docs.where(F.col("doc_id") == own).coalesce(1).write.mode("append").parquet(source)
            if i in (1, 3, 5):  # the query stops and starts again, and is told some files at a time
                stream = stream_parquet(spark, source, docs.schema, files_per_batch=1)
                incremental_entities(stream, out, state).awaitTermination()
                seen = docs.where(F.col("doc_id").isin(*order[: i + 1]))
                assert lines(latest_entities(spark, out)) == batch(seen)
    compact_entities(spark, out, str(tmp_path / "small"))
    assert lines(latest_entities(spark, str(tmp_path / "small"))) == batch(docs)

import time
from hashlib import md5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veilrank.catalog import select_rules
from veilrank.functions import text as tx
from veilrank.functions.matching import spark_pattern
from veilrank.operators import entities as en
from veilrank.operators.redact import blank_guard, redact, redact_column, text_status
from veilrank.plans.redaction_job import redaction_table, run_redaction

T = F.col("text")


def test_blank_text_passes(each):
    blanks = (None, "", " \n  ")
    assert each(redact_column(T), *blanks) == list(blanks)
    assert each(blank_guard(T, tx.scrub(T)), *blanks) == list(blanks)
    assert each(F.map_keys(en.entity_map(T)), *blanks)[1:] == [[], []]


def test_types_do_not_depend_on_each_other(each):
    assert each(redact_column(T, ["EMAIL_ADDRESS"]), "a@b.co (M)") == ["<EMAIL> (M)"]


def test_rule_order(each):
    line = "Marital Status: Single"
    assert each(redact_column(T), line) == ["<NAME>: <MARITAL_STATUS>"]
    assert each(redact_column(T, order="names_first"), line) == ["<NAME>: Single"]


def test_raw_text_is_dropped_unless_asked_for(texts):
    df = texts("Ann Lee")
    assert redact(df).columns == ["doc_id", "anonymized_content"]
    assert redact(df, keep_raw=True).columns == ["doc_id", "text", "anonymized_content"]


def test_redaction_is_idempotent(each):
    line = "Ann Lee\nTel: 12-34 56 78\nDOB: 1970-01-02\nEmployer: Firm 3\n41 years old"
    (once,) = each(redact_column(T), line)
    assert each(redact_column(T), once) == [once]


def test_long_run_of_capitalised_words(each):
    line = "Foo " * 20_000
    (out,) = each(redact_column(T, ["SCHOOL_NAME"]), line)
    assert out == line
    (out,) = each(redact_column(T), line)
    assert out == "<NAME> " * 10_000


def test_long_runs_end_soon(each):
    school = "School. " + "Foo " * 20_000
    assert each(redact_column(T, ["SCHOOL_NAME"]), school) == [school]
    named = "Foo " * 20_000 + "University"
    assert each(redact_column(T, ["SCHOOL_NAME"]), named) == ["<SCHOOL>"]
    worked = "worked at " + "Foo " * 10_000
    assert each(redact_column(T, ["COMPANY_NAME"]), worked) == [worked]


def test_a_type_without_rules_is_not_left_raw_silently(each, texts):
    with pytest.raises(ValueError, match="NATIONALITY"):
        redact_column(T, ["NATIONALITY", "AGE"])
    made = redaction_table(texts("Nationality: Indian"), "text", ["NATIONALITY"]).first()
    assert made.anonymized_content == "Nationality: <NATIONALITY>" and made.status == "redacted"
    low = redaction_table(texts("since Mar 2015"), "text", threshold=0.6).first()
    assert "2015" not in low.anonymized_content


def test_job_keeps_other_columns_and_the_key_is_no_content(spark, tmp_path):
    rows = [("HR", "Ann Lee", 4155550123), ("IT", "plain", 4155550124)]
    df = spark.createDataFrame(rows, "Category string, skills string, doc_id long")
    report = run_redaction(df, str(tmp_path / "out"), str(tmp_path / "entities"), format="parquet")
    got = {r.doc_id: r for r in report.redacted.collect()}
    assert got[4155550123].anonymized_content == "<NAME>" and got[4155550123].Category == "HR"
    assert got[4155550124].status == "clean"
    assert Path(report.path).exists()
    report.close()
    assert not Path(report.path).exists()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(stored.columns) == ["Category", "anonymized_content", "doc_id"]
    whole = spark.createDataFrame(rows, "Category string, Resume string, doc_id long")
    report = run_redaction(whole, str(tmp_path / "o2"), str(tmp_path / "e2"))
    assert {r.anonymized_content for r in report.redacted.collect()} == {"HR\n\n<NAME>", "IT\n\nplain"}


def test_long_run_without_spaces(each):
    line = "x" * 200_000 + " a@b"
    assert each(tx.scrub_email(T), line) == ["x" * 200_000 + " <EMAIL>"]


def test_status(each):
    assert each(text_status(T, redact_column(T)), None, " ", "plain", "Ann Lee") == [
        "blank", "blank", "clean", "redacted"
    ]


def test_entities_are_found_in_the_original_text(each):
    line = "Ann Lee, Bob Ray, Ann Lee, x@y.org"
    (found,) = each(en.entity_map(T), line)
    assert found == {"person_name": ["Ann Lee", "Bob Ray"], "email_address": ["x@y.org"]}
    (none,) = each(en.entity_map(T, ["RELIGION"]), line)
    assert none == {}


def spans(*rows):
    return [(s, e, score, kind, "t", "r") for s, e, score, kind in rows]


@pytest.mark.parametrize(
    "given, islands",
    [
        ([], []),
        (
            [(0, 5, 0.7, "A"), (3, 8, 0.9, "B"), (8, 10, 0.8, "C"), (20, 30, 0.7, "D"),
             (22, 24, 0.6, "E")],
            [(0, 8, "B"), (8, 10, "C"), (20, 30, "D")],
        ),
        ([(0, 5, 0.7, "A"), (0, 6, 0.7, "B")], [(0, 6, "B")]),
        ([(0, 5, 0.7, "A"), (0, 5, 0.7, "B")], [(0, 5, "B")]),
        ([(0, 9, 0.7, "A"), (1, 2, 0.9, "B"), (8, 12, 0.7, "C")], [(0, 12, "B")]),
    ],
)
def test_overlaps(spark, given, islands):
    df = spark.createDataFrame(
        [(spans(*given[::-1]),)],
        "spans array<struct<start:int,end:int,score:double,entity_type:string,text:string,"
        "rule_id:string>>",
    )
    (row,) = df.select(en.resolve_overlaps(F.col("spans")).alias("out")).collect()
    assert [(i.start, i.end, i.label.entity_type) for i in row.out] == islands


def test_masking(each):
    made = en.mask_spans(T, en.resolve_overlaps(en.all_spans(T)))
    line = "Date of Birth (Gender): 1963-04-04 (M)\nNationality: Indian\né Ann Lee é"
    assert each(made, line, "plain", "", None) == [
        "Date of Birth (Gender): <DOB> <GENDER>\nNationality: <NATIONALITY>\né <NAME> é",
        "plain", "", None,
    ]


def test_entities_of_spans(each):
    line = "Nationality: Indian, Ann Lee, Bob Ray, Ann Lee"
    (found,) = each(en.span_entities(en.all_spans(T)), line)
    assert found == {"person_name": ["Ann Lee", "Bob Ray"], "nationality": ["Indian"]}
    assert each(en.span_entities(en.all_spans(T)), None, "plain") == [{}, {}]


def test_unknown_type_is_masked(spark):
    (row,) = spark.range(1).select(en.placeholder(F.lit("SHOE_SIZE")).alias("p")).collect()
    assert row.p == "<REDACTED>"


def test_threshold_leaves_out_single_months(each):
    (found,) = each(en.all_spans(T), "since Mar 2015")
    assert found == []


def test_detector_names(spark):
    df = spark.createDataFrame([("PERSON_NAME",), ("AGE",)], "t string")
    got = {r.t: r.n for r in df.select("t", en.detector_names(F.col("t")).alias("n")).collect()}
    assert got == {"PERSON_NAME": ["PERSON", "NRP"], "AGE": ["AGE"]}


def test_last_document_with_entities_wins(texts):
    df = texts("Ann Lee a@b.co", "Bob Ray a@b.co", "nothing", None)
    made = df.select(
        "doc_id", tx.resume_id(T).alias("resume_id"), en.entity_map(T).alias("entities")
    )
    rows = en.entities_by_resume(made, "doc_id", "resume_id", "entities").collect()
    assert [(r.doc_id, r.entities["person_name"]) for r in rows] == [(1, ["Bob Ray"])]


def test_resume_id(each):
    ids = each(tx.resume_id(T), "x a@b.co Ann Lee", "y a@b.co", "Ann Lee", "none", None)
    assert ids[0] == ids[1] == "email-" + md5(b"a@b.co").hexdigest()[:8]
    assert ids[2].startswith("name-") and len(ids[2]) == 13
    assert ids[3].startswith("resume-") and len(ids[3]) == 19
    assert ids[4] is None


@pytest.mark.parametrize("method", ["rules", "spans"])
def test_job(spark, texts, tmp_path, method):
    df = texts("Ann Lee a@b.co", "plain", None, "Bob Ray a@b.co").withColumnRenamed("text", "skills")
    report = run_redaction(
        df, str(tmp_path / "out"), str(tmp_path / "entities"), method=method
    )
    rows = {r.doc_id: r for r in report.redacted.collect()}
    assert rows[0].anonymized_content == "<NAME> <EMAIL>"
    assert rows[1].status == "clean" and rows[2].status == "blank"
    assert "skills" not in report.redacted.columns
    assert report.coverage.first() == (1, 4, 25.0)
    assert report.total.first().n_entities == 2
    assert [tuple(r) for r in report.counts.collect()] == [("email_address", 1), ("person_name", 1)]
    written = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert written.columns == ["doc_id", "anonymized_content"] and written.count() == 4
    (stored,) = spark.read.json(str(tmp_path / "entities")).collect()
    assert stored.entities.person_name == ["Bob Ray"]


def test_masks_of_very_many_spans_take_linear_time(spark):
    text = "é a@b.cd Ann Lee " * 32_000
    df = spark.createDataFrame([(text,)], "text string")
    started = time.perf_counter()
    made = en.mask_spans(T, en.resolve_overlaps(en.detect_spans(T, ["EMAIL_ADDRESS", "PERSON_NAME"])))
    rows = df.select(made.alias("out")).collect()
    assert rows[0].out == "é <EMAIL> <NAME> " * 32_000
    assert time.perf_counter() - started < 10


def test_context_words_lift_scores_near_them(each):
    def kept(*values):
        found = en.spans_in_context(F.col("text"), ["EDUCATION_DATES"])
        return each(F.transform(found, lambda s: F.struct(s["text"], s["score"])), *values)

    far = "x " * 40
    got = kept(
        "graduated Mar 2015", "Mar 2015, my DEGREE", "Mar 2015", f"graduated {far} Mar 2015",
        "undergraduated Mar 2015", "graduatedMar 2015", "collegeé Mar 2015", None, "", "school 2010 to 2014",
        "a" * 55 + "schools Mar 2015", "preschool " + "c" * 53 + " Mar 2015", "school " + "b" * 5000 + " Mar 2015 " + "c" * 5000,
    )
    lifted = [("Mar 2015", 0.95)]
    assert [[tuple(s) for s in (spans or [])] for spans in got] == [
        lifted, lifted, [], [], [], [], [], [], [], [("2010 to 2014", 1.0)], [], [], []]


def test_context_takes_part_in_masking(texts):
    df = texts("graduated Mar 2015", "left Mar 2015")
    rows = en.redact_by_spans(df, types=["EDUCATION_DATES"], context=True).orderBy("doc_id").collect()
    assert [r.anonymized_content for r in rows] == ["graduated <EDUCATION_DATES>", "left Mar 2015"]


@pytest.mark.parametrize("text", [
    "١٢٣-٤٥٦-٧٨٩٠ age ٤٢", "Ann\u0001 Lee Ann Lee 2010 to 2014", "Ann Lee\u0002 Bob Ray\u0001", "", None,
    "Jan 2010 May 2011 to 2014 - 2015 - 2016", "xAnn Bob C. Dee", "Age: 42, 41 years old", "Photo: a.jpg.png Photo: b.gif",
])
def test_gates_and_marks_hide_no_match(each, text):
    chain = T
    for rule in select_rules():
        chain = F.regexp_replace(chain, spark_pattern(rule), rule.replacement)
    bare = [F.regexp_extract_all(T, F.lit(spark_pattern(r)), F.lit(r.value)).alias(r.rule_id) for r in select_rules()]
    made = F.struct(en.detect_spans(T).alias("spans"), redact_column(T).alias("out"), chain.alias("chain"), *bare)
    row = each(made, text)[0]
    for rule in select_rules():
        assert [s.text for s in row.spans if s.rule_id == rule.rule_id] == (row[rule.rule_id] or [])
    for span in row.spans:
        assert text[span.start:span.end] == span.text
    assert row.out == row.chain


def test_statistics_read_the_entities_that_the_job_wrote(texts, tmp_path):
    df = texts("Ann Lee a@b.cd", "Bob Ray")
    report = run_redaction(df, str(tmp_path / "r"), str(tmp_path / "e"), content_column="text")
    assert "Aggregate" not in report.entities._jdf.queryExecution().optimizedPlan().toString()
    assert report.total.first().n_entities > 0
    report.close()

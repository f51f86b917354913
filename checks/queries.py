"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import tables as t
from veilrank.catalog import SCORING_TOKENS, TRAIN_TOKENS
from veilrank.functions import text as tx
from veilrank.operators import content, entities, matching, metrics, pairs, ranking, redact
from veilrank.operators import ranks, statistics
from veilrank.plans import matching_job, redaction_job
from veilrank.session import scratch_path, spread
from veilrank.sources import readers, split_csv, writers
from veilrank.streaming import incremental

JD_TEXT = "There the information that is thand on her with the whole ration of en and der"
EMAIL_AND_PHONE = ["EMAIL_ADDRESS", "PHONE_NUMBER"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# --- Sources and sinks -------------------------------------------------------


@query("read_resume_csv")
def _(spark, d):
    docs = t.documents(spark, d).selectExpr("doc_id", "lang AS Category", "text AS Resume")
    path = scratch_path(spark, "csv")
    writers.write_redacted(docs, path)
    return readers.read_resume_csv(spark, path, docs.schema)


@query("read_csv_split")
def _(spark, d):
    docs = t.documents(spark, d).selectExpr("doc_id", "lang AS Category", "text AS Resume")
    path = scratch_path(spark, "one-csv")
    writers.write_redacted(docs, path)
    return split_csv.read_csv_split(spark, path, docs.schema).where("NOT rejected").drop("rejected")


@query("reject_bad_rows")
def _(spark, d):
    docs = t.documents(spark, d)
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    kind = F.col("n_chars") % 3
    cells = [F.col("doc_id").cast("string"), F.col("lang")]
    line = (
        F.when(kind == 0, F.concat_ws(",", *cells, quoted))
        .when(kind == 1, F.concat_ws(",", *cells, quoted, F.lit("extra"), F.lit("")))
        .otherwise(F.concat_ws(",", *cells))
    )
    path = scratch_path(spark, "bad-csv")
    docs.select(line).write.text(path)
    schema = docs.select("doc_id", "lang", "text").schema
    return readers.read_csv_with_rejects(spark, path, schema, header=False)


@query("csv_causes")
def _(spark, d):
    docs = t.documents(spark, d)
    odd = F.col("n_chars") % 4
    number = F.when(odd == 1, F.concat(F.lit("no. "), "n_chars")).otherwise(F.col("n_chars").cast("string"))
    day = F.when(odd == 2, "31-31-2020").otherwise("2020-01-31")
    lines = docs.select(F.concat_ws(",", F.col("doc_id").cast("string"), number, day, "lang"))
    path = scratch_path(spark, "causes-csv")
    lines.write.text(path)
    schema = StructType.fromDDL("doc_id long, n_chars int, day date, lang string")
    good, rejects = readers.read_csv_with_causes(spark, path, schema, header=False)
    told = rejects.select(F.col("record.doc_id").cast("long").alias("doc_id"), "column", "cell", "cause")
    nothing = F.lit(None).cast("string")
    return told.unionByName(good.select("doc_id", nothing.alias("column"), F.col("n_chars").cast("string").alias("cell"),
                                        nothing.alias("cause")))


@query("read_text_docs")
def _(spark, d):
    path = scratch_path(spark, "text")
    crlf = F.regexp_replace("text", "\n", "\r\n")
    items = t.table(spark, d, "benchmark").select("item_id", crlf.alias("value"))
    items.write.partitionBy("item_id").text(path)
    found = readers.read_text_docs(spark, path)
    return found.select(
        F.regexp_extract("path", r"item_id=(\d+)", 1).cast("long").alias("item_id"),
        F.regexp_replace("text", r"\n\z", "").alias("text"),
    )


@query("write_redacted")
def _(spark, d):
    redacted = redact.redact(t.corpus(spark, d))
    path = scratch_path(spark, "redacted")
    writers.write_redacted(redacted, path)
    return readers.read_resume_csv(spark, path, redacted.schema)


def _with_entities(spark, d):
    text = F.col("text")
    return t.corpus(spark, d).select(
        "doc_id", tx.resume_id(text).alias("resume_id"), entities.entity_map(text).alias("entities")
    )


@query("write_entities_json")
def _(spark, d):
    latest = entities.entities_by_resume(_with_entities(spark, d), "doc_id", "resume_id", "entities")
    path = scratch_path(spark, "entities")
    writers.write_entities_json(latest, path)
    schema = "resume_id string, entities map<string,array<string>>"
    stored = spark.read.schema(schema).json(path)
    return stored.select("resume_id", F.explode("entities").alias("entity_type", "texts")).select(
        "resume_id", "entity_type", F.array_join("texts", " | ").alias("texts")
    )


@query("sample_n")
def _(spark, d):
    return ranks.sample_n(t.table(spark, d, "documents").select("doc_id", "text"), 250)


def _entity_line(found):
    """All entities of a map as one text."""
    lines = F.transform(F.map_entries(found), lambda e: F.concat(
        e["key"], F.lit(": "), F.array_join(F.array_sort(e["value"]), " | ")
    ))
    return F.array_join(F.array_sort(lines), "; ")


@query("incremental_redact")
def _(spark, d):
    arrived = scratch_path(spark, "arrived")
    docs = t.corpus(spark, d)
    docs.write.parquet(arrived)
    stream = incremental.stream_parquet(spark, arrived, docs.schema)
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    cores = spark.sparkContext.defaultParallelism
    started = incremental.incremental_redact(stream, out, checkpoint, partitions=cores)
    started.awaitTermination()
    return spark.read.parquet(out).select(
        "doc_id", "anonymized_content", "resume_id", _entity_line(F.col("entities")).alias("entities")
    )


# --- Projections, filters, predicates ---------------------------------------


@query("derive_clean_columns")
def _(spark, d):
    return content.derive_clean_columns(t.categorised(spark, d), "category", "text").select(
        "doc_id", "jd_clean", "resume_clean"
    )


@query("discover_content_columns")
def _(spark, d):
    wide = t.wide_resumes(spark, d)
    return content.filled_cells(wide, content.discover_content_columns(wide))


@query("combine_content")
def _(spark, d):
    wide = t.wide_resumes(spark, d)
    columns = content.discover_content_columns(wide)
    return wide.select("id", content.combine_content(wide, columns).alias("combined_content"))


@query("choose_content")
def _(spark, d):
    docs = t.documents(spark, d).selectExpr("doc_id AS id", "source AS Category", "text AS Resume")
    chosen, column = content.choose_content(docs)
    return chosen.select("id", F.col(column).alias("content"))


@query("blank_guard")
def _(spark, d):
    text = F.col("text")
    guarded = redact.blank_guard(text, tx.scrub(text))
    return t.blank_resumes(spark, d).select("doc_id", guarded.alias("guarded"))


@query("null_audit")
def _(spark, d):
    return content.null_audit(t.wide_resumes(spark, d))


@query("null_audit_events")
def _(spark, d):
    return content.null_audit(t.table(spark, d, "events"))


@query("drop_columns")
def _(spark, d):
    return content.keep_features(_pairs(spark, d), ["jd_clean", "resume_clean"])


@query("preview")
def _(spark, d):
    best = ranking.rank_resumes(t.documents(spark, d), JD_TEXT)
    line = tx.preview_line(F.col("score"), F.col("text"))
    return best.select("doc_id", line.alias("line"))


@query("preview_head")
def _(spark, d):
    return content.preview(t.table(spark, d, "documents").select("doc_id", "lang", "text"), "doc_id")


@query("select_types")
def _(spark, d):
    return entities.extract_entities(t.corpus(spark, d), types=EMAIL_AND_PHONE)


@query("score_threshold")
def _(spark, d):
    spans = entities.above_threshold(entities.detect_spans(F.col("text"), ["EDUCATION_DATES"]))
    found = t.corpus(spark, d).select("doc_id", spans.alias("spans"))
    return entities.explode_spans(found, "doc_id").groupBy("rule_id", "score").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("score_in_context")
def _(spark, d):
    spans = entities.spans_in_context(F.col("text"), ["EDUCATION_DATES", "WORK_DATES"])
    found = t.corpus(spark, d).select("doc_id", spans.alias("spans"))
    return entities.explode_spans(found, "doc_id")


@query("type_mapping")
def _(spark, d):
    spans = entities.detect_spans(F.col("text"))
    rows = entities.explode_spans(t.corpus(spark, d).select("doc_id", spans.alias("spans")), "doc_id")
    counts = rows.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "entity_type", F.explode(entities.detector_names(F.col("entity_type"))).alias("detector"), "n"
    )


# --- Scalar text functions ---------------------------------------------------


def _scalar(name: str, fn) -> None:
    @query(name)
    def _(spark, d):
        return t.corpus(spark, d).select("doc_id", fn(F.col("text")).alias("out"))


for _name in ("lowercase", "scrub_email", "scrub_phone", "scrub", "resume_id"):
    _scalar(_name, getattr(tx, _name))


@query("scrub_conversations")
def _(spark, d):
    turns = spread(t.table(spark, d, "conversations"), "conv_id", "turn")
    return turns.select("conv_id", "turn", tx.scrub(F.col("text")).alias("out"))


@query("argmax_label")
def _(spark, d):
    best = tx.argmax_label(F.col("embedding"))
    return t.table(spark, d, "embeddings").select("vec_id", best.alias("best"))


@query("pair_text")
def _(spark, d):
    clean = content.derive_clean_columns(t.categorised(spark, d), "category", "text")
    joined = tx.pair_text(F.col("jd_clean"), F.col("resume_clean"))
    return clean.select("doc_id", joined.alias("pair_text"))


@query("token_budget")
def _(spark, d):
    sides = t.assigned_jds(spark, d)
    cut = [
        sides.select("doc_id", F.lit(n).alias("budget"),
                     *tx.token_budget(F.col("jd_text"), F.col("text"), n))
        for n in (64, SCORING_TOKENS, TRAIN_TOKENS)
    ]
    return reduce(DataFrame.unionByName, cut)


# --- Redaction ---------------------------------------------------------------

REDACT_KEYS = {
    "redact_person_name": ["PERSON_NAME"],
    "redact_email": ["EMAIL_ADDRESS"],
    "redact_phone": ["PHONE_NUMBER"],
    "redact_social": ["SOCIAL_MEDIA"],
    "redact_birth_date": ["DATE_OF_BIRTH"],
    "redact_gender": ["GENDER"],
    "redact_marital": ["MARITAL_STATUS"],
    "redact_address": ["ADDRESS"],
    "redact_education_dates": ["EDUCATION_DATES"],
    "redact_work_dates": ["WORK_DATES"],
    "redact_company": ["COMPANY_NAME"],
    "redact_school": ["SCHOOL_NAME"],
    "redact_age": ["AGE"],
    "redact_all": None,
    "redact_selected": EMAIL_AND_PHONE,
}


def _redaction(name: str, types) -> None:
    @query(name)
    def _(spark, d):
        return redact.redact(t.corpus(spark, d), types=types)


for _name, _types in REDACT_KEYS.items():
    _redaction(_name, _types)


@query("redact_names_first")
def _(spark, d):
    return redact.redact(t.corpus(spark, d), order="names_first")


# --- Entities and spans ------------------------------------------------------


@query("extract_entities")
def _(spark, d):
    return entities.extract_entities(t.corpus(spark, d))


def _field(name: str, types: list[str], rule_id: str) -> None:
    @query(name)
    def _(spark, d):
        spans = F.filter(
            entities.extra_spans(F.col("text"), types), lambda s: s["rule_id"] == rule_id
        )
        found = t.corpus(spark, d).select("doc_id", spans.alias("spans"))
        return entities.explode_spans(found, "doc_id").drop("rule_id")


_field("extract_dob_gender", ["DATE_OF_BIRTH", "GENDER"], "field_dob_gender")
_field("extract_family", ["FAMILY_INFO"], "field_family")
_field("extract_marital", ["MARITAL_STATUS"], "field_marital")
_field("extract_nationality", ["NATIONALITY"], "field_nationality")
_field("extract_photo", ["PHOTO_REFERENCES"], "field_photo")


def _span_rows(spark, d, spans):
    return entities.explode_spans(t.corpus(spark, d).select("doc_id", spans.alias("spans")), "doc_id")


@query("detect_spans")
def _(spark, d):
    return _span_rows(spark, d, entities.detect_spans(F.col("text")))


@query("merge_extra_spans")
def _(spark, d):
    return _span_rows(spark, d, entities.all_spans(F.col("text")))


@query("resolve_overlaps")
def _(spark, d):
    islands = entities.resolve_overlaps(entities.all_spans(F.col("text")))
    return _span_rows(spark, d, islands).select(
        "doc_id", "start", "end", "label.score", "label.entity_type"
    )


@query("span_entities")
def _(spark, d):
    spans = t.corpus(spark, d).select("doc_id", entities.all_spans(F.col("text")).alias("spans"))
    found = spans.select("doc_id", entities.span_entities(F.col("spans")).alias("entities"))
    rows = entities.explode_map(found, "doc_id")
    return rows.withColumn("texts", F.array_join(F.array_sort("texts"), " | "))


@query("mask_spans")
def _(spark, d):
    return entities.redact_by_spans(t.corpus(spark, d))


@query("entities_by_resume")
def _(spark, d):
    latest = entities.entities_by_resume(_with_entities(spark, d), "doc_id", "resume_id", "entities")
    rows = entities.explode_map(latest, "resume_id", "doc_id")
    return rows.withColumn("texts", F.array_join("texts", " | "))


@query("latest_entities")
def _(spark, d):
    arrived, out = scratch_path(spark, "arrived"), scratch_path(spark, "latest")
    docs = t.corpus(spark, d)
    docs.repartition(6, "doc_id").write.parquet(arrived)
    stream = incremental.stream_parquet(spark, arrived, docs.schema, files_per_batch=2)
    incremental.incremental_entities(stream, out, scratch_path(spark, "latest-state")).awaitTermination()
    rows = entities.explode_map(incremental.latest_entities(spark, out), "resume_id", "doc_id")
    return rows.withColumn("texts", F.array_join("texts", " | "))


@query("redact_with_status")
def _(spark, d):
    made = redaction_job.redaction_table(t.blank_resumes(spark, d), "text", method="rules")
    return made.select("doc_id", "status", "anonymized_content")


# --- Pairs, split, scoring, ranking -------------------------------------------


def _clean(spark, d):
    return content.derive_clean_columns(t.categorised(spark, d), "category", "text").select(
        "doc_id", "category", "jd_clean", "resume_clean"
    )


def _pairs(spark, d):
    return pairs.build_pairs(_clean(spark, d))


def _pair_keys(spark, d):
    return pairs.pair_keys(t.table(spark, d, "documents"))


@query("positive_pairs")
def _(spark, d):
    return pairs.positive_pairs(_clean(spark, d)).drop("category")


@query("negative_pairs")
def _(spark, d):
    return pairs.negative_pairs(_clean(spark, d)).drop("category")


@query("negative_pairs_avoid_self")
def _(spark, d):
    return pairs.negative_pairs(_clean(spark, d), avoid_self=True).drop("category")


@query("build_pairs")
def _(spark, d):
    return _pairs(spark, d).drop("category")


@query("stratified_split")
def _(spark, d):
    split = pairs.stratified_split(_pairs(spark, d), keys=_pair_keys(spark, d))
    return split.drop("category")


def _grouped(spark, d):
    """Pairs split by résumé text, so that copies of one text stay together."""
    copies = _pairs(spark, d).withColumn("text_key", F.md5(F.col("resume_clean").cast("binary")))
    return pairs.grouped_split(copies, "text_key")


@query("grouped_split")
def _(spark, d):
    return _grouped(spark, d).select("pair_id", "text_key", "label", "split")


@query("grouped_leakage_audit")
def _(spark, d):
    return pairs.leakage_audit(_grouped(spark, d), "text_key")


@query("split_summary")
def _(spark, d):
    return pairs.split_summary(pairs.stratified_split(_pair_keys(spark, d)))


@query("false_negative_audit")
def _(spark, d):
    drawn = _pairs(spark, d).withColumn("own_jd", tx.scrub(F.col("category")))
    return pairs.false_negative_audit(drawn, "own_jd")


@query("leakage_audit")
def _(spark, d):
    return pairs.leakage_audit(pairs.stratified_split(_pair_keys(spark, d)))


@query("lexical_score")
def _(spark, d):
    score = ranking.lexical_score(tx.scrub(F.col("jd_text")), tx.scrub(F.col("text")))
    return t.assigned_jds(spark, d).select("doc_id", "item_id", F.round(score, 6).alias("score"))


@query("fit_match_model")
def _(spark, d):
    """What a model has to reach on each part: all rows scored, and better than guessing."""
    found = matching_job.run_matching(t.resumes(spark, d)).metrics
    return found.select("split", "n", (F.col("accuracy") > 0.7).alias("learned"))


@query("score_pairs")
def _(spark, d):
    """Every pair outside training once, with probabilities that add up and their argmax."""
    scored = matching_job.run_matching(t.resumes(spark, d)).scored
    whole = F.abs(F.col("p_match") + F.col("p_mismatch") - 1) < 1e-9
    best = F.col("prediction") == F.when(F.col("p_match") > F.col("p_mismatch"), 1).otherwise(0)
    return scored.select("pair_id", "doc_id", "label", "split", (whole & best).alias("consistent"))


def _length_share(jd, resume):
    """A stand-in for a caller's own scorer."""
    a, b = jd.str.len(), resume.str.len()
    return a / (a + b)


@query("score_pairs_with")
def _(spark, d):
    scored = matching.score_pairs_with(pairs.positive_pairs(_clean(spark, d)), _length_share)
    return scored.select("pair_id", F.round("p_match", 6).alias("p_match"))


@query("rank_by_model")
def _(spark, d):
    resumes = t.resumes(spark, d)
    model = matching_job.run_matching(resumes).model
    best = matching.rank_by_model(model, resumes, "BUILDING")
    right = best.join(resumes.select("doc_id", "category"), "doc_id").where("category = 'BUILDING'")
    return right.agg(F.count(F.lit(1)).alias("n_of_category"))


@query("rank_resumes")
def _(spark, d):
    best = ranking.rank_resumes(t.documents(spark, d), JD_TEXT)
    return best.select("doc_id", F.round("score", 6).alias("score"), "text")


@query("rank_resumes_per_jd")
def _(spark, d):
    return _ranked(spark, d)


@query("rank_resumes_per_jd_shuffled")
def _(spark, d):
    return _ranked(spark, d, broadcast_bytes=0)


def _ranked(spark, d, **options):
    best = ranking.rank_resumes_per_jd(
        t.table(spark, d, "benchmark"), t.documents(spark, d), **options
    )
    return best.withColumn("score", F.round("score", 6))


# --- Metrics -----------------------------------------------------------------


@query("accuracy")
def _(spark, d):
    value = metrics.accuracy(F.col("label"), F.col("prediction"))
    return t.predictions(spark, d).agg(F.round(value, 6).alias("accuracy"))


@query("f1")
def _(spark, d):
    value = metrics.f1(F.col("label"), F.col("prediction"))
    return t.predictions(spark, d).agg(F.round(value, 6).alias("f1"))


@query("confusion")
def _(spark, d):
    return metrics.confusion(t.predictions(spark, d))


@query("log_loss")
def _(spark, d):
    value = metrics.log_loss(F.col("label"), F.col("p_match"))
    return t.predictions(spark, d).agg(F.round(value, 6).alias("log_loss"))


@query("evaluate")
def _(spark, d):
    return metrics.evaluate(t.predictions(spark, d))


# --- Statistics --------------------------------------------------------------


@query("pii_coverage")
def _(spark, d):
    return statistics.pii_coverage(_with_entities(spark, d), "resume_id")


@query("entity_total")
def _(spark, d):
    return statistics.entity_total(_with_entities(spark, d))


@query("entity_counts")
def _(spark, d):
    return statistics.entity_counts(_with_entities(spark, d))


@query("entity_counts_by_resume")
def _(spark, d):
    latest = entities.entities_by_resume(_with_entities(spark, d), "doc_id", "resume_id", "entities")
    return statistics.entity_counts(latest)


@query("row_and_column_counts")
def _(spark, d):
    return content.row_and_column_counts(t.table(spark, d, "documents"), 250)


@query("entity_total_by_resume")
def _(spark, d):
    latest = entities.entities_by_resume(_with_entities(spark, d), "doc_id", "resume_id", "entities")
    return statistics.entity_total(latest)


def _job(spark, table, **options):
    return redaction_job.run_redaction(
        table, scratch_path(spark, "job-redacted"), scratch_path(spark, "job-entities"), **options
    )


@query("redaction_job")
def _(spark, d):
    report = _job(spark, t.corpus(spark, d), content_column="text")
    return report.redacted.select(
        "doc_id", "status", "resume_id", "anonymized_content",
        _entity_line(F.col("entities")).alias("entities"),
    )


@query("redaction_job_statistics")
def _(spark, d):
    """The report's counts, total and coverage after both methods."""
    rows = []
    for method in ("spans", "rules"):
        report = _job(spark, t.corpus(spark, d), content_column="text", method=method)
        counts = report.counts.select(F.col("entity_type").alias("name"), F.col("n_entities").alias("n"))
        total = report.total.select(F.lit("total").alias("name"), F.col("n_entities").alias("n"))
        covered = report.coverage.select(F.lit("covered").alias("name"), F.col("n_with_pii").alias("n"))
        for part in (counts, total, covered):
            rows.append(part.withColumn("method", F.lit(method)))
    return reduce(DataFrame.unionByName, rows)


@query("redaction_job_table")
def _(spark, d):
    """The written table: content columns are gone, the key is no content, the rest is there."""
    report = _job(spark, t.wide_resumes(spark, d).withColumnRenamed("id", "doc_id"))
    return report.redacted.drop("entities", "resume_id")


@query("redact_then_match")
def _(spark, d):
    report = _job(spark, t.resumes(spark, d), content_column="text")
    return matching_job.split_pairs(report.redacted, resume="anonymized_content")

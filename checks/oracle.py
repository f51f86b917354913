"""The SQL twin of every query, for DuckDB.

Written against RE2, whose ``\\b`` knows ASCII letters only.  Where a word boundary decides,
accented letters are wrapped in underscores first: an underscore is a word character to RE2 and
no such rule can match one, so boundaries fall where Unicode puts them.
"""

from __future__ import annotations

from checks.queries import EMAIL_AND_PHONE, JD_TEXT, REDACT_KEYS
from checks.tables import BLANKS_SQL, RESUMES_SQL, WIDE_SQL

ORACLE: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ACCENTED = r"[\x{00C0}-\x{024F}]"


def mark(x: str) -> str:
    return f"regexp_replace({x}, '({_ACCENTED})', '_\\1_', 'g')"


def unmark(x: str) -> str:
    return f"regexp_replace({x}, '_({_ACCENTED})_', '\\1', 'g')"


# --- Fixed values: the rules in RE2 form -------------------------------------
# (id, type, replacement, score, pattern, value group, boundary next to letters decides)

_FM = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
_M3 = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_ORG = "(?:University|College|Institute|School)"
_DOB = r"((?:Date\s+of\s+Birth|DOB|Birth\s+Date)\s*[:(]?\s*)"
_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
_NAME = r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b"

RULES = [
    ("email", "EMAIL_ADDRESS", "<EMAIL>", 0.9, _EMAIL, 0, False),
    ("linkedin", "SOCIAL_MEDIA", "<LINKEDIN>", 0.85, r"linkedin\.com/in/[A-Za-z0-9_-]+", 0, False),
    ("github", "SOCIAL_MEDIA", "<GITHUB>", 0.85, r"github\.com/[A-Za-z0-9_-]+", 0, False),
    ("twitter", "SOCIAL_MEDIA", "<TWITTER>", 0.85, r"twitter\.com/[A-Za-z0-9_-]+", 0, False),
    ("facebook", "SOCIAL_MEDIA", "<FACEBOOK>", 0.85, r"facebook\.com/[A-Za-z0-9_.-]+", 0, False),
    ("dob_dmy", "DATE_OF_BIRTH", r"\1<DOB>", 0.85,
     _DOB + r"(\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})", 2, False),
    ("dob_ymd", "DATE_OF_BIRTH", r"\1<DOB>", 0.85,
     _DOB + r"(\d{4}[-/.]\d{1,2}[-/.]\d{1,2})", 2, False),
    ("dob_text", "DATE_OF_BIRTH", r"\1<DOB>", 0.85,
     _DOB + r"([A-Za-z]+\s+\d{1,2},?\s+\d{4})", 2, False),
    ("gender_field", "GENDER", r"\1<GENDER>", 0.85,
     r"((?:Gender|Sex)\s*[:：]\s*)([^\n,]+)", 2, False),
    ("gender_paren", "GENDER", "(<GENDER>)", 0.7, r"\((?:M|F|Male|Female|男|女)\)", 0, False),
    ("gender_dash", "GENDER", r"\1<GENDER>", 0.85,
     r"(Gender\s*[:-]?\s*)(Male|Female|M|F|男|女)", 2, False),
    ("marital", "MARITAL_STATUS", r"\1<MARITAL_STATUS>", 0.85,
     r"((?:Marital|Marriage)\s+Status\s*[:：]\s*)([^\n,]+)", 2, False),
    ("father", "PERSON_NAME", r"\1<NAME>", 0.8, r"(Father'?s Name\s*[:：]\s*)([^\n,]+)", 2, False),
    ("mother", "PERSON_NAME", r"\1<NAME>", 0.8, r"(Mother'?s Name\s*[:：]\s*)([^\n,]+)", 2, False),
    ("addr_label", "ADDRESS", r"\1<ADDRESS>", 0.7,
     r"((?:Address|Location)\s*[:：]\s*)([^\n]+)", 2, False),
    ("addr_unit", "ADDRESS", "<ADDRESS>", 0.7,
     r"\b\d+/[A-Za-z0-9],?\s+[A-Za-z0-9\s,]+,\s+[A-Za-z\s]+,\s+[A-Za-z][A-Za-z \t]*\b",
     0, True),
    ("addr_street", "ADDRESS", "<ADDRESS>", 0.7,
     r"\b\d+\s+[A-Za-z0-9\s,]+(?:Street|Avenue|Road|Blvd|Drive|Lane|Place|Way|Apt|Suite"
     r"|St|Rd|Dr|Ave)\b", 0, True),
    ("edu_month_range", "EDUCATION_DATES", "<EDUCATION_DATES>", 0.75,
     _FM + r"\s+\d{4}\s+to\s+" + _FM + r"\s+\d{4}", 0, False),
    ("edu_year_to", "EDUCATION_DATES", "<EDUCATION_DATES>", 0.7,
     r"\b(?:19|20)\d{2}\s+to\s+(?:19|20)\d{2}\b", 0, True),
    ("edu_year_dash", "EDUCATION_DATES", "<EDUCATION_DATES>", 0.7,
     r"\b(?:19|20)\d{2}\s*[-–]\s*(?:19|20)\d{2}\b", 0, True),
    ("edu_month", "EDUCATION_DATES", "<DATE>", 0.6, r"\b" + _M3 + r"[a-z]*\s+\d{4}\b", 0, True),
    ("work_month_range", "WORK_DATES", "<WORK_DATES>", 0.75,
     _FM + r"\s+\d{4}\s+to\s+" + _FM + r"\s+\d{4}", 0, False),
    ("work_year_range", "WORK_DATES", "<WORK_DATES>", 0.7,
     r"\b(?:19|20)\d{2}(?:\s+to\s+|\s*[-–]\s*)(?:19|20)\d{2}\b", 0, True),
    ("work_present", "WORK_DATES", "<WORK_DATES>", 0.7, r"\b[Pp]resent\b", 0, True),
    ("phone_digits", "PHONE_NUMBER", "<PHONE>", 0.85,
     r"\b(?:\+\d{1,3}[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?){1,2}\d{3,4}[-.\s]?\d{3,4}\b", 0, True),
    ("phone_label", "PHONE_NUMBER", r"\1<PHONE>", 0.85,
     r"((?:Phone|Tel|Mobile|Contact)\s*(?:Number|No|#|:)?\s*[:：]?\s*)"
     r"(\+?[\d(][\d \t().-]{5,}[\d)])", 2, False),
    ("worked_at", "COMPANY_NAME", r"\1<COMPANY>", 0.7,
     r"([Ww]orked\s+(?:at|for|with)\s+)([A-Z][A-Za-z0-9\s&,.]+?"
     r"(?:Inc|LLC|Ltd|Limited|Corp|Corporation|Co|Company)\b)", 2, True),
    ("employer", "COMPANY_NAME", r"\1<COMPANY>", 0.8,
     r"([Ee]mployer\s*[:：]\s*)([^\n,]+)", 2, False),
    ("company", "COMPANY_NAME", r"\1<COMPANY>", 0.7,
     r"([Cc]ompany(?:\s+[Nn]ame)?\s*[-:：]?\s*)([^\n,]+)", 2, False),
    ("school_of", "SCHOOL_NAME", r"\1<SCHOOL>", 0.7,
     "(" + _ORG + r"\s+of\s+)([^\n,]+)", 2, False),
    ("school_label", "SCHOOL_NAME", r"\1<SCHOOL>", 0.7,
     "(" + _ORG + r"\s*[:：]\s*)([^\n,]+)", 2, False),
    ("school_named", "SCHOOL_NAME", "<SCHOOL>", 0.7,
     r"\b(?:[A-Z][a-z]+\s+)+" + _ORG + r"\b", 0, True),
    ("age_label", "AGE", r"\1<AGE>", 0.8, r"((?:Age|Years)\s*[:：]\s*)(\d{1,2})", 2, False),
    ("age_old", "AGE", r"<AGE>\2", 0.8, r"(\d{1,2})(\s+[Yy]ears\s+[Oo]ld)", 1, False),
    ("age_any", "AGE", r"\1<AGE>", 0.8, r"(\b[Aa]ge[:：]?\s*)(\d{1,2})", 2, True),
    ("name_middle", "PERSON_NAME", "<NAME>", 0.7,
     r"\b[A-Z][a-z]+\s+[A-Z][a-z]*\.\s+[A-Z][a-z]+\b", 0, True),
    ("name_two", "PERSON_NAME", "<NAME>", 0.7, _NAME, 0, True),
]

NAMES_FIRST = [
    "name_two", "name_middle", "father", "mother", "email", "phone_digits", "phone_label",
    "linkedin", "github", "twitter", "facebook", "dob_dmy", "dob_ymd", "dob_text",
    "gender_field", "gender_paren", "gender_dash", "marital", "addr_street", "addr_label",
    "addr_unit", "edu_month_range", "edu_year_to", "edu_year_dash", "edu_month",
    "work_month_range", "work_year_range", "work_present", "company", "employer", "worked_at",
    "school_of", "school_label", "school_named", "age_label", "age_old", "age_any",
]

# (pattern, value groups with their types, score)
FIELDS = {
    "dob_gender": (
        r"(Date\s+of\s+Birth\s*\(\s*Gender\s*\)\s*:\s*)(\d{4}-\d{2}-\d{2})(\s*\(\s*)([MF])\s*\)",
        ((2, "DATE_OF_BIRTH"), (4, "GENDER")), 0.9),
    "family": (r"((?:Father|Mother)'?s\s+Name\s*[:：]\s*)([^\n]+)", ((2, "FAMILY_INFO"),), 0.85),
    "marital": (r"(Marital\s+Status\s*[:：]\s*)([^\n,]+)", ((2, "MARITAL_STATUS"),), 0.85),
    "nationality": (r"(Nationality\s*[:：]\s*)([^\n,]+)", ((2, "NATIONALITY"),), 0.85),
    "photo": (r"((?:Photo|Picture|Image)\s*[:：]?\s*)([^\n]+\.(?:jpg|jpeg|png|gif))",
              ((2, "PHOTO_REFERENCES"),), 0.8),
}

# --- Building blocks ----------------------------------------------------------


def rules_of(types) -> list:
    return [r for r in RULES if types is None or r[1] in types]


def fold(x: str, rules: list) -> str:
    for _, _, replacement, _, pattern, _, boundary in rules:
        source = mark(x) if boundary else x
        x = f"regexp_replace({source}, {q(pattern)}, {q(replacement)}, 'g')"
        if boundary:
            x = unmark(x)
    return x


def scrub_email(x: str) -> str:
    return f"regexp_replace({x}, '\\S+@\\S+', '<EMAIL>', 'g')"


def scrub_phone(x: str) -> str:
    return unmark(f"regexp_replace({mark(x)}, '\\b[0-9]{{10,}}\\b', '<PHONE>', 'g')")


def scrub(x: str) -> str:
    return scrub_phone(scrub_email(f"lower({x})"))


def blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '\\s*'))"


def resume_id(x: str) -> str:
    m = mark(x)
    return f"""CASE
      WHEN regexp_matches({x}, {q(_EMAIL)})
        THEN 'email-' || substr(md5(regexp_extract({x}, {q(_EMAIL)})), 1, 8)
      WHEN regexp_matches({m}, {q(_NAME)})
        THEN 'name-' || substr(md5(regexp_extract({m}, {q(_NAME)})), 1, 8)
      ELSE 'resume-' || substr(md5({x}), 1, 12) END"""


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+')"


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"


def score(jd: str, resume: str) -> str:
    wanted = f"list_distinct({words(jd)})"
    return (
        f"coalesce(CAST(len(list_intersect({wanted}, list_distinct({words(resume)}))) AS DOUBLE)"
        f" / nullif(len({wanted}), 0), 0.0)"
    )


CORPUS = f"""corpus AS MATERIALIZED (
  SELECT doc_id, text FROM documents
  UNION ALL SELECT -1 - doc_id, text FROM ({RESUMES_SQL}))"""


def entities_cte(types=None) -> str:
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {q(t.lower())} AS entity_type, {n} AS r,
          unnest(generate_series(1, len(l))) AS i, unnest(l) AS entity_text
        FROM (SELECT doc_id, regexp_extract_all(
          {mark('text') if boundary else 'text'}, {q(p)}, {g}) AS l FROM corpus)"""
        for n, (_, t, _, _, p, g, boundary) in enumerate(RULES)
        if types is None or t in types
    )
    return f"""{CORPUS},
    found AS ({found}),
    entities AS MATERIALIZED (
      SELECT doc_id, entity_type, entity_text,
        CAST(row_number() OVER (PARTITION BY doc_id, entity_type ORDER BY min(r * 1000000 + i)) - 1
          AS INTEGER) AS ord
      FROM found GROUP BY doc_id, entity_type, entity_text)"""


IDS = f"ids AS MATERIALIZED (SELECT doc_id, {resume_id('text')} AS resume_id FROM corpus)"
LATEST = f"""{entities_cte()}, {IDS},
  latest AS (SELECT resume_id, max(doc_id) AS doc_id FROM ids
    WHERE doc_id IN (SELECT doc_id FROM entities) GROUP BY resume_id)"""


def rule_spans(types=None) -> str:
    parts = []
    for rid, t, _, s, p, g, boundary in rules_of(types):
        src = mark("text") if boundary else "text"
        size = f"length({unmark('x')})" if boundary else "length(x)"
        shift = "length(v[i])" if g == 1 else "length(m[i])"
        begin = f"""coalesce(list_sum(list_transform(gaps[1:i], lambda x: {size})), 0)
          + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"""
        parts.append(
            f"""SELECT doc_id, CAST(stop - length(v[i]) AS INTEGER) AS "start",
              CAST(stop AS INTEGER) AS "end", CAST({s} AS DOUBLE) AS score,
              '{t}' AS entity_type, v[i] AS text, '{rid}' AS rule_id
            FROM (SELECT doc_id, m, v, i, {begin} + {shift} AS stop
              FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM (
                SELECT doc_id, string_split_regex({src}, {q(p)}) AS gaps,
                  regexp_extract_all({src}, {q(p)}, 0) AS m,
                  regexp_extract_all({src}, {q(p)}, {g}) AS v FROM corpus)))"""
        )
    return "\nUNION ALL ".join(parts)


def field_spans(field_ids=None) -> str:
    parts = []
    for fid, (p, values, s) in FIELDS.items():
        if field_ids is not None and fid not in field_ids:
            continue
        for g, t in values:
            value = f"regexp_replace(regexp_extract(text, {q(p)}, {g}), '\\s+$', '')"
            lead = " + ".join(f"length(regexp_extract(text, {q(p)}, {n}))" for n in range(1, g))
            parts.append(
                f"""SELECT doc_id, CAST(b AS INTEGER) AS "start",
                  CAST(b + length(value) AS INTEGER) AS "end", CAST({s} AS DOUBLE) AS score,
                  '{t}' AS entity_type, value AS text, 'field_{fid}' AS rule_id
                FROM (SELECT doc_id, {value} AS value,
                    length(string_split_regex(text, {q(p)})[1]) + {lead} AS b
                  FROM corpus WHERE regexp_matches(text, {q(p)}))
                WHERE length(value) > 0"""
            )
    return "\nUNION ALL ".join(parts)


ALL_SPANS = f"""{CORPUS},
  spans AS MATERIALIZED (SELECT * FROM ({rule_spans()}) WHERE score >= 0.65
    UNION ALL {field_spans()})"""

ISLANDS = f"""{ALL_SPANS},
  ordered AS (SELECT *, max("end") OVER (PARTITION BY doc_id
      ORDER BY "start", "end", score, entity_type, text, rule_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
  numbered AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" >= reach THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY "start", "end", score, entity_type, text, rule_id
      ROWS UNBOUNDED PRECEDING) AS island FROM ordered),
  graded AS (SELECT *, row_number() OVER (PARTITION BY doc_id, island
      ORDER BY score DESC, "end" - "start" DESC, entity_type DESC) AS place FROM numbered),
  islands AS MATERIALIZED (SELECT doc_id, min("start") AS "start", max("end") AS "end",
      max(CASE WHEN place = 1 THEN score END) AS score,
      max(CASE WHEN place = 1 THEN entity_type END) AS entity_type
    FROM graded GROUP BY doc_id, island)"""

_PLACEHOLDER = """CASE entity_type WHEN 'PERSON_NAME' THEN '<NAME>' WHEN 'EMAIL_ADDRESS' THEN '<EMAIL>'
  WHEN 'PHONE_NUMBER' THEN '<PHONE>' WHEN 'DATE_OF_BIRTH' THEN '<DOB>'
  WHEN 'PHOTO_REFERENCES' THEN '<PHOTO>' WHEN 'COMPANY_NAME' THEN '<COMPANY>'
  WHEN 'SCHOOL_NAME' THEN '<SCHOOL>' ELSE '<' || entity_type || '>' END"""

MASKED = f"""{ISLANDS},
  pieces AS (SELECT doc_id, "start", "end", {_PLACEHOLDER} AS p,
      coalesce(lag("end") OVER (PARTITION BY doc_id ORDER BY "start"), 0) AS prev FROM islands),
  built AS (SELECT doc_id, max("end") AS last,
      string_agg(substr(text, prev + 1, "start" - prev) || p, '' ORDER BY "start") AS head
    FROM pieces JOIN corpus USING (doc_id) GROUP BY doc_id),
  masked AS (SELECT doc_id, text,
      CASE WHEN head IS NULL THEN text ELSE head || substr(text, last + 1) END AS anonymized_content
    FROM corpus LEFT JOIN built USING (doc_id))"""

# --- Sources and sinks ----------------------------------------------------------

ORACLE["read_resume_csv"] = """SELECT doc_id, lang AS "Category", text AS "Resume" FROM documents"""
ORACLE["read_csv_split"] = ORACLE["read_resume_csv"]
ORACLE["reject_bad_rows"] = """
SELECT doc_id, lang, CASE WHEN n_chars % 3 < 2 THEN text END AS text,
  n_chars % 3 = 1 AS rejected FROM documents"""
ORACLE["csv_causes"] = """
SELECT doc_id, CASE n_chars % 4 WHEN 1 THEN 'n_chars' WHEN 2 THEN 'day' END AS column,
  CASE n_chars % 4 WHEN 1 THEN 'no. ' || n_chars WHEN 2 THEN '31-31-2020' ELSE n_chars::VARCHAR END AS cell,
  CASE n_chars % 4 WHEN 1 THEN 'not a int' WHEN 2 THEN 'not a date' END AS cause FROM documents"""
ORACLE["read_text_docs"] = "SELECT item_id, text FROM benchmark"
_REDACTED = f"""WITH {CORPUS}
SELECT doc_id, {{}} AS anonymized_content FROM corpus"""
ORACLE["write_redacted"] = _REDACTED.format(fold("text", RULES))
ORACLE["write_entities_json"] = f"""WITH {LATEST}
SELECT resume_id, entity_type, string_agg(entity_text, ' | ' ORDER BY ord) AS texts
FROM latest JOIN entities USING (doc_id) GROUP BY resume_id, entity_type"""
ORACLE["sample_n"] = """SELECT doc_id, text FROM documents
ORDER BY md5('42:' || doc_id), doc_id LIMIT 250"""
# All entities of a document as one text.
ENTITY_LINES = """lines AS (SELECT doc_id, string_agg(line, '; ' ORDER BY line) AS entities FROM (
    SELECT doc_id, lower(entity_type) || ': ' || string_agg(DISTINCT text, ' | ' ORDER BY text) AS line
    FROM spans GROUP BY doc_id, entity_type) GROUP BY doc_id)"""
ORACLE["incremental_redact"] = f"""WITH {MASKED}, {ENTITY_LINES}
SELECT doc_id, anonymized_content, {resume_id('text')} AS resume_id,
  coalesce(entities, '') AS entities FROM masked LEFT JOIN lines USING (doc_id)"""

# --- Projections, filters, predicates ---------------------------------------------

ORACLE["derive_clean_columns"] = f"""
SELECT doc_id, {scrub('source')} AS jd_clean, {scrub('text')} AS resume_clean FROM documents"""
_CONTENT = ("job_description", "skill_details", "education", "company_code")
_AS_TEXT = {c: f"CAST({c} AS VARCHAR)" for c in _CONTENT}
ORACLE["discover_content_columns"] = f"WITH wide AS ({WIDE_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (NOT {blank(x)}) AS n_filled FROM wide"
    for c, x in _AS_TEXT.items()
)
ORACLE["combine_content"] = f"""WITH wide AS ({WIDE_SQL})
SELECT id, concat_ws(chr(10) || chr(10), {', '.join(
    f'CASE WHEN NOT {blank(x)} THEN {x} END' for x in _AS_TEXT.values())}) AS combined_content
FROM wide"""
ORACLE["choose_content"] = f"""
SELECT doc_id AS id, concat_ws(chr(10) || chr(10), CASE WHEN NOT {blank('source')} THEN source END,
  CASE WHEN NOT {blank('text')} THEN text END) AS content FROM documents"""
ORACLE["blank_guard"] = f"""WITH b AS ({BLANKS_SQL})
SELECT doc_id, CASE WHEN {blank('text')} THEN text ELSE {scrub('text')} END AS guarded FROM b"""


def _nulls(source: str, columns: tuple[str, ...]) -> str:
    return f"WITH s AS ({source}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM s"
        for c in columns
    )


ORACLE["null_audit"] = _nulls(WIDE_SQL, ("id", *_CONTENT, "note"))
ORACLE["null_audit_events"] = _nulls(
    "SELECT * FROM events", ("event_id", "ts", "user_id", "event_type", "value", "props")
)
ORACLE["preview"] = f"""WITH best AS (
  SELECT doc_id, {score(scrub(q(JD_TEXT)), scrub('text'))} AS score, text FROM documents
  ORDER BY score DESC, text DESC, doc_id LIMIT 5)
SELECT doc_id, printf('%.4f | %s…', score, substr(text, 1, 80)) AS line FROM best"""
ORACLE["preview_head"] = "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 5"
ORACLE["select_types"] = f"""WITH {entities_cte(EMAIL_AND_PHONE)}
SELECT doc_id, entity_type, ord, entity_text FROM entities"""
ORACLE["score_threshold"] = f"""WITH {CORPUS}
SELECT rule_id, score, count(*) AS n FROM ({rule_spans(['EDUCATION_DATES'])})
WHERE score >= 0.65 GROUP BY rule_id, score"""
_NEAR_WORDS = {
    "EDUCATION_DATES": "education|university|college|school|degree|graduated",
    "WORK_DATES": "experience|work|job|company|employment",
}
_NEAR = " OR ".join(
    f"(entity_type = '{t}' AND regexp_matches(around, '(?i)(^|[^\\w~])({w})([^\\w~]|$)'))" for t, w in _NEAR_WORDS.items()
)
ORACLE["score_in_context"] = f"""WITH {CORPUS},
  found AS (SELECT s.*, corpus.text AS whole FROM ({rule_spans(list(_NEAR_WORDS))}) s JOIN corpus USING (doc_id)),
  near AS (SELECT *, CASE WHEN "start" > 60 THEN '~' ELSE '' END
      || substr(whole, greatest("start" - 60, 0) + 1, least("start", 60)) || '~ ~' || substr(whole, "end" + 1, 60)
      || CASE WHEN "end" + 60 < length(whole) THEN '~' ELSE '' END AS around FROM found),
  lifted AS (SELECT * REPLACE (CASE WHEN {_NEAR} THEN least(round(score + 0.35, 6), 1.0) ELSE score END AS score)
    FROM near)
SELECT doc_id, "start", "end", CAST(score AS DOUBLE) AS score, entity_type, text, rule_id
FROM lifted WHERE score >= 0.65"""
ORACLE["type_mapping"] = f"""WITH {CORPUS},
  counts AS (SELECT entity_type, count(*) AS n FROM ({rule_spans()}) GROUP BY entity_type)
SELECT entity_type, unnest(CASE WHEN entity_type = 'PERSON_NAME' THEN ['PERSON', 'NRP']
  ELSE [entity_type] END) AS detector, n FROM counts"""

# --- Scalar text functions ----------------------------------------------------------

for _name, _sql in {
    "lowercase": "lower(text)",
    "scrub_email": scrub_email("text"),
    "scrub_phone": scrub_phone("text"),
    "scrub": scrub("text"),
    "resume_id": resume_id("text"),
}.items():
    ORACLE[_name] = f"WITH {CORPUS} SELECT doc_id, {_sql} AS out FROM corpus"
ORACLE["scrub_conversations"] = f"SELECT conv_id, turn, {scrub('text')} AS out FROM conversations"
ORACLE["argmax_label"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best
FROM embeddings"""
ORACLE["pair_text"] = f"""
SELECT doc_id, {scrub('source')} || '</s>' || {scrub('text')} AS pair_text FROM documents"""
_ASSIGNED = """assigned AS (SELECT doc_id, d.text, item_id, b.text AS jd_text
  FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id)"""
ORACLE["token_budget"] = f"""WITH {_ASSIGNED},
  sides AS (SELECT doc_id, {tokens('jd_text')} AS a, {tokens('text')} AS b,
    unnest([64, 512, 1536]) AS budget FROM assigned),
  kept AS (SELECT *, least(len(a), greatest(budget - len(b), (budget + 1) // 2)) AS ka FROM sides)
SELECT doc_id, CAST(budget AS INTEGER) AS budget, array_to_string(a[1:ka], ' ') AS jd_cut,
  array_to_string(b[1:least(len(b), budget - ka)], ' ') AS resume_cut FROM kept"""

# --- Redaction --------------------------------------------------------------------

for _name, _types in REDACT_KEYS.items():
    ORACLE[_name] = _REDACTED.format(fold("text", rules_of(_types)))
_BY_ID = {r[0]: r for r in RULES}
ORACLE["redact_names_first"] = _REDACTED.format(fold("text", [_BY_ID[n] for n in NAMES_FIRST]))

# --- Entities and spans -------------------------------------------------------------

ORACLE["extract_entities"] = f"""WITH {entities_cte()}
SELECT doc_id, entity_type, ord, entity_text FROM entities"""
for _field in FIELDS:
    _key = "extract_" + _field
    ORACLE[_key] = f"""WITH {CORPUS}
    SELECT doc_id, "start", "end", score, entity_type, text FROM ({field_spans([_field])})"""
ORACLE["detect_spans"] = f"WITH {CORPUS} SELECT * FROM ({rule_spans()})"
ORACLE["merge_extra_spans"] = f"WITH {ALL_SPANS} SELECT * FROM spans"
ORACLE["resolve_overlaps"] = f"WITH {ISLANDS} SELECT * FROM islands"
ORACLE["span_entities"] = f"""WITH {ALL_SPANS}
SELECT doc_id, lower(entity_type) AS entity_type,
  string_agg(DISTINCT text, ' | ' ORDER BY text) AS texts
FROM spans GROUP BY doc_id, entity_type"""
ORACLE["mask_spans"] = f"WITH {MASKED} SELECT doc_id, anonymized_content FROM masked"
ORACLE["entities_by_resume"] = f"""WITH {LATEST}
SELECT resume_id, doc_id, entity_type, string_agg(entity_text, ' | ' ORDER BY ord) AS texts
FROM latest JOIN entities USING (doc_id) GROUP BY resume_id, doc_id, entity_type"""
ORACLE["latest_entities"] = ORACLE["entities_by_resume"]
ORACLE["redact_with_status"] = f"""WITH b AS ({BLANKS_SQL}),
  r AS (SELECT doc_id, text, {fold('text', RULES)} AS anonymized_content FROM b)
SELECT doc_id, anonymized_content, CASE WHEN {blank('text')} THEN 'blank'
  WHEN anonymized_content = text THEN 'clean' ELSE 'redacted' END AS status FROM r"""

# --- Pairs, split, scoring, ranking -----------------------------------------------------

CLEAN = f"""clean AS MATERIALIZED (SELECT doc_id, source AS category,
  {scrub('source')} AS jd_clean, {scrub('text')} AS resume_clean FROM documents)"""
NEGATIVES = f"""{CLEAN},
  giving AS (SELECT jd_clean, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r
    FROM clean),
  taking AS (SELECT doc_id, row_number() OVER (ORDER BY md5('43:' || doc_id), doc_id) AS r
    FROM clean),
  negatives AS (SELECT doc_id || ':0' AS pair_id, doc_id, c.category, g.jd_clean, c.resume_clean,
      0 AS label
    FROM clean c JOIN taking t USING (doc_id) JOIN giving g USING (r))"""
PAIRS = f"""{NEGATIVES},
  pairs AS (SELECT * FROM negatives UNION ALL
    SELECT doc_id || ':1', doc_id, category, jd_clean, resume_clean, 1 FROM clean)"""
SPLIT = """placed AS (SELECT *,
    row_number() OVER (PARTITION BY label ORDER BY md5('42:' || pair_id), pair_id) AS r,
    count(*) OVER (PARTITION BY label) AS n FROM pairs),
  split AS (SELECT * EXCLUDE (r, n), CASE WHEN r <= n * 70 // 100 THEN 'train'
    WHEN r <= n * 85 // 100 THEN 'val' ELSE 'test' END AS split FROM placed)"""

ORACLE["drop_columns"] = f"WITH {PAIRS} SELECT label, jd_clean, resume_clean FROM pairs"
ORACLE["positive_pairs"] = f"""WITH {CLEAN}
SELECT doc_id, doc_id || ':1' AS pair_id, jd_clean, resume_clean, 1 AS label FROM clean"""
ORACLE["negative_pairs"] = f"WITH {NEGATIVES} SELECT * EXCLUDE (category) FROM negatives"
ORACLE["negative_pairs_avoid_self"] = f"""WITH {CLEAN},
  ranked AS (SELECT doc_id, jd_clean,
    row_number() OVER (ORDER BY md5('42:' || jd_clean), jd_clean, md5('42:' || doc_id), doc_id) AS r
    FROM clean),
  sizes AS (SELECT max(n) AS shift, CAST(sum(n) AS BIGINT) AS total
    FROM (SELECT count(*) AS n FROM clean GROUP BY jd_clean))
SELECT c.doc_id, c.doc_id || ':0' AS pair_id, g.jd_clean, c.resume_clean, 0 AS label
FROM clean c JOIN ranked t USING (doc_id)
  JOIN ranked g ON g.r = (t.r - 1 + (SELECT shift FROM sizes)) % (SELECT total FROM sizes) + 1"""
ORACLE["build_pairs"] = f"WITH {PAIRS} SELECT * EXCLUDE (category) FROM pairs"
ORACLE["stratified_split"] = f"WITH {PAIRS}, {SPLIT} SELECT * EXCLUDE (category) FROM split"
ORACLE["split_summary"] = f"""WITH {PAIRS}, {SPLIT}
SELECT split, label, count(*) AS n FROM split GROUP BY split, label"""
ORACLE["false_negative_audit"] = f"""WITH {NEGATIVES}
SELECT count(*) AS n_negatives,
  count(*) FILTER (jd_clean = {scrub('category')}) AS n_false_negatives FROM negatives"""
ORACLE["leakage_audit"] = f"""WITH {PAIRS}, {SPLIT}
SELECT DISTINCT doc_id FROM split WHERE split = 'train'
  AND doc_id IN (SELECT doc_id FROM split WHERE split = 'test')"""
# Histograms of up to 15 pairs of a label, above that by powers of two.
_KIND = ", ".join(f"CASE WHEN n{i} < 16 THEN n{i} ELSE floor(log2(n{i}))::BIGINT + 16 END" for i in (0, 1))
GROUPED = f"""keyed AS (SELECT pair_id, md5(resume_clean) AS text_key, label FROM pairs),
  sizes AS (SELECT text_key, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1
    FROM keyed GROUP BY text_key),
  kinds AS (SELECT text_key, concat_ws(',', {_KIND}) AS kind FROM sizes),
  lined AS (SELECT text_key, row_number() OVER (PARTITION BY kind ORDER BY md5('42:' || text_key), text_key) AS r,
    count(*) OVER (PARTITION BY kind) AS n, ('0x' || substr(md5(kind), 1, 4))::INTEGER / 65536.0 AS odd FROM kinds),
  grouped AS (SELECT pair_id, text_key, label, CASE WHEN r <= floor(n * 70 / 100 + odd) THEN 'train'
    WHEN r <= floor(n * 85 / 100 + odd) THEN 'val' ELSE 'test' END AS split FROM keyed JOIN lined USING (text_key))"""
ORACLE["grouped_split"] = f"WITH {PAIRS}, {GROUPED} SELECT * FROM grouped"
ORACLE["grouped_leakage_audit"] = f"""WITH {PAIRS}, {GROUPED}
SELECT DISTINCT text_key FROM grouped WHERE split = 'train'
  AND text_key IN (SELECT text_key FROM grouped WHERE split = 'test')"""
ORACLE["lexical_score"] = f"""WITH {_ASSIGNED}
SELECT doc_id, item_id, round({score(scrub('jd_text'), scrub('text'))}, 6) AS score FROM assigned"""
ORACLE["score_pairs_with"] = f"""WITH {CLEAN}
SELECT doc_id || ':1' AS pair_id, round(CAST(length(jd_clean) AS DOUBLE)
  / (length(jd_clean) + length(resume_clean)), 6) AS p_match FROM clean"""
ORACLE["rank_resumes"] = f"""WITH best AS (
  SELECT doc_id, {score(scrub(q(JD_TEXT)), scrub('text'))} AS score, text FROM documents
  ORDER BY score DESC, text DESC, doc_id LIMIT 5)
SELECT doc_id, round(score, 6) AS score, text FROM best"""
ORACLE["rank_resumes_per_jd"] = f"""WITH
  j AS MATERIALIZED (SELECT item_id, list_distinct({words(scrub('text'))}) AS w FROM benchmark),
  d AS MATERIALIZED (SELECT doc_id, list_distinct({words(scrub('text'))}) AS w FROM documents),
  scored AS (SELECT item_id, doc_id,
    coalesce(CAST(len(list_intersect(j.w, d.w)) AS DOUBLE) / nullif(len(j.w), 0), 0.0) AS score
    FROM j, d),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id
    ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored)
SELECT item_id, doc_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 5"""
ORACLE["rank_resumes_per_jd_shuffled"] = ORACLE["rank_resumes_per_jd"]

# --- Metrics ------------------------------------------------------------------------------

PREDICTIONS = f"""scored AS (SELECT doc_id, {words('lower(text)')} AS w FROM documents),
  predictions AS (SELECT quality AS label, coalesce(
      CAST(len(list_distinct(w)) AS DOUBLE) / nullif(len(w), 0), 0.0) AS p
    FROM labels JOIN scored USING (doc_id)),
  cells AS (SELECT count(*) AS n, count(*) FILTER (label = 1 AND p >= 0.5) AS tp,
      count(*) FILTER (label = 0 AND p >= 0.5) AS fp,
      count(*) FILTER (label = 1 AND p < 0.5) AS fn,
      count(*) FILTER (label = 0 AND p < 0.5) AS tn,
      avg(-ln(greatest(least(CASE WHEN label = 1 THEN p ELSE 1 - p END, 1 - 1e-7), 1e-7))) AS loss
    FROM predictions)"""
_ACC = "round(CAST(tp + tn AS DOUBLE) / n, 6) AS accuracy"
_F1 = "round(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 6) AS f1"
_LOSS = "round(loss, 6) AS log_loss"
for _name, _sql in {
    "accuracy": _ACC,
    "f1": _F1,
    "confusion": "tp, fp, fn, tn",
    "log_loss": _LOSS,
    "evaluate": f"n, {_ACC}, {_F1}, {_LOSS}",
}.items():
    ORACLE[_name] = f"WITH {PREDICTIONS} SELECT {_sql} FROM cells"

# --- Statistics ----------------------------------------------------------------------------

ORACLE["pii_coverage"] = f"""WITH {entities_cte()}, {IDS},
  c AS (SELECT count(DISTINCT resume_id) FILTER (doc_id IN (SELECT doc_id FROM entities))
    AS n_with_pii, count(*) AS n_rows FROM ids)
SELECT n_with_pii, n_rows, round(n_with_pii * 100.0::DOUBLE / nullif(n_rows, 0), 2) AS pct_with_pii
FROM c"""
ORACLE["entity_total"] = f"WITH {entities_cte()} SELECT count(*) AS n_entities FROM entities"
ORACLE["entity_counts"] = f"""WITH {entities_cte()}
SELECT entity_type, count(*) AS n_entities FROM entities GROUP BY entity_type"""
ORACLE["entity_counts_by_resume"] = f"""WITH {LATEST}
SELECT entity_type, count(*) AS n_entities FROM latest JOIN entities USING (doc_id)
GROUP BY entity_type"""
ORACLE["row_and_column_counts"] = """
SELECT count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE SELECT * FROM documents)) AS n_columns,
  least(count(*), 250) AS n_sampled FROM documents"""
_STATUS = f"""CASE WHEN {blank('text')} THEN 'blank' WHEN anonymized_content = text THEN 'clean'
    ELSE 'redacted' END AS status"""
ORACLE["redaction_job"] = f"""WITH {MASKED}, {ENTITY_LINES}
SELECT doc_id, {resume_id('text')} AS resume_id, anonymized_content, {_STATUS},
  coalesce(entities, '') AS entities FROM masked LEFT JOIN lines USING (doc_id)"""
ORACLE["entity_total_by_resume"] = f"""WITH {LATEST}
SELECT count(*) AS n_entities FROM latest JOIN entities USING (doc_id)"""


def _statistics(method: str, found: str) -> str:
    return f"""SELECT '{method}' AS method, name, n FROM (
      WITH kept AS (SELECT resume_id, max(doc_id) AS doc_id FROM ids
          WHERE doc_id IN (SELECT doc_id FROM {found}) GROUP BY resume_id),
        own AS (SELECT * FROM {found} JOIN kept USING (doc_id))
      SELECT entity_type AS name, count(*) AS n FROM own GROUP BY entity_type
      UNION ALL SELECT 'total', count(*) FROM own
      UNION ALL SELECT 'covered', count(DISTINCT resume_id) FROM ids
        WHERE doc_id IN (SELECT doc_id FROM {found}))"""


ORACLE["redaction_job_statistics"] = f"""WITH {entities_cte()}, {IDS},
  {ALL_SPANS.removeprefix(CORPUS).lstrip(', ')},
  span_texts AS (SELECT DISTINCT doc_id, lower(entity_type) AS entity_type, text FROM spans)
{_statistics('spans', 'span_texts')} UNION ALL {_statistics('rules', 'entities')}"""
ORACLE["redaction_job_table"] = "WITH " + MASKED.replace(CORPUS, f"""wide AS ({WIDE_SQL}),
  corpus AS MATERIALIZED (SELECT id AS doc_id, note, concat_ws(chr(10) || chr(10), {', '.join(
    f'CASE WHEN NOT {blank(x)} THEN {x} END' for x in _AS_TEXT.values())}) AS text FROM wide)""") + f"""
SELECT doc_id, note, anonymized_content, {_STATUS} FROM masked JOIN corpus USING (doc_id, text)"""
_RESUMES = f"""resumes AS MATERIALIZED ({RESUMES_SQL}),
  corpus AS MATERIALIZED (SELECT doc_id, text FROM resumes)"""
ORACLE["redact_then_match"] = "WITH " + MASKED.replace(CORPUS, _RESUMES) + ", " + PAIRS.replace(
    CLEAN,
    f"""clean AS MATERIALIZED (SELECT doc_id, category, {scrub('category')} AS jd_clean,
      {scrub('anonymized_content')} AS resume_clean FROM masked JOIN resumes USING (doc_id, text))""",
) + f", {SPLIT} SELECT * EXCLUDE (category) FROM split"

# --- Models: what SQL can state of them ----------------------------------------------------

_MADE = f"""resumes AS ({RESUMES_SQL}),
  pairs AS (SELECT doc_id || ':' || label AS pair_id, doc_id, CAST(label AS INTEGER) AS label
    FROM resumes, (VALUES (0), (1)) AS v(label)), {SPLIT}"""
ORACLE["fit_match_model"] = f"""WITH {_MADE}
SELECT split, count(*) AS n, true AS learned FROM split WHERE split <> 'train' GROUP BY split"""
ORACLE["score_pairs"] = f"""WITH {_MADE}
SELECT pair_id, doc_id, label, split, true AS consistent FROM split WHERE split <> 'train'"""
ORACLE["rank_by_model"] = """
SELECT least(5, count(*)) AS n_of_category FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING'"""

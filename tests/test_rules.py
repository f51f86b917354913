"""Every rule and field on hand-written lines."""

import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from veilrank import catalog
from veilrank.functions.matching import contains_any
from veilrank.operators.entities import detect_spans, extra_spans
from veilrank.operators.redact import redact_column

# (rule, text, redacted text with only that rule's type)
GOLDEN = [
    # Beyond every length that a bounded rule would stop at.
    ("addr_street", "at 12 Near the old temple behind the water tank opposite the new bus stand and "
     "the big vegetable market of the Long Hill Road, yes", "at <ADDRESS>, yes"),
    ("addr_unit", "7/B, " + "Green Park " * 12 + ", " + "Old Town " * 8 + ", " + "West Bengal " * 6 + "!",
     "<ADDRESS> !"),
    ("worked_at", "Worked at Acme and Sons Trading and Shipping and Storage and Insurance and Banking "
     "and Computer and Travel Services of Pune Ltd. Then", "Worked at <COMPANY>. Then"),
    ("school_named", "the Aa Bb Cc Dd Ee Ff Gg Hh Ii Jj Kk Ll University of", "the <SCHOOL> of"),
    ("email", "write to a.b+c@mail-1.example.org, now", "write to <EMAIL>, now"),
    ("email", "a@b is no address", "a@b is no address"),
    ("linkedin", "see linkedin.com/in/ann-lee_1.", "see <LINKEDIN>."),
    ("github", "https://github.com/ann/x", "https://<GITHUB>/x"),
    ("twitter", "twitter.com/ann?x", "<TWITTER>?x"),
    ("facebook", "facebook.com/ann.lee ok", "<FACEBOOK> ok"),
    ("dob_dmy", "Date of Birth: 4/5/1970", "Date of Birth: <DOB>"),
    ("dob_dmy", "Founded: 4/5/1970", "Founded: 4/5/1970"),
    ("dob_ymd", "DOB (1970-05-04)", "DOB (<DOB>)"),
    ("dob_text", "Birth Date: March 4, 1970", "Birth Date: <DOB>"),
    ("gender_field", "Sex: female, 30", "Sex: <GENDER>, 30"),
    ("gender_field", "Gender: e", "Gender: <GENDER>"),
    ("gender_paren", "Ann (F) and (X)", "Ann (<GENDER>) and (X)"),
    ("gender_paren", "Ann (女)", "Ann (<GENDER>)"),
    ("gender_dash", "Gender-Male", "Gender-<GENDER>"),
    ("marital", "Marriage Status： single\nx", "Marriage Status： <MARITAL_STATUS>\nx"),
    ("father", "Father's Name: karl m, x", "Father's Name: <NAME>, x"),
    ("mother", "Mothers Name: eva", "<NAME>: <NAME>"),
    ("addr_label", "Location: Old Mill 3, Pune\nx", "Location: <ADDRESS>\nx"),
    ("addr_unit", "12/B, Green Park, Pune, India.", "<ADDRESS>."),
    ("addr_street", "at 12 Long Hill Road now", "at <ADDRESS> now"),
    ("edu_month_range", "June 2010 to May 2014", "<EDUCATION_DATES>"),
    ("edu_year_to", "from 2010 to 2014.", "from <EDUCATION_DATES>."),
    ("edu_year_dash", "1999–2003 and 2150-2160", "<EDUCATION_DATES> and 2150-2160"),
    ("edu_month", "since Mar 2015", "since <DATE>"),
    ("work_month_range", "June 2010 to May 2014", "<WORK_DATES>"),
    ("work_year_range", "2010 - 2014", "<WORK_DATES>"),
    ("work_year_range", "2010 to 2014", "<WORK_DATES>"),
    ("work_present", "to Present, to represent", "to <WORK_DATES>, to represent"),
    ("phone_digits", "call 555-123-4567 or 12345", "call <PHONE> or 12345"),
    ("phone_digits", "call +49 555 123 4567", "call +49 <PHONE>"),
    ("phone_label", "Tel: 12-34 56 78\nx", "Tel: <PHONE>\nx"),
    ("phone_label", "Tel: 1234", "Tel: 1234"),
    ("worked_at", "worked at Acme 7 Ltd", "worked at <COMPANY>"),
    ("employer", "Employer: Firm 3, Pune", "Employer: <COMPANY>, Pune"),
    ("company", "company - Firm 3", "company - <COMPANY>"),
    ("company", "Company Name: Firm 3", "Company Name: <COMPANY>"),
    ("school_of", "University of Pune, India", "University of <SCHOOL>, India"),
    ("school_label", "School: Hill Top", "School: <SCHOOL>"),
    ("school_named", "at Delhi Public School.", "at <SCHOOL>."),
    ("age_label", "Age: 41", "Age: <AGE>"),
    ("age_old", "41 years old", "<AGE> years old"),
    ("age_any", "age 41, Page 12", "age <AGE>, Page 12"),
    ("name_middle", "by Ann B. Novak.", "by <NAME>."),
    ("name_two", "Ann Lee met Ann Leeds", "<NAME> met <NAME>"),
    ("name_two", "ann Lee", "ann Lee"),
    ("name_two", "Ann Leeä", "Ann Leeä"),
]
RULE = {r.rule_id: r for r in catalog.RULES}


def test_golden_lines_cover_every_rule():
    assert {g[0] for g in GOLDEN} == set(RULE)
    assert len(catalog.RULES) == 37


@pytest.mark.parametrize("entity_type", sorted({r.entity_type for r in catalog.RULES}))
def test_golden_lines(each, entity_type):
    lines = [g for g in GOLDEN if RULE[g[0]].entity_type == entity_type]
    got = each(redact_column(F.col("text"), [entity_type]), *[g[1] for g in lines])
    assert got == [g[2] for g in lines]


def test_guards_never_change_what_matches(spark, each):
    """A rule's literals and first-character class accept everything its pattern finds."""
    lines = sorted({g[1] for g in GOLDEN})
    checks = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.regexp_extract_all("text", F.lit("(?U)" + r.pattern), F.lit(0)).alias("found"),
                (contains_any(F.col("text"), r.needs) if r.needs else F.lit(True)).alias("ok"),
            )
            for r in catalog.RULES
        ]
    )
    for line in each(checks, *lines):
        for check in line:
            rule = RULE[check.rule_id]
            assert not check.found or check.ok, rule.rule_id
            for match in check.found:
                assert rule.head is None or re.match(rule.head, match), rule.rule_id
                assert not rule.needs or any(n in match for n in rule.needs), rule.rule_id


def test_spans_have_the_offsets_of_the_text(each):
    lines = sorted({g[1] for g in GOLDEN} | {"ééé Ann Lee é\ue000 Ann Leeds  Bob Ray"})
    both = F.concat(detect_spans(F.col("text")), extra_spans(F.col("text")))
    for line, spans in zip(lines, each(both, *lines)):
        for s in spans:
            assert line[s.start:s.end] == s.text, (line, s)


def test_spans_match_rule_by_rule(each):
    """Offsets equal those of Python's own matcher."""
    lines = sorted({g[1] for g in GOLDEN} | {"ééé Ann Lee é\ue000 Ann Leeds  Bob Ray"})
    for line, spans in zip(lines, each(detect_spans(F.col("text")), *lines)):
        got = sorted((s.rule_id, s.start, s.end) for s in spans)
        want = sorted(
            (r.rule_id, *m.span(r.value)) for r in catalog.RULES
            for m in regex.finditer(r.pattern, line)
        )
        assert got == want, line


def test_fields(each):
    line = (
        "Date of Birth (Gender): 1963-04-04 (M)\nFather's Name: Karl M, x \n"
        "Marital Status: Single \nNationality: Indian\nPhoto: a b.jpg\n"
    )
    (spans,) = each(extra_spans(F.col("text")), line)
    assert [(s.entity_type, s.text, s.score) for s in spans] == [
        ("DATE_OF_BIRTH", "1963-04-04", 0.9),
        ("GENDER", "M", 0.9),
        ("FAMILY_INFO", "Karl M, x", 0.85),
        ("MARITAL_STATUS", "Single", 0.85),
        ("NATIONALITY", "Indian", 0.85),
        ("PHOTO_REFERENCES", "a b.jpg", 0.8),
    ]
    assert all(line[s.start:s.end] == s.text for s in spans)
    assert each(extra_spans(F.col("text")), "Nationality:  \n", None) == [[], []]


def test_selection():
    assert catalog.select_types(["AGE", "GENDER"]) == ("GENDER", "AGE")
    assert len(catalog.select_types()) == 18
    with pytest.raises(ValueError):
        catalog.select_types(["AGE", "SHOE_SIZE"])
    with pytest.raises(ValueError):
        catalog.select_rules(order="random")
    places = [r.names_first for r in catalog.RULES]
    assert sorted(places) == list(range(1, 38))
    first = catalog.select_rules(order="names_first")[0]
    assert first.rule_id == "name_two"


LONG = 1_000_000
HARD = {
    "blanks": "ref 1/2 a," + " " * (LONG // 2) + "," + " " * (LONG // 2) + ".",
    "commas": "1/2 a" + " ," * (LONG // 2) + ".",
    "lines": "5 Phone Gender Company DOB Photo" + "\n" * LONG + "St",
    "dots": "a." * (LONG // 2) + "@",
}


@pytest.mark.parametrize("name", sorted(HARD))
def test_no_rule_takes_more_than_linear_time(spark, name):
    rules = [*catalog.RULES, *catalog.FIELDS]
    texts = spark.createDataFrame([(HARD[name],)], "text string").cache()
    texts.count()
    for r in rules:
        started = time.perf_counter()
        texts.select(F.length(F.regexp_replace("text", "(?U)" + (f"(?={r.head})" if getattr(r, "head", None) else "") + r.pattern, "x"))).collect()
        assert time.perf_counter() - started < 2, r


def test_addresses_of_units_end_with_their_line(each):
    """Prose with a fraction is still taken for an address, but no further than its line."""
    prose = "Paid 3/4 of it then left the firm, moved to the coast, and wrote a long book\nSecond line here"
    (got,) = each(redact_column(F.col("text"), ["ADDRESS"]), prose)
    assert got == "Paid <ADDRESS>\nSecond line here"


def test_numbers_before_a_street_begin_it(each):
    lines = ["a1 5 Main Street", "9 8 7 Oak Road, 4 Elm St x", "12  Lane", "5 Street"]
    got = each(redact_column(F.col("text"), ["ADDRESS"]), *lines)
    assert got == ["a1 <ADDRESS>", "<ADDRESS> x", "<ADDRESS>", "5 Street"]

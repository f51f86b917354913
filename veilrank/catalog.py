"""Entity types, detection rules and placeholders.

Data only.  ``functions.matching`` turns a rule into Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------

TYPE_DESCRIPTIONS = {
    "PERSON_NAME": "name of a person",
    "EMAIL_ADDRESS": "e-mail address",
    "PHONE_NUMBER": "telephone number",
    "SOCIAL_MEDIA": "social media link",
    "DATE_OF_BIRTH": "date of birth",
    "GENDER": "gender",
    "MARITAL_STATUS": "marital status",
    "FAMILY_INFO": "family members",
    "ADDRESS": "postal address",
    "EDUCATION_DATES": "dates of education",
    "WORK_DATES": "dates of work",
    "PHOTO_REFERENCES": "photo file",
    "AGE": "age",
    "NATIONALITY": "nationality",
    "RELIGION": "religion",
    "LOCATION": "location",
    "COMPANY_NAME": "company name",
    "SCHOOL_NAME": "school name",
}

# Placeholder of a masked span, by type; any other type gets DEFAULT_PLACEHOLDER.
PLACEHOLDERS = {
    "PERSON_NAME": "<NAME>",
    "PERSON": "<NAME>",
    "NRP": "<NAME>",
    "EMAIL_ADDRESS": "<EMAIL>",
    "PHONE_NUMBER": "<PHONE>",
    "SOCIAL_MEDIA": "<SOCIAL_MEDIA>",
    "DATE_OF_BIRTH": "<DOB>",
    "GENDER": "<GENDER>",
    "MARITAL_STATUS": "<MARITAL_STATUS>",
    "FAMILY_INFO": "<FAMILY_INFO>",
    "ADDRESS": "<ADDRESS>",
    "EDUCATION_DATES": "<EDUCATION_DATES>",
    "WORK_DATES": "<WORK_DATES>",
    "PHOTO_REFERENCES": "<PHOTO>",
    "AGE": "<AGE>",
    "NATIONALITY": "<NATIONALITY>",
    "RELIGION": "<RELIGION>",
    "LOCATION": "<LOCATION>",
    "COMPANY_NAME": "<COMPANY>",
    "SCHOOL_NAME": "<SCHOOL>",
}
DEFAULT_PLACEHOLDER = "<REDACTED>"

# Detector names a selected type stands for; a type not listed stands for itself.
DETECTORS = {"PERSON_NAME": ("PERSON", "NRP")}

SCORE_THRESHOLD = 0.65
# Words near a span that speak for its type, how much they lift its score, and how many characters near is.
CONTEXT_WORDS = {
    "PERSON_NAME": ("name", "full name", "father", "mother"),
    "EMAIL_ADDRESS": ("email", "e-mail", "mail"),
    "PHONE_NUMBER": ("phone", "mobile", "cell", "telephone", "contact"),
    "SOCIAL_MEDIA": ("profile", "social", "media", "link"),
    "DATE_OF_BIRTH": ("birth", "born", "DOB"),
    "GENDER": ("gender", "sex", "male", "female"),
    "MARITAL_STATUS": ("marital", "married", "single", "divorced"),
    "ADDRESS": ("address", "location", "residence", "live"),
    "EDUCATION_DATES": ("education", "university", "college", "school", "degree", "graduated"),
    "WORK_DATES": ("experience", "work", "job", "company", "employment"),
    "COMPANY_NAME": ("company", "employer", "organization", "firm"),
    "SCHOOL_NAME": ("education", "university", "college", "school", "institute"),
    "AGE": ("age", "years old", "year old"),
}
CONTEXT_LIFT = 0.35
CONTEXT_WINDOW = 60
CONTENT_KEYWORDS = ("description", "detail", "skill", "education", "company")
TRAIN_TOKENS = 1536
SCORING_TOKENS = 512
SEPARATOR = "</s>"

_MONTH = (
    "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
)
_MON = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_ORG = "(?:University|College|Institute|School)"
# Blanks on either side of an optional sign belong to the sign: two runs of blanks next to each other could
# share them in any way, and a search would try them all.
_BIRTH = r"((?:Date\s+of\s+Birth|DOB|Birth\s+Date)\s*(?:[:(]\s*)?)"


# What the texts with matches of several rules hold: name to (the gate to pass first, pattern).  No pattern looks
# beyond its match or takes what a placeholder holds, so masking one rule's values never opens the gate of another.
GATES = {
    "digit": (None, r"\d"),
    "year_range": ("digit", r"(?:19|20)\d{2}(?:\s+to\s+|\s*[-–]\s*)(?:19|20)\d{2}"),
    "month": ("digit", _MON + r"[a-z]*\s+\d{4}"),
    "two_names": (None, r"[A-Z][a-z]+\s+[A-Z]"),
}


@dataclass(frozen=True)
class Rule:
    """One detection rule.

    ``value`` is the capture group that holds the personal value (0: the whole match);
    groups around it are kept.  ``needs`` lists literals of which every match contains
    at least one, ``head`` is a character class every match starts with: both only let
    Spark skip text early, they never change what matches.  ``gate`` names a pattern of ``GATES``
    that every text with a match holds, searched once for all the rules that share it.
    ``names_first`` is the rule's place when names are redacted before labelled fields.
    """

    rule_id: str
    entity_type: str
    replacement: str
    score: float
    pattern: str
    value: int = 0
    needs: tuple[str, ...] = ()
    head: str | None = None
    names_first: int = 0
    gate: str | None = None


# Specific rules first, names last, so a label such as "Marital Status" is not taken for a name.
RULES = (
    Rule("email", "EMAIL_ADDRESS", "<EMAIL>", 0.9,
         # The look-behind skips starts inside a run, which end where the run's first start does.
         r"\b(?<![A-Za-z0-9_][.%+-]{0,8})[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
         needs=("@",), names_first=5),
    Rule("linkedin", "SOCIAL_MEDIA", "<LINKEDIN>", 0.85,
         r"linkedin\.com/in/[A-Za-z0-9_-]+",
         needs=("linkedin.com/in/",), names_first=8),
    Rule("github", "SOCIAL_MEDIA", "<GITHUB>", 0.85,
         r"github\.com/[A-Za-z0-9_-]+",
         needs=("github.com/",), names_first=9),
    Rule("twitter", "SOCIAL_MEDIA", "<TWITTER>", 0.85,
         r"twitter\.com/[A-Za-z0-9_-]+",
         needs=("twitter.com/",), names_first=10),
    Rule("facebook", "SOCIAL_MEDIA", "<FACEBOOK>", 0.85,
         r"facebook\.com/[A-Za-z0-9_.-]+",
         needs=("facebook.com/",), names_first=11),
    Rule("dob_dmy", "DATE_OF_BIRTH", "$1<DOB>", 0.85,
         _BIRTH + r"(\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})",
         value=2, needs=("Birth", "DOB"), head="[DB]", names_first=12, gate="digit"),
    Rule("dob_ymd", "DATE_OF_BIRTH", "$1<DOB>", 0.85,
         _BIRTH + r"(\d{4}[-/.]\d{1,2}[-/.]\d{1,2})",
         value=2, needs=("Birth", "DOB"), head="[DB]", names_first=13, gate="digit"),
    Rule("dob_text", "DATE_OF_BIRTH", "$1<DOB>", 0.85,
         _BIRTH + r"([A-Za-z]+\s+\d{1,2},?\s+\d{4})",
         value=2, needs=("Birth", "DOB"), head="[DB]", names_first=14, gate="digit"),
    Rule("gender_field", "GENDER", "$1<GENDER>", 0.85,
         r"((?:Gender|Sex)\s*[:：]\s*)([^\n,]+)",
         value=2, needs=("Gender", "Sex"), head="[GS]", names_first=15),
    Rule("gender_paren", "GENDER", "(<GENDER>)", 0.7,
         r"\((?:M|F|Male|Female|男|女)\)",
         needs=("(",), names_first=16),
    Rule("gender_dash", "GENDER", "$1<GENDER>", 0.85,
         r"(Gender\s*(?:[:-]\s*)?)(Male|Female|M|F|男|女)",
         value=2, needs=("Gender",), names_first=17),
    Rule("marital", "MARITAL_STATUS", "$1<MARITAL_STATUS>", 0.85,
         r"((?:Marital|Marriage)\s+Status\s*[:：]\s*)([^\n,]+)",
         value=2, needs=("Status",), head="M", names_first=18),
    Rule("father", "PERSON_NAME", "$1<NAME>", 0.8,
         r"(Father'?s Name\s*[:：]\s*)([^\n,]+)",
         value=2, needs=("Father",), names_first=3),
    Rule("mother", "PERSON_NAME", "$1<NAME>", 0.8,
         r"(Mother'?s Name\s*[:：]\s*)([^\n,]+)",
         value=2, needs=("Mother",), names_first=4),
    Rule("addr_label", "ADDRESS", "$1<ADDRESS>", 0.7,
         r"((?:Address|Location)\s*[:：]\s*)([^\n]+)",
         value=2, needs=("Address", "Location"), head="[AL]", names_first=20),
    Rule("addr_unit", "ADDRESS", "<ADDRESS>", 0.7,
         # One blank where a class that holds blanks follows, which matches the same in linear time; the
         # last part ends with its line.
         r"\b\d+/[A-Za-z0-9],?\s[A-Za-z0-9\s,]+,\s[A-Za-z\s]+,\s+[A-Za-z][A-Za-z \t]*\b",
         needs=("/",), head=r"\d", names_first=21, gate="digit"),
    Rule("addr_street", "ADDRESS", "<ADDRESS>", 0.7,
         # A number shortly behind another one that could begin the address need not be tried: what follows
         # it is what follows that one.
         r"\b(?<!(?=\d)\b\d{1,9}\s[A-Za-z0-9\s,]{0,30})\d+\s[A-Za-z0-9\s,]+"
         r"(?:Street|Avenue|Road|Blvd|Drive|Lane|Place|Way|Apt|Suite|St|Rd|Dr|Ave)\b",
         needs=("St", "Ave", "Road", "Blvd", "Dr", "Lane", "Place", "Way", "Apt", "Suite", "Rd"),
         head=r"\d", names_first=19, gate="digit"),
    Rule("edu_month_range", "EDUCATION_DATES", "<EDUCATION_DATES>", 0.75,
         _MONTH + r"\s+\d{4}\s+to\s+" + _MONTH + r"\s+\d{4}",
         head="[ADFJMNOS]", names_first=22, gate="month"),
    Rule("edu_year_to", "EDUCATION_DATES", "<EDUCATION_DATES>", 0.7,
         r"\b(?:19|20)\d{2}\s+to\s+(?:19|20)\d{2}\b",
         head="[12]", names_first=23, gate="year_range"),
    Rule("edu_year_dash", "EDUCATION_DATES", "<EDUCATION_DATES>", 0.7,
         r"\b(?:19|20)\d{2}\s*[-–]\s*(?:19|20)\d{2}\b",
         head="[12]", names_first=24, gate="year_range"),
    Rule("edu_month", "EDUCATION_DATES", "<DATE>", 0.6,
         r"\b" + _MON + r"[a-z]*\s+\d{4}\b",
         head="[ADFJMNOS]", names_first=25, gate="month"),
    Rule("work_month_range", "WORK_DATES", "<WORK_DATES>", 0.75,
         _MONTH + r"\s+\d{4}\s+to\s+" + _MONTH + r"\s+\d{4}",
         head="[ADFJMNOS]", names_first=26, gate="month"),
    Rule("work_year_range", "WORK_DATES", "<WORK_DATES>", 0.7,
         r"\b(?:19|20)\d{2}(?:\s+to\s+|\s*[-–]\s*)(?:19|20)\d{2}\b",
         head="[12]", names_first=27, gate="year_range"),
    Rule("work_present", "WORK_DATES", "<WORK_DATES>", 0.7,
         r"\b[Pp]resent\b",
         needs=("resent",), names_first=28),
    Rule("phone_digits", "PHONE_NUMBER", "<PHONE>", 0.85,
         r"\b(?:\+\d{1,3}[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?){1,2}\d{3,4}[-.\s]?\d{3,4}\b",
         head=r"[+(\d]", names_first=6, gate="digit"),
    Rule("phone_label", "PHONE_NUMBER", "$1<PHONE>", 0.85,
         r"((?:Phone|Tel|Mobile|Contact)\s*(?:(?:Number|No|#|:)\s*)?(?:[:：]\s*)?)"
         r"(\+?[\d(][\d \t().-]{5,}[\d)])",
         value=2, needs=("Phone", "Tel", "Mobile", "Contact"), head="[CMPT]", names_first=7),
    Rule("worked_at", "COMPANY_NAME", "$1<COMPANY>", 0.7,
         r"([Ww]orked\s+(?:at|for|with)\s+)"
         r"([A-Z][A-Za-z0-9\s&,.]+?(?:Inc|LLC|Ltd|Limited|Corp|Corporation|Co|Company)\b)",
         value=2, needs=("orked",), names_first=31),
    Rule("employer", "COMPANY_NAME", "$1<COMPANY>", 0.8,
         r"([Ee]mployer\s*[:：]\s*)([^\n,]+)",
         value=2, needs=("mployer",), names_first=30),
    Rule("company", "COMPANY_NAME", "$1<COMPANY>", 0.7,
         r"([Cc]ompany(?:\s+[Nn]ame)?\s*(?:[-:：]\s*)?)([^\n,]+)",
         value=2, needs=("ompany",), names_first=29),
    Rule("school_of", "SCHOOL_NAME", "$1<SCHOOL>", 0.7,
         "(" + _ORG + r"\s+of\s+)([^\n,]+)",
         value=2, needs=("University", "College", "Institute", "School"), head="[CISU]",
         names_first=32),
    Rule("school_label", "SCHOOL_NAME", "$1<SCHOOL>", 0.7,
         "(" + _ORG + r"\s*[:：]\s*)([^\n,]+)",
         value=2, needs=("University", "College", "Institute", "School"), head="[CISU]",
         names_first=33),
    Rule("school_named", "SCHOOL_NAME", "<SCHOOL>", 0.7,
         # Capitalised words without a bound: one class in a loop, and what each character must
         # follow.  The look-behind at the start only skips starts inside a run, so that
         # a long run without an organisation word is not searched from every word of it.
         r"\b(?=[A-Z])(?<!(?=[A-Z])\b[A-Z][a-z]{1,40}\s{1,4})"
         r"(?:[A-Za-z\s](?<!\s[a-z])(?<![A-Za-z][A-Z])(?<![A-Z]\s))+(?<=\s)" + _ORG + r"\b",
         needs=("University", "College", "Institute", "School"), head="[A-Z]", names_first=34),
    Rule("age_label", "AGE", "$1<AGE>", 0.8,
         r"((?:Age|Years)\s*[:：]\s*)(\d{1,2})",
         value=2, needs=("Age", "Years"), head="[AY]", names_first=35, gate="digit"),
    Rule("age_old", "AGE", "<AGE>$2", 0.8,
         r"(\d{1,2})(\s+[Yy]ears\s+[Oo]ld)",
         value=1, needs=("ears",), head=r"\d", names_first=36, gate="digit"),
    Rule("age_any", "AGE", "$1<AGE>", 0.8,
         r"(\b[Aa]ge[:：]?\s*)(\d{1,2})",
         value=2, needs=("Age", "age"), head="[Aa]", names_first=37, gate="digit"),
    Rule("name_middle", "PERSON_NAME", "<NAME>", 0.7,
         r"\b[A-Z][a-z]+\s+[A-Z][a-z]*\.\s+[A-Z][a-z]+\b",
         head="[A-Z]", names_first=2, gate="two_names"),
    Rule("name_two", "PERSON_NAME", "<NAME>", 0.7,
         r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b",
         head="[A-Z]", names_first=1, gate="two_names"),
)

# Fields found once per document.  The pattern alternates kept and value groups; ``values``
# maps a group to its type.
@dataclass(frozen=True)
class Field:
    field_id: str
    pattern: str
    values: tuple[tuple[int, str], ...]
    score: float
    needs: tuple[str, ...]


FIELDS = (
    Field("dob_gender",
          r"(Date\s+of\s+Birth\s*\(\s*Gender\s*\)\s*:\s*)(\d{4}-\d{2}-\d{2})(\s*\(\s*)([MF])\s*\)",
          ((2, "DATE_OF_BIRTH"), (4, "GENDER")), 0.9, ("Gender",)),
    Field("family", r"((?:Father|Mother)'?s\s+Name\s*[:：]\s*)([^\n]+)",
          ((2, "FAMILY_INFO"),), 0.85, ("Father", "Mother")),
    Field("marital", r"(Marital\s+Status\s*[:：]\s*)([^\n,]+)",
          ((2, "MARITAL_STATUS"),), 0.85, ("Marital",)),
    Field("nationality", r"(Nationality\s*[:：]\s*)([^\n,]+)",
          ((2, "NATIONALITY"),), 0.85, ("Nationality",)),
    Field("photo", r"((?:Photo|Picture|Image)\s*(?:[:：]\s*)?)(\S[^\n]*\.(?:jpg|jpeg|png|gif))",
          ((2, "PHOTO_REFERENCES"),), 0.8, ("Photo", "Picture", "Image")),
)

# --- Selection --------------------------------------------------------------


def select_types(types: Iterable[str] | None = None) -> tuple[str, ...]:
    """The chosen entity types in catalogue order; all of them by default."""
    if types is None:
        return tuple(TYPE_DESCRIPTIONS)
    if isinstance(types, str):
        raise ValueError("types must be a collection of type names, not one string")
    chosen = set(types)
    unknown = sorted(chosen - set(TYPE_DESCRIPTIONS))
    if unknown:
        raise ValueError(f"unknown entity types: {', '.join(unknown)}")
    return tuple(t for t in TYPE_DESCRIPTIONS if t in chosen)


def select_rules(
    types: Iterable[str] | None = None, order: str = "specific_first"
) -> tuple[Rule, ...]:
    """Rules of the chosen types, ``specific_first`` (default) or ``names_first``."""
    chosen = set(select_types(types))
    rules = tuple(r for r in RULES if r.entity_type in chosen)
    if order == "specific_first":
        return rules
    if order == "names_first":
        return tuple(sorted(rules, key=lambda r: r.names_first))
    raise ValueError(f"unknown rule order: {order}")


def select_fields(types: Iterable[str] | None = None) -> tuple[Field, ...]:
    """Field extractors that yield at least one of the chosen types."""
    chosen = set(select_types(types))
    return tuple(f for f in FIELDS if any(t in chosen for _, t in f.values))

import pytest
from pyspark.sql import functions as F

from veilrank.functions import text as tx
from veilrank.operators import content

T = F.col("text")


def test_scrub(each):
    lines = {
        "Mail A@B.co!, call 0123456789": "mail <EMAIL> call <PHONE>",
        "１２３４５６７８９０": "<PHONE>",
        "ab c@d": "ab <EMAIL>",
        "1234567890é": "1234567890é",
        "123456789": "123456789",
        "@a a@ @ @@": "@a a@ @ @@",
        "@a@b @@@": "<EMAIL> <EMAIL>",
    }
    assert each(tx.scrub(T), *lines) == list(lines.values())


def test_email_run_equals_plain_pattern(each):
    import itertools

    lines = ["".join(p) for p in itertools.product("a@ ", repeat=6)]
    plain = F.regexp_replace(T, r"(?U)\S+@\S+", "<EMAIL>")
    assert each(tx.scrub_email(T), *lines) == each(plain, *lines)


def test_argmax_takes_the_first(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.1, 0.9],), ([3.0, 1.0],)], "p array<double>")
    assert [r[0] for r in df.select(tx.argmax_label(F.col("p"))).collect()] == [0, 1, 0]


@pytest.mark.parametrize(
    "a, b, budget, kept",
    [(3, 4, 10, (3, 4)), (3, 20, 10, (3, 7)), (20, 3, 10, (7, 3)), (20, 20, 10, (5, 5)),
     (20, 20, 11, (6, 5)), (0, 20, 10, (0, 10))],
)
def test_token_budget(spark, a, b, budget, kept):
    ka, kb = tx.kept_tokens(F.lit(a), F.lit(b), budget)
    assert tuple(spark.range(1).select(ka, kb).first()) == kept


def test_words_and_tokens(each):
    assert each(tx.words(T), "Été, c'est-à-dire <NAME> 7") == [
        ["Été", "c", "est", "à", "dire", "NAME", "7"]
    ]
    assert each(tx.tokens(T), "  a,  b\nc ") == [["a,", "b", "c"]]


def test_content_choice(spark):
    df = spark.createDataFrame(
        [(1, "a", 7, "x"), (2, None, None, "y"), (3, " \n", 8, None)],
        "id long, Job_Description string, skill_code int, other string",
    )
    assert content.discover_content_columns(df) == ["Job_Description", "skill_code"]
    chosen, name = content.choose_content(df)
    assert [r[name] for r in chosen.orderBy("id").collect()] == ["a\n\n7", "", "8"]
    assert content.choose_content(df, "other") == (df, "other")
    plain = df.select("id", "other")
    assert content.discover_content_columns(plain) == ["other"]


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert {tuple(r) for r in content.null_audit(df).collect()} == {("a", 0), ("b", 1)}
    with pytest.raises(ValueError, match="b"):
        content.null_audit(df, fail=True)


def test_preview_line(each):
    assert each(tx.preview_line(F.lit(0.5), T), "x" * 100) == ["0.5000 | " + "x" * 80 + "…"]

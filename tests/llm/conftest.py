import pytest

from llm_prose import prose


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with results."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, prose(1, 80)), (5, prose(1, 80)), (5, prose(1, 80)),
        (None, prose(2, 40)), (6, prose(3, 60_000)), (7, "x" * 200_000), (8, "é ñ 😀 \u0000 ’"),
        (-9, "one"), (10, "one two"), (None, None),
    ]
    clash = ("n_tokens long, ids string, score string, fp string, secrets string, size string, "
             "bucket long, lang_pred string, slot string, held string, key string, n string")
    return spark.createDataFrame(
        [(a, b, "en", "s", 1, *(None,) * 12) for a, b in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {clash}",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")

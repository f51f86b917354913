"""Lexical match score and top-k résumés per job description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilrank.functions.text import distinct_words, scrub, words
from veilrank.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
SEED_ROWS = 2000  # résumés that the rarest words of a job description may bring up at first
NEEDED = 2  # words of the rare prefix that a pair must share
_LINE_BYTES = 100  # of a job description's word in a broadcast table


def lexical_score(jd_clean: Column, resume_clean: Column) -> Column:
    """Share of the job description's distinct words that the résumé holds; 0 without words."""
    wanted = distinct_words(jd_clean)
    shared = F.array_intersect(wanted, words(resume_clean))
    return F.coalesce(
        F.try_divide(F.size(shared).cast("double"), F.size(wanted)), F.lit(0.0)
    )


def _check_k(k: int) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")


def rank_resumes(
    resumes: DataFrame, jd_text: str, k: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Top k résumés for one job description: one scan, then k rows per task."""
    _check_k(k)
    score = lexical_score(scrub(F.lit(jd_text)), scrub(F.col(text)))
    scored = resumes.select(key, score.alias("score"), F.col(text).alias("text"))
    return scored.orderBy(F.desc("score"), F.desc("text"), key).limit(k)


def rank_resumes_per_jd(
    jds: DataFrame,
    resumes: DataFrame,
    k: int = 5,
    jd_key: str = "item_id",
    key: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """Top k résumés for every job description: ``(jd_key, key, score, rank)``, without all pairs.

    The words of a job description are ordered by the number of résumés that hold them, rarest first:

    * its rarest words find some résumés; the k that share most of them are scored in full, and the least
      of those scores is a bound that the k best reach;
    * a résumé that shares at least that many words shares ``NEEDED`` of all but so many of the
      commonest ones.  Only that rare prefix meets the résumés' words, so a common word makes no rows;
      a word that all résumés hold never does, as it is counted for everyone;
    * pairs that meet often enough are looked up in full.

    Small jobs run at once to find the bounds.  Words become numbers as soon as they are found, and only words
    of job descriptions are kept; a list of words or bounds is broadcast up to ``broadcast_bytes`` as
    measured, and beyond that both sides shuffle, by word and salt where a word may be common.

    Where fewer than k résumés share a word, those with the lowest keys follow.  ``key`` is unique.
    """
    _check_k(k)
    spark = resumes.sparkSession
    wanted = jds.select(jd_key, distinct_words(scrub(F.col("text"))).alias("words"))
    jd_words = wanted.select(jd_key, F.size("words").alias("n_words"), F.explode("words").alias("word"))
    listed = jd_words.select("word").distinct().withColumn("wid", F.monotonically_increasing_id())
    vocabulary = materialize(listed, "vocabulary")
    measured = vocabulary.agg(F.sum(F.octet_length("word") + F.lit(32))).first()[0] or 0

    # Outer: the filter an inner explode infers would find the words a second time.
    found = resumes.select(key, F.explode_outer(distinct_words(scrub(F.col(text)))).alias("word"))
    met = _meet(found, vocabulary, "word", key, measured <= broadcast_bytes, salts)
    held = materialize(met.groupBy(key).agg(F.collect_list("wid").alias("wids")), "held")
    n_resumes = resumes.count()
    frequency = held.select(F.explode("wids").alias("wid")).groupBy("wid").agg(F.count(F.lit(1)).alias("df"))

    known = jd_words.join(vocabulary, "word").join(frequency, "wid")
    by_rarity = Window.partitionBy(jd_key).orderBy("df", "wid")
    line = materialize(
        known.where(F.col("df") < n_resumes).select(
            jd_key, "wid", "df",
            F.row_number().over(by_rarity).alias("pos"),
            F.sum("df").over(by_rarity.rowsBetween(Window.unboundedPreceding, -1)).alias("rows_before"),
            F.count(F.lit(1)).over(Window.partitionBy(jd_key)).alias("m"),
        ), "line",
    )
    everywhere = known.where(F.col("df") == n_resumes).groupBy(jd_key).agg(F.count(F.lit(1)).alias("n_all"))
    sizes = wanted.select(jd_key, F.size("words").alias("n_words")).join(everywhere, jd_key, "left")
    small = line.count() * _LINE_BYTES <= broadcast_bytes

    def pairs(words: DataFrame) -> DataFrame:
        """``(jd_key, key, n)``: how many of some words of a job description a résumé holds."""
        rows = held.select(key, F.explode("wids").alias("wid"))
        meet = _meet(rows, words.select(jd_key, "wid"), "wid", key, small, salts)
        return meet.groupBy(jd_key, key).agg(F.count(F.lit(1)).alias("n"))

    def in_full(some: DataFrame, words: DataFrame) -> DataFrame:
        """``some`` pairs with ``shared``: ``n`` and how many of ``words`` the résumé holds besides."""
        lists = words.groupBy(jd_key).agg(F.collect_list("wid").alias("own"))
        both = some.join(lists, jd_key, "left").join(held, key)
        more = F.size(F.array_intersect(F.coalesce("own", F.array().cast("array<long>")), "wids"))
        return both.select(jd_key, key, (F.col("n") + more).alias("shared"))

    rarest = line.where((F.col("pos") == 1) | (F.col("rows_before") + F.col("df") <= seed_rows))
    first = _best(pairs(rarest).withColumnRenamed("n", "score"), k, jd_key, key)
    rest = line.join(rarest.select(jd_key, "pos"), [jd_key, "pos"], "left_anti")
    scored = in_full(first.withColumn("n", F.col("score")), rest)
    bounds = scored.groupBy(jd_key).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("shared")).otherwise(0).alias("least")
    )
    # All but the ``least - NEEDED`` commonest words: who shares ``least`` words shares NEEDED of these.
    least = F.coalesce("least", F.lit(0))
    upto = F.when(least > NEEDED, F.col("m") - least + NEEDED).otherwise(F.col("m"))
    split = materialize(line.join(bounds, jd_key, "left").withColumns({
        "rare": F.col("pos") <= upto,
        "needed": F.greatest(F.lit(1), F.least(least, F.lit(NEEDED))),
    }), "split")
    enough = split.select(jd_key, "needed").distinct()
    candidates = pairs(split.where("rare")).join(enough, jd_key).where("n >= needed")
    full = in_full(candidates, split.where("NOT rare"))

    share = (F.col("shared") + F.coalesce("n_all", F.lit(0))).cast("double") / F.col("n_words")
    scored = full.join(sizes, jd_key).select(jd_key, key, share.alias("score"))
    best = _best(scored, k, jd_key, key)
    low = F.coalesce(F.try_divide(F.coalesce("n_all", F.lit(0)).cast("double"), "n_words"), F.lit(0.0))
    others = _lowest(sizes.select(jd_key, low.alias("score")), resumes, k, key)
    both = best.unionByName(others).groupBy(jd_key, key).agg(F.max("score").alias("score"))
    return _best(both, k, jd_key, key, "rank")


def _meet(
    rows: DataFrame, words: DataFrame, word: str, key: str, small: bool, salts: int
) -> DataFrame:
    """``rows`` joined with a list of words: broadcast if that is small, else by word and salt."""
    if small:
        return rows.join(F.broadcast(words), word)
    salted = rows.withColumn("salt", F.pmod(F.hash(key), F.lit(salts)))
    copies = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [word, "salt"]).drop("salt")


def merge_rankings(
    stored: DataFrame, arrived: DataFrame, k: int = 5, jd_key: str = "item_id", key: str = "doc_id"
) -> DataFrame:
    """The k best of two rankings ``(jd_key, key, score, rank)`` of the same job descriptions.

    A ranking of all résumés is the merge of the rankings of any parts of them, so résumés that arrive
    are ranked alone and none is scored twice.  A key in both counts with its later score.
    """
    _check_k(k)
    old = stored.join(arrived.select(jd_key, key), [jd_key, key], "left_anti")
    both = old.unionByName(arrived).select(jd_key, key, "score")
    return _best(both, k, jd_key, key, "rank")


def _best(
    scored: DataFrame, k: int, jd_key: str, key: str, output: str | None = None
) -> DataFrame:
    order = Window.partitionBy(jd_key).orderBy(F.desc("score"), key)
    ranked = scored.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    return ranked.withColumnRenamed("_rank", output) if output else ranked.drop("_rank")


def _lowest(scores: DataFrame, resumes: DataFrame, k: int, key: str) -> DataFrame:
    """The 2k lowest keys for every job description, with the score of a résumé that shares no other word.

    A job description that shares words with fewer than k résumés finds at least k others
    among them.  For the rest they rank behind the k best and drop out.
    """
    lowest = resumes.select(key).orderBy(key).limit(2 * k)
    keys = lowest.agg(F.collect_list(key).alias("keys")).scalar()
    return scores.withColumn(key, F.explode(keys))

"""Matched and mismatched (job description, résumé) pairs and their split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilrank.operators.ranks import grouped_rank, hash_cuts, hash_rank, up_to

SEED = 42
SHARES = {"train": 70, "val": 15, "test": 15}


def pair_name(key: str, label: int) -> Column:
    """A pair's id: the key, of any type, and the label."""
    return F.concat(F.col(key).cast("string"), F.lit(f":{label}"))


def check_keys(df: DataFrame, key: str) -> DataFrame:
    """The table itself; raises at once if a key is null or held by two rows.  Only keys move."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = counts.where((F.col("n") > 1) | F.col(key).isNull()).select(key).limit(3).collect()
    if bad:
        raise ValueError(f"{key} is null or repeated, as in {[r[0] for r in bad]}; see with_row_key")
    return df


def positive_pairs(clean: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every résumé with its own category, label 1."""
    return clean.withColumns({"pair_id": pair_name(key, 1), "label": F.lit(1)})


def _drawn(clean: DataFrame, key: str, seed: int, avoid_self: bool) -> DataFrame:
    """The job description that every key draws: ``(key, jd_drawn)``."""
    jds = clean.select(key, "jd_clean")
    if avoid_self:
        ranked = grouped_rank(jds, "jd_clean", key, seed, "_rank")
        sizes = jds.groupBy("jd_clean").agg(F.count(F.lit(1)).alias("n"))
        shift = sizes.agg(F.max("n").alias("n")).scalar()
        total = sizes.agg(F.sum("n").alias("n")).scalar()
        takers = ranked.select(key, ((F.col("_rank") - 1 + shift) % total + 1).alias("_rank"))
    else:
        ranked = hash_rank(jds, key, seed, "_rank")
        takers = hash_rank(jds.select(key), key, seed + 1, "_rank")
    given = ranked.select("_rank", F.col("jd_clean").alias("jd_drawn"))
    return takers.join(given, "_rank").drop("_rank")


def negative_pairs(
    clean: DataFrame, key: str = "doc_id", seed: int = SEED, avoid_self: bool = False
) -> DataFrame:
    """Every résumé with the job description of another row under a seeded permutation, label 0.

    Only keys and job descriptions are ranked and joined; the résumé text moves once, to meet
    its new job description.  As in a plain permutation a row may draw its own category;
    ``avoid_self`` rotates the rows, ordered by category, by the size of the largest category,
    which rules that out unless one category holds more than half of all rows.
    """
    drawn = _drawn(clean, key, seed, avoid_self).withColumnRenamed("jd_drawn", "jd_clean")
    mismatched = clean.drop("jd_clean").join(drawn, key)
    return mismatched.withColumns({"pair_id": pair_name(key, 0), "label": F.lit(0)})


def build_pairs(
    clean: DataFrame, key: str = "doc_id", seed: int = SEED, avoid_self: bool = False
) -> DataFrame:
    """Matched and mismatched pairs together, two for every row; equal texts are kept.

    The drawn job description meets the row once, so a text is read, cleaned and moved once for
    both.  A repeated or null key raises.
    """
    check_keys(clean.select(key), key)
    both = clean.join(_drawn(clean, key, seed, avoid_self), key)
    rest = [c for c in clean.columns if c != "jd_clean"]
    made = F.array(
        F.struct(F.col("jd_clean"), pair_name(key, 1).alias("pair_id"), F.lit(1).alias("label")),
        F.struct(F.col("jd_drawn").alias("jd_clean"), pair_name(key, 0).alias("pair_id"),
                 F.lit(0).alias("label")),
    )
    return both.select(*rest, F.inline(made))


def pair_keys(clean: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, pair id and label of every pair that ``build_pairs`` makes, without making them."""
    made = F.array(
        F.struct(pair_name(key, 1).alias("pair_id"), F.lit(1).alias("label")),
        F.struct(pair_name(key, 0).alias("pair_id"), F.lit(0).alias("label")),
    )
    return clean.select(key, F.inline(made))


def stratified_split(
    pairs: DataFrame,
    keys: DataFrame | None = None,
    pair_id: str = "pair_id",
    label: str = "label",
    labels: tuple[int, ...] = (0, 1),
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``: 70 / 15 / 15 percent of each label, in seeded hash order.

    ``keys`` may give the same pair ids and labels more cheaply than ``pairs``.  The cuts are
    one row per label, so attaching them moves no pair.  Other labels than ``labels`` raise.
    """
    n = F.col("n_group")
    percent = [SHARES["train"], SHARES["train"] + SHARES["val"]]
    targets = [F.floor(n * p / 100) for p in percent]
    source = (pairs if keys is None else keys).where(F.col(label).isin(*labels))
    cuts = hash_cuts(source, label, pair_id, seed, targets)
    known = F.col(label).isin(*labels)
    split = (
        F.when(~F.coalesce(known, F.lit(False)), F.raise_error(F.lit("unexpected label")))
        .when(up_to(F.col("cut_0"), F.col(pair_id), seed), "train")
        .when(up_to(F.col("cut_1"), F.col(pair_id), seed), "val")
        .otherwise("test")
    )
    return (
        pairs.join(F.broadcast(cuts), label, "left")
        .withColumn("split", split)
        .drop("cut_0", "cut_1")
    )


def grouped_split(
    pairs: DataFrame, key: str = "doc_id", label: str = "label", labels: tuple[int, ...] = (0, 1), seed: int = SEED
) -> DataFrame:
    """Add ``split`` so that all pairs of a document are in one split: nothing tested was trained on.

    Documents of the same histogram of labels are cut 70 / 15 / 15 in seeded hash order, so every split has the
    labels in the same shares.  Counts of 16 and more are taken by powers of two, which bounds the number of
    histograms.  The part of a document that a cut leaves over is rounded by a hash of the histogram, up or down, so
    that many rare histograms do not all favour one split.  A null key is one document; other labels raise.
    """
    known = F.coalesce(F.col(label).isin(*labels), F.lit(False))
    checked = F.when(known, F.coalesce(F.col(key).cast("string"), F.lit(""))).otherwise(
        F.raise_error(F.lit("unexpected label"))
    )
    named = pairs.withColumn("_document", checked)
    counts = named.groupBy("_document").agg(
        *(F.count_if(F.col(label) == v).alias(f"_n{i}") for i, v in enumerate(labels))
    )
    sizes = [F.col(f"_n{i}") for i in range(len(labels))]
    kind = F.concat_ws(",", *(
        F.when(n < 16, n).otherwise(F.floor(F.log2(n.cast("double"))) + 16).cast("string") for n in sizes
    ))
    documents = counts.select("_document", kind.alias("_kind"))
    odd = F.conv(F.substring(F.md5("_kind"), 1, 4), 16, 10).cast("double") / 65536
    percent = [SHARES["train"], SHARES["train"] + SHARES["val"]]
    targets = [F.floor(F.col("n_group") * p / 100 + odd) for p in percent]
    cuts = hash_cuts(documents, "_kind", "_document", seed, targets)
    dealt = documents.join(F.broadcast(cuts), "_kind", "left").select(
        "_document",
        F.when(up_to(F.col("cut_0"), F.col("_document"), seed), "train")
        .when(up_to(F.col("cut_1"), F.col("_document"), seed), "val").otherwise("test").alias("split"),
    )
    return named.join(dealt, "_document").drop("_document")


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def false_negative_audit(pairs: DataFrame, own_jd: str) -> DataFrame:
    """Mismatched pairs, and how many of them drew their own job description."""
    negatives = pairs.where("label = 0")
    same = F.count_if(F.col("jd_clean") == F.col(own_jd))
    return negatives.agg(
        F.count(F.lit(1)).alias("n_negatives"), same.alias("n_false_negatives")
    )


def leakage_audit(split: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with a pair in train and another in test."""
    seen = split.groupBy(key).agg(
        F.bool_or(F.col("split") == "train").alias("in_train"),
        F.bool_or(F.col("split") == "test").alias("in_test"),
    )
    return seen.where("in_train AND in_test").select(key)

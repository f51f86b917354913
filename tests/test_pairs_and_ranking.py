import numpy as np
import pytest
from pyspark.sql import functions as F

from veilrank.operators import matching, metrics, pairs, ranking, ranks
from veilrank.plans.matching_job import run_matching, split_pairs
from veilrank.session import materialize, spread, with_row_key


def clean_table(spark, n, hot=0.4):
    """n rows, of which a large share has one category."""
    cats = [f"cat{0 if i < n * hot else 1 + i % 7}" for i in range(n)]
    rows = [(i, c, f"text {i} {c}") for i, c in enumerate(cats)]
    return spark.createDataFrame(rows, "doc_id long, jd_clean string, resume_clean string")


def test_hash_rank_is_a_permutation_whatever_the_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    one = ranks.hash_rank(df.coalesce(1), "doc_id", 1, "r").collect()
    many = ranks.hash_rank(df.repartition(7), "doc_id", 1, "r").collect()
    assert sorted(r.r for r in one) == list(range(1, 501))
    assert {tuple(r) for r in one} == {tuple(r) for r in many}


@pytest.mark.parametrize("n", [0, 1, 137, 499, 500, 9000])
def test_sample_is_exact_and_nested(spark, n):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    got = {r.doc_id for r in ranks.sample_n(df, n).collect()}
    assert len(got) == min(n, 500)
    assert got <= {r.doc_id for r in ranks.sample_n(df, n + 50).collect()}


def test_sample_of_nothing(spark):
    df = spark.range(0).withColumnRenamed("id", "doc_id")
    assert ranks.sample_n(df, 5).count() == 0
    with pytest.raises(ValueError):
        ranks.sample_n(df, -1)


@pytest.mark.parametrize("avoid_self", [False, True])
def test_negative_pairs_permute_the_job_descriptions(spark, avoid_self):
    clean = clean_table(spark, 301)
    made = pairs.negative_pairs(clean, avoid_self=avoid_self).collect()
    before = {r.doc_id: r for r in clean.collect()}
    assert sorted(r.doc_id for r in made) == sorted(before)
    assert sorted(r.jd_clean for r in made) == sorted(r.jd_clean for r in before.values())
    assert all(r.resume_clean == before[r.doc_id].resume_clean for r in made)
    own = sum(r.jd_clean == before[r.doc_id].jd_clean for r in made)
    assert own == 0 if avoid_self else own > 0


def test_split_is_exact_disjoint_and_complete(spark):
    made = pairs.build_pairs(clean_table(spark, 1000))
    split = pairs.stratified_split(made)
    counts = {(r.split, r.label): r.n for r in pairs.split_summary(split).collect()}
    assert counts == {(s, y): n for s, n in (("train", 700), ("val", 150), ("test", 150))
                      for y in (0, 1)}
    assert split.select("pair_id").distinct().count() == 2000
    keys = pairs.pair_keys(clean_table(spark, 1000))
    by_keys = pairs.stratified_split(made, keys=keys)
    columns = ["pair_id", "split"]
    assert by_keys.select(columns).exceptAll(split.select(columns)).count() == 0


def test_split_rejects_other_labels(spark):
    df = spark.createDataFrame([(1, 0), (2, 5)], "pair_id long, label int")
    with pytest.raises(Exception, match="unexpected label"):
        pairs.stratified_split(df).collect()


def test_split_of_very_few_pairs(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "pair_id long, label int")
    assert [r.split for r in pairs.stratified_split(df).collect()] == ["test", "test"]


def test_leakage_audit(spark):
    df = spark.createDataFrame(
        [(1, "train"), (1, "test"), (2, "train"), (2, "val"), (3, "test")],
        "doc_id long, split string",
    )
    assert [r.doc_id for r in pairs.leakage_audit(df).collect()] == [1]


def brute_force(jds, docs, k):
    out = set()
    for j, jd in jds:
        wanted = set(jd.split())
        scores = [
            ((len(wanted & set(t.split())) / len(wanted) if wanted else 0.0), d) for d, t in docs
        ]
        best = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
        out |= {(j, d, round(s, 9), i + 1) for i, (s, d) in enumerate(best)}
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "salts": 3}])
def test_rank_per_jd_equals_brute_force(spark, options):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(vocabulary, 6)) + " the") for i in range(120)]
    docs += [(200 + i, docs[5][1]) for i in range(60)]  # a third are copies
    jds = [(i, " ".join(rng.choice(vocabulary, 4)) + " the") for i in range(6)]
    jds += [(7, "rare unseen"), (8, "w1 unseen"), (9, "?!")]
    got = ranking.rank_resumes_per_jd(
        spark.createDataFrame(jds, "item_id long, text string"),
        spark.createDataFrame(docs, "doc_id long, text string"),
        k=7,
        **options,
    ).collect()
    rows = {(r.item_id, r.doc_id, round(r.score, 9), r["rank"]) for r in got}
    assert len(got) == 9 * 7
    jds[-1] = (9, "")
    assert rows == brute_force(jds, docs, 7)


def test_rank_for_one_jd(texts):
    df = texts("python developer", "java developer", "a developer", "cook")
    got = ranking.rank_resumes(df, "Python Developer", k=3).collect()
    assert [r.text for r in got] == ["python developer", "java developer", "a developer"]
    with pytest.raises(ValueError):
        ranking.rank_resumes(df, "x", k=0)


def test_metrics_of_published_counts(spark):
    """143 true positives, 127 true negatives and 19 errors give the known accuracy and F1."""
    rows = [(1, 1, 0.9)] * 143 + [(0, 0, 0.1)] * 127 + [(0, 1, 0.9)] * 10 + [(1, 0, 0.1)] * 9
    df = spark.createDataFrame(rows, "label int, prediction int, p_match double")
    got = metrics.evaluate(df).first()
    assert (got.n, got.accuracy, got.f1) == (289, 0.934256, 0.937705)
    assert tuple(metrics.confusion(df).first()) == (143, 10, 9, 127)
    certain = spark.createDataFrame([(1, 0, 0.0)], "label int, prediction int, p_match double")
    assert metrics.evaluate(certain).first().log_loss == pytest.approx(16.118096)
    nothing = spark.createDataFrame([(0, 0, 0.0)], "label int, prediction int, p_match double")
    assert metrics.evaluate(nothing).first().f1 is None


def test_model_learns_and_repeats(spark):
    rng = np.random.default_rng(5)
    fields = ["cooking", "python", "sales", "law"]
    rows = [
        (i, fields[i % 4], f"worked in {fields[i % 4]} " + " ".join(rng.choice(list("abcdef"), 4)))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "doc_id long, category string, text string")
    report = run_matching(df, avoid_self=True)
    scored = report.scored.collect()
    assert len(scored) == 120
    assert all(abs(r.p_match + r.p_mismatch - 1) < 1e-9 for r in scored)
    assert {r["split"] for r in report.metrics.collect()} == {"val", "test"}
    assert min(r.accuracy for r in report.metrics.collect()) > 0.9
    again = matching.score_pairs(
        matching.fit_match_model(report.pairs.where("split = 'train'")),
        report.pairs.where("split <> 'train'"),
    )
    assert {(r.pair_id, round(r.p_match, 6)) for r in again.collect()} == {
        (r.pair_id, round(r.p_match, 6)) for r in scored
    }
    best = matching.rank_by_model(report.model, df, "Python", k=3).collect()
    assert all("python" in r.text for r in best)


def test_own_scorer(spark):
    df = spark.createDataFrame([("a", "bbb", 1)], "jd_clean string, resume_clean string, x int")
    scored = matching.score_pairs_with(df, lambda jd, resume: jd.str.len() / resume.str.len())
    assert scored.columns == [*df.columns, "p_match"]
    assert scored.first().p_match == pytest.approx(1 / 3)


def resumes_of(spark, n, key_type):
    rows = [(f"cat{i % 3}", f"Text {i % 4} a@b") for i in range(n)]
    df = spark.createDataFrame(rows, "category string, text string")
    key = F.monotonically_increasing_id() % 1_000_003
    return df.withColumn("doc_id", F.xxhash64(key) if key_type == "hash" else F.concat(F.lit("é/"), key))


@pytest.mark.parametrize("key_type", ["hash", "string"])
@pytest.mark.parametrize("avoid_self", [False, True])
def test_pairs_of_any_key(spark, key_type, avoid_self):
    df = materialize(resumes_of(spark, 40, key_type), "keyed")
    made = split_pairs(df, avoid_self=avoid_self).collect()
    assert len(made) == 80 and len({r.pair_id for r in made}) == 80
    assert {r.pair_id for r in made} == {f"{k.doc_id}:{y}" for k in df.collect() for y in (0, 1)}


def test_repeated_keys_raise_and_row_keys_mend_them(spark, tmp_path):
    df = spark.createDataFrame([("HR", "same")] * 5 + [("IT", "other")] * 4, "category string, text string")
    hashed = df.withColumn("doc_id", F.xxhash64("text"))
    with pytest.raises(ValueError, match="doc_id"):
        split_pairs(hashed)
    keyed = with_row_key(df, "doc_id", str(tmp_path / "keyed"))
    assert split_pairs(keyed).count() == 18


def test_ranks_of_many_groups_take_no_single_task(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.md5((F.col("id") % 90).cast("string")).alias("g"))
    ranked = ranks.grouped_rank(df, "g", "doc_id", 42, "r")
    rows = sorted(ranked.collect(), key=lambda r: r.r)
    assert [r.r for r in rows] == list(range(1, 301))
    places = [r.g for r in rows]
    assert sum(a != b for a, b in zip(places, places[1:])) == 89  # each group is one run


def test_large_splittable_inputs_stay_where_they_are(spark, tmp_path):
    spark.range(100_000).coalesce(2).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "Exchange" in spread(df, "id")._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spread(df, "id") is df
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_spread_partitions_follow_the_rows_of_a_table_that_packs_small(spark, tmp_path):
    for rows, partitions in ((1_000, 8), (300_000, 12), (600_000, 24)):
        spark.range(rows).withColumn("text", F.lit("the same " * 10)).write.parquet(str(tmp_path / str(rows)))
        df = spread(spark.read.parquet(str(tmp_path / str(rows))), "id")
        assert df.rdd.getNumPartitions() == partitions
        assert df.count() == rows


@pytest.mark.parametrize("options", [{}, {"seed_rows": 1}, {"seed_rows": 10**9}, {"broadcast_bytes": 0, "salts": 2}])
def test_pruned_ranking_of_skewed_words_equals_brute_force(spark, options):
    """Words from very rare to very common, so that bounds cut most of the pairs."""
    rng = np.random.default_rng(17)
    vocabulary = [f"w{i}" for i in range(60)]
    often = 1 / np.arange(1, 61)
    often /= often.sum()
    draw = lambda n: " ".join(rng.choice(vocabulary, n, p=often))
    docs = [(i, "all " + draw(int(rng.integers(1, 40)))) for i in range(250)]
    jds = [(i, draw(int(rng.integers(1, 30))) + (" all" if i % 2 else "")) for i in range(15)]
    jds += [(50, "all"), (51, docs[3][1]), (52, docs[4][1] + " nowhere"), (53, "nowhere all")]
    got = ranking.rank_resumes_per_jd(
        spark.createDataFrame(jds, "item_id long, text string"),
        spark.createDataFrame(docs, "doc_id long, text string"), k=4, **options,
    ).collect()
    assert {(r.item_id, r.doc_id, round(r.score, 9), r["rank"]) for r in got} == brute_force(jds, docs, 4)


def test_common_words_make_no_pairs(spark, monkeypatch):
    rows = []
    meet = ranking._meet

    def counted(left, words, word, key, small, salts):
        out = meet(left, words, word, key, small, salts)
        rows.append(out.count())
        return out

    monkeypatch.setattr(ranking, "_meet", counted)
    docs = [(i, f"all most{'' if i % 9 else ' rare'} u{i}" if i % 50 else "all rare u1 u2 u3") for i in range(400)]
    jds = [(1, "all most rare u1 u2 u3")]
    ranking.rank_resumes_per_jd(
        spark.createDataFrame(jds, "item_id long, text string"),
        spark.createDataFrame(docs, "doc_id long, text string"), k=5, seed_rows=60,
    ).collect()
    listed, *joined = rows
    assert listed > 700  # every word of a job description, once for each résumé
    assert max(joined) < 100  # neither the word that all hold nor the one that most hold


def test_merged_rankings_equal_a_full_run(spark):
    rng = np.random.default_rng(23)
    docs = [(i, " ".join(rng.choice([f"w{j}" for j in range(30)], 8))) for i in range(90)]
    jds = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 9))) for i in range(5)], "item_id long, text string")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    told = lambda df: sorted((r.item_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.collect())
    stored = None
    for start in range(0, 90, 30):
        arrived = ranking.rank_resumes_per_jd(jds, frame(docs[start : start + 30]), k=6)
        stored = arrived if stored is None else materialize(ranking.merge_rankings(stored, arrived, 6), "ranking")
    assert told(stored) == told(ranking.rank_resumes_per_jd(jds, frame(docs), k=6))
    assert told(ranking.merge_rankings(stored, stored, 6)) == told(stored)  # the same part twice


def test_grouped_split_keeps_documents_whole_and_shares_even(spark):
    rng = np.random.default_rng(31)
    rows = [(f"{d}:{i}", d, int(rng.integers(0, 2))) for d in range(3000) for i in range(int(rng.integers(1, 6)))]
    rows += [(f"big:{i}", 5000, i % 2) for i in range(100)] + [(f"null:{i}", None, i % 2) for i in range(4)]
    table = spark.createDataFrame(rows, "pair_id string, doc_id long, label int")
    split = materialize(pairs.grouped_split(table), "grouped")
    assert pairs.leakage_audit(split).count() == 0
    got = split.collect()
    assert sorted(r.pair_id for r in got) == sorted(r[0] for r in rows)
    assert len({r["split"] for r in got if r.doc_id is None}) == 1
    for label in (0, 1):
        own = [r["split"] for r in got if r.label == label]
        for name, share in (("train", 0.70), ("val", 0.15), ("test", 0.15)):
            assert abs(own.count(name) / len(own) - share) < 0.01
    with pytest.raises(Exception, match="unexpected label"):
        pairs.grouped_split(spark.createDataFrame([("a", 1, 7)], "pair_id string, doc_id long, label int")).collect()
    assert pairs.grouped_split(table.where("false")).count() == 0

"""Samples: sizes, disjointness, reproducibility, skew, and the exact order by brute force."""

import hashlib

import pytest
from pyspark.sql import functions as F

from labelloom.operators import sampling as S
from labelloom.operators import tags as T

CIRCLE = 1 << 60


def corpus(spark, n, seed_tags):
    """``n`` questions with gaps in their ids; ``seed_tags``: tag -> modulus of the rows that carry it."""
    tag_list = [F.when(F.col("i") % m == 0, t) for t, m in seed_tags.items()]
    return spark.range(n).select(
        (F.col("id") * 7 + 3).alias("id"), F.col("id").alias("i")
    ).select("id", F.concat_ws(" ", *tag_list, F.concat(F.lit("u"), "i")).alias("tags"))


def h60(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def test_sample_matches_brute_force(spark):
    spec = S.SampleSpec(positives=7, negatives=40, more_than=50, seed=3)
    questions = corpus(spark, 3000, {"half": 2, "third": 3, "rare": 50, "most": 1})
    selected = T.frequent_tags(T.tag_histogram(questions), spec.more_than).where("tag <> 'most'")
    found = {}
    for r in S.tag_samples(questions, selected, spec).collect():
        found.setdefault((r["tag"], r["label"]), []).append(r["id"])
    rows = [(r["id"], r["tags"].split()) for r in questions.collect()]
    assert {t for t, _ in found} == {"half", "third", "rare"}
    for tag in ("half", "third", "rare"):
        having = sorted(
            (i for i, tags in rows if tag in tags),
            key=lambda i: (hashlib.md5(f"{tag}:{i}:3".encode()).hexdigest(), i),
        )
        lacking = sorted(
            (i for i, tags in rows if tag not in tags), key=lambda i: ((h60(i, 3) - h60(tag, 3)) % CIRCLE, i)
        )
        assert sorted(found[tag, True]) == sorted(having[:7])
        assert sorted(found[tag, False]) == sorted(lacking[:40])


def test_full_size_sample(spark):
    questions = corpus(spark, 20000, {"t": 4})
    selected = T.frequent_tags(T.tag_histogram(questions), 2000)
    sample = S.tag_samples(questions, selected, S.SampleSpec()).collect()
    assert len(sample) == 1560 == len({r["id"] for r in sample})
    assert sum(r["label"] for r in sample) == 60


def test_short_corpus_fails_loudly_or_takes_all(spark):
    questions = corpus(spark, 100, {"t": 2})
    selected = T.frequent_tags(T.tag_histogram(questions), 10)
    with pytest.raises(Exception, match="too few documents without tag"):
        S.negative_sample(questions, selected, S.SampleSpec(negatives=60)).collect()
    assert S.negative_sample(questions, selected, S.SampleSpec(negatives=60, strict=False)).count() == 50


def test_short_samples_fail_however_they_are_read(spark):
    questions = corpus(spark, 100, {"t": 2, "all": 1})
    for tag, negatives in (("t", 60), ("all", 1)):
        selected = T.tag_histogram(questions).where(F.col("tag") == tag)
        sample = S.negative_sample(questions, selected, S.SampleSpec(negatives=negatives))
        for read in (lambda: sample.count(), lambda: sample.select("tag", "id").collect()):
            with pytest.raises(Exception, match="too few documents without tag"):
                read()


def test_repeated_tags_in_a_row_count_once(spark):
    questions = spark.range(200).select("id", F.when(F.col("id") < 100, "t t").otherwise("u").alias("tags"))
    selected = T.tag_histogram(questions).where("tag = 't'")
    assert S.negative_sample(questions, selected, S.SampleSpec(negatives=100)).count() == 100


def test_folds_are_even(spark):
    questions = corpus(spark, 3000, {"half": 2, "third": 3})
    spec = S.SampleSpec(positives=60, negatives=150, more_than=500)
    selected = T.frequent_tags(T.tag_histogram(questions), spec.more_than)
    folded = S.stratified_folds(S.tag_samples(questions, selected, spec), spec)
    sizes = folded.groupBy("tag", "label", "fold").count().collect()
    assert len(sizes) == 12
    assert {(r["label"], r["count"]) for r in sizes} == {(True, 20), (False, 50)}


def test_sample_index(spark):
    rows = [("spring", 40, False), ("autumn", 12, True), ("spring", 12, True), ("winter", 12, False), ("autumn", 7, False)]
    index = S.sample_index(spark.createDataFrame(rows, "tag string, id long, label boolean"))
    assert {r["id"]: [tuple(t) for t in r["tags"]] for r in index.collect()} == {
        7: [("autumn", False)],
        12: [("autumn", True), ("spring", True), ("winter", False)],
        40: [("spring", False)],
    }


def test_first_per_key_under_skew(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    found = S.first_per_key(rows, "k", [F.col("id")], 5).where("k = 'hot'").orderBy("id")
    assert [r["id"] for r in found.collect()] == [0, 1, 2, 3, 4]


def test_cooccurrence_counts_documents_once_both_ways(spark):
    rows = [(1, "a b c"), (2, "b a a"), (3, "c"), (4, ""), (5, "  a  z b "), (6, None), (7, "z a")]
    questions = spark.createDataFrame(rows, "id long, tags string")
    selected = spark.createDataFrame([("a",), ("b",), ("c",), ("unused",)], "tag string")
    found = T.tag_cooccurrence(questions, selected)
    expected = {("a", "b"): 3, ("b", "a"): 3, ("a", "c"): 1, ("c", "a"): 1, ("b", "c"): 1, ("c", "b"): 1}
    assert {(r.tag, r.other): r.shared for r in found.collect()} == expected
    none = T.tag_cooccurrence(questions, selected.where("tag = 'c'"))
    assert none.count() == 0

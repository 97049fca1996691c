"""Salted plans give the rows of the plain plans."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grantweave.functions.text import concat_text
from grantweave.operators import duplicates as dup
from grantweave.operators import link, match, outcomes, skew
from grantweave.operators.skew import SkewPolicy, balanced_join, hot_keys

SALTED = SkewPolicy(min_bytes=0, hot_rows=5, rows_per_split=3, max_splits=7)
ALWAYS = SkewPolicy(min_bytes=0, hot_rows=1, rows_per_split=1, max_splits=4)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _tables(spark, seed):
    pick = random.Random(seed)
    key = lambda: pick.choice(["hot", "hot", "hot", "warm", None, *map(str, range(8))])
    left = [(key(), pick.randrange(3)) for _ in range(80)]
    right = [(key(), pick.randrange(2)) for _ in range(60)]
    return (
        spark.createDataFrame(left, "k string, a int").repartition(3),
        spark.createDataFrame(right, "k string, b int").repartition(3),
    )


@pytest.mark.parametrize("policy", [SALTED, ALWAYS], ids=["some", "all"])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_salted_join_equals_plain_join(spark, policy, how, null_safe, seed):
    left, right = _tables(spark, seed)
    other = right.withColumnRenamed("k", "rk")
    same = left["k"].eqNullSafe(other["rk"]) if null_safe else left["k"] == other["rk"]
    plain = left.join(other, same, how).select("k", "a", "b")
    salted = balanced_join(left, right, ["k"], how, null_safe, policy=policy)
    assert _rows(salted) == _rows(plain)


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_with_unique_right(spark, null_safe):
    left, right = _tables(spark, 3)
    counts = right.groupBy("k").agg(F.count("*").alias("n"))
    other = counts.withColumnRenamed("k", "rk")
    same = left["k"].eqNullSafe(other["rk"]) if null_safe else left["k"] == other["rk"]
    plain = left.join(other, same, "left").select("k", "a", "n")
    salted = balanced_join(
        left, counts, ["k"], "left", null_safe, right_unique=True, policy=ALWAYS
    )
    assert _rows(salted) == _rows(plain)
    assert salted.count() == left.count()


def test_no_heavy_key_stays_whole(spark):
    """Keys with 1/500 of the rows among many light ones: each is listed, and the list has a bound."""
    heavy = spark.range(400_000).select((F.col("id") % 250).cast("string").alias("k"))
    light = spark.range(400_000).select(F.concat(F.lit("light"), "id").alias("k"))
    df = heavy.union(light).repartition(6)
    found = hot_keys(df, ["k"], SkewPolicy(0, 1_600, 200, 4))
    expected = {r[0] for r in heavy.distinct().select(F.xxhash64("k")).collect()}
    assert expected <= set(found) and len(found) <= skew.LISTED
    assert {found[h] for h in expected} == {4}
    assert hot_keys(df.limit(0), ["k"]) == {}


def test_keys_of_unlike_types_are_joined_as_they_are(spark):
    left = spark.range(40).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k int, v string")
    joined = balanced_join(left, right, ["k"], "inner", policy=ALWAYS)
    assert joined.count() == left.filter("k < 2").count()


def test_identical_rows_spread_over_salts(spark):
    left = spark.range(400).select(F.lit("hot").alias("k")).repartition(8)
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = balanced_join(left, right, ["k"], right_unique=True, policy=SALTED)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 400
    assert len(sizes) > 1
    assert max(r["count"] for r in sizes) < 300


def test_salted_link_audit_and_flags(spark):
    left, right = _tables(spark, 5)
    linked = link.link_left(left, right, "k", policy=ALWAYS)
    audit = link.link_audit(left, right, "k").first()
    assert audit.merged_rows == linked.count()
    rows = left.withColumn("id", F.monotonically_increasing_id())
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    plain = dup.duplicate_flags(rows, ["k", "a"], ["id"])
    salted = dup.duplicate_flags(rows, ["k", "a"], ["id"], policy=ALWAYS)
    assert _rows(plain) == _rows(salted)
    figures = dup.duplicate_stats(rows, ["k", "a"]).first()
    assert plain.filter("dup_all").count() == figures.total_duplicates
    assert plain.filter("dup_extra").count() == figures.extra_duplicates
    assert dup.duplicate_representatives(rows, ["k", "a"]).count() == figures.unique_duplicate_rows


def test_salted_counts(spark):
    left, right = _tables(spark, 6)
    pairs = outcomes.outcome_pairs({"n": (right, "k", "b")})
    counts = outcomes.outcome_counts(pairs, ["n"])
    plain = outcomes.attach_counts(left, counts, "k", ["n"])
    salted = outcomes.attach_counts(left, counts, "k", ["n"], policy=ALWAYS)
    assert _rows(plain) == _rows(salted)
    assert salted.filter("k is null").agg(F.max("n")).first()[0] == 0


def test_dedupe_is_idempotent(spark):
    left, _ = _tables(spark, 7)
    once = dup.drop_full_duplicates(left)
    assert _rows(once) == _rows(dup.drop_full_duplicates(once))


def _brute_force(text, terms):
    """Leftmost-longest whole words, character by character."""
    word = lambda c: c.isascii() and (c.isalnum() or c == "_")
    hits, i = [], 0
    while i < len(text):
        if i == 0 or not word(text[i - 1]):
            fitting = [
                t
                for t in terms
                if text.startswith(t, i)
                and not (i + len(t) < len(text) and word(text[i + len(t)]))
            ]
            if fitting:
                best = max(fitting, key=len)
                hits.append(best)
                i += len(best)
                continue
        i += 1
    return hits


words = st.sampled_from(["a", "ab", "b", "é", "c1", "_"])
gaps = st.sampled_from([" ", "-", "  ", "'", ""])
phrases = st.lists(st.tuples(words, gaps), min_size=1, max_size=12).map(
    lambda parts: "".join(w + g for w, g in parts)
)
dictionary = st.lists(
    st.lists(st.sampled_from(["a", "ab", "b", "c1"]), min_size=1, max_size=3).map(" ".join)
    | st.sampled_from(["a-b", "b's", "ab-a b"]),
    min_size=1,
    max_size=6,
    unique=True,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(phrases, min_size=1, max_size=8), terms=dictionary)
def test_match_plans_equal_brute_force(spark, texts, terms):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    expected = [_brute_force(t, terms) for t in texts]
    by_regex = match.match_regex(df, F.col("text"), terms).orderBy("id").collect()
    by_join = match.match_join(df, F.col("text"), table).orderBy("id").collect()
    for rows in (by_regex, by_join):
        assert [r.total_count for r in rows] == [len(e) for e in expected]
        assert [r.flagged for r in rows] == [list(dict.fromkeys(e)) for e in expected]


def test_match_plans_agree_on_documents(spark):
    from grantweave.queries import TEXT_TERMS

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    table = spark.createDataFrame([(t,) for t in TEXT_TERMS], "term string")
    text = concat_text(["text"])
    by_regex = match.match_regex(documents, text, TEXT_TERMS).drop("text")
    for limit in (10**6, 0):
        by_join = match.match_join(
            documents, text, table, max_broadcast_chars=limit, policy=SALTED
        ).drop("text")
        assert by_join.exceptAll(by_regex).count() == 0
        assert by_regex.exceptAll(by_join).count() == 0


def test_filter_admits_few_sequences_but_all_hits(spark):
    """What is shuffled beyond a broadcast is close to what is found."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i)))
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select(words.alias("w"))
    terms = benchmark.select(F.explode(pairs).alias("term")).distinct()
    dictionary = match._tokenised_terms(terms)
    places = match._places(documents.filter("text != ''"), "doc_id", F.lower("text"))
    sequences = match._candidates(match.probable_starts(places, dictionary, [3]), False)
    hits = sequences.join(terms, "term")
    assert 1_000 < hits.count() and sequences.count() <= 2 * hits.count()
    everything = match._candidates(places.withColumn("n", F.lit(3)), False)
    assert everything.join(terms, "term").count() == hits.count()
    assert everything.count() > 20 * sequences.count()

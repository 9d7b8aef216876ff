import os

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.lookup import fits_broadcast, hot_keys, lookup_join
from gaugeworks.session import materialise, scratch, settled, shared_dir


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has one key, a tenth has none, the rest is spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 400)
    return spark.range(6000).select("id", key.cast("int").alias("k"))


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(0, 300).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_path_equals_plain_join(facts, keyed, how):
    plain = facts.join(keyed, "k", how)
    split = lookup_join(facts, keyed, ["k"], how, max_rows=0)
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_without_hot_keys(facts, keyed, how):
    spread = facts.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    split = lookup_join(spread, keyed, ["k"], how, max_rows=0, hot_share=2)
    plain = spread.join(keyed, "k", how)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_hot_key_does_not_shuffle_whole(facts, keyed, plan):
    text = plan(lookup_join(facts, keyed, ["k"], "left", max_rows=0))
    # The few hot keys are broadcast to mark their rows, which are dealt over parts: one join.
    assert text.count("SortMergeJoin") == 1 and "BroadcastHashJoin" in text and "Union" not in text


def test_hot_rows_are_dealt_over_parts(facts, keyed):
    hot = hot_keys(facts, ["k"], 30).filter("k = 7").first()
    assert hot["__parts"] >= 9  # a third of the rows, in parts of a thirtieth
    big = facts.withColumn("list", F.sequence(F.lit(1), F.lit(50)))
    assert not fits_broadcast(big.select("list"), max_bytes=6000 * 50 * 8)


def test_hot_keys_are_few(facts):
    assert [r.k for r in hot_keys(facts, ["k"], 8).collect()] == [7]
    assert hot_keys(facts, ["k"], 2) is None


def test_size_gate(keyed):
    assert fits_broadcast(keyed)
    assert not fits_broadcast(keyed, max_rows=10)
    assert not fits_broadcast(keyed, max_bytes=100)


def test_first_per_key_is_stable_and_combines_before_the_shuffle(spark, plan):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "n"), ("b", 9, "q")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    kept = first_per_key(df.repartition(5), ["k"], ["t"])
    assert {(r.k, r.t, r.v) for r in kept.collect()} == {("a", 1, "y"), (None, 4, "n"), ("b", 9, "q")}
    text = plan(kept)
    assert text.count("WindowGroupLimit") >= 2  # once in each task, once after the shuffle


def test_settled_leaves_one_table(spark):
    root = shared_dir(spark).removeprefix("file://") + "/gaugeworks"
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    found = settled(spark, "settled", lambda: materialise(spark.range(5), "inner").filter("id > 2"))
    assert found.count() == 2
    (left,) = set(os.listdir(root)) - before
    assert left.startswith("settled-")
    with scratch(spark):
        assert settled(spark, "again", lambda: materialise(spark.range(3), "inner")).count() == 3
    assert set(os.listdir(root)) - before == {left}

import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import split as sp
from pairloom.operators.first_rows import first_in_order
from pairloom.operators.sequence import dense_sequence, running_totals
from pairloom.sources.pairs import attach_ids


@pytest.mark.parametrize("parts", [1, 8])
def test_dense_sequence_equals_a_sorted_list(spark, parts):
    keys = [(random.Random(1).randint(0, 10**6) // 10**6, i) for i in range(5000)]  # one frequent first value
    random.Random(2).shuffle(keys)
    df = spark.createDataFrame(keys, "a long, b long").repartition(parts)
    rows = dense_sequence(df, ["a", F.desc("b")], "n", start=10).collect()
    want = {key: 10 + i for i, key in enumerate(sorted(keys, key=lambda k: (k[0], -k[1])))}
    assert {(r["a"], r["b"]): r["n"] for r in rows} == want


def test_dense_sequence_of_nothing(spark):
    assert dense_sequence(spark.range(0), ["id"], "n").collect() == []


def test_repeated_keys_are_an_error(spark):
    """Also where partitions meet, and told from rows in which nulls stand elsewhere."""
    for parts in (1, 3, 7, 200):
        rows = spark.range(200).select(F.col("id").alias("a")).unionByName(spark.range(100, 101).select(F.col("id").alias("a")))
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            with pytest.raises(ValueError, match="repeated"):
                attach_ids(rows, ["a"])
            assert dense_sequence(rows, ["a"], "n").count() == 201
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    nulls = spark.createDataFrame([(None, 1), (1, None), (None, None)], "a int, b int")
    assert attach_ids(nulls, ["a", F.desc("b")]).count() == 3
    with pytest.raises(ValueError, match="repeated"):
        attach_ids(nulls.union(nulls.limit(1)), ["a", "b"])


def test_running_totals(spark):
    assert spark.range(1).select(running_totals([2, 0, 5], 3)).first()[0] == [3, 5, 5]
    assert spark.range(1).select(running_totals([])).first()[0] == [0]


def test_no_window_without_partitions(spark):
    df = spark.range(50)
    for plan in (sp.shuffle_positions(df, 3), attach_ids(df, ["id"], id_field="n")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange SinglePartition" not in text


@pytest.mark.parametrize("read", [20, 10_000])
@pytest.mark.parametrize("n", [0, 1, 37, 250, 599, 600, 10_000])
def test_first_in_order(spark, n, read):
    rnd = random.Random(n)
    rows = [(rnd.choice([None, 1, 2, 2, 2]), rnd.choice([None, 0.5, -1.0, float("nan")]), f"k{i}") for i in range(600)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b double, c string").repartition(3)
    order = [F.desc("a"), F.col("b").asc_nulls_last(), F.length("c").desc(), "c"]
    got = first_in_order(df, order, n, keys_read=read)
    key = lambda r: r.c
    assert sorted(map(key, got.collect())) == sorted(map(key, df.orderBy(*order).limit(n).collect()))


def test_first_in_order_of_one_key(spark):
    with pytest.raises(ValueError, match="one key"):
        first_in_order(spark.range(500).select(F.lit(1).alias("a")), ["a"], 50, keys_read=20)


def test_attach_ids(spark):
    df = spark.createDataFrame([("b", 42), ("a", 43)], "t string, id long")
    assert attach_ids(df, ["t"], include_ids=False) is df
    with pytest.raises(ValueError, match="has a column"):
        attach_ids(df, ["t"])
    replaced = attach_ids(df, [F.desc("id")], overwrite_ids=True, start_id=100)
    assert {r["t"]: r["id"] for r in replaced.collect()} == {"a": 100, "b": 101}
    named = attach_ids(df, ["t"], id_field="n")
    assert named.columns == ["t", "id", "n"]


@pytest.mark.parametrize(
    "total, ratios, counts",
    [
        (5, {"train": 0.6, "val": 0.2, "test": 0.2}, [3, 1, 1]),
        (10, {"a": 0.25, "b": 0.75}, [2, 8]),
        (1, {"a": 0.5, "b": 0.5}, [0, 1]),
        (3, {"a": 0.5, "b": 0.5}, [2, 1]),
        (0, {"a": 0.5, "b": 0.5}, [0, 0]),
        (7, {"a": 0.0, "b": 1.0}, [0, 7]),
        (7, {"a": 1.0, "b": 0.0}, [7, 0]),
    ],
)
def test_split_counts(spark, total, ratios, counts):
    assert list(sp.split_counts(total, ratios).values()) == counts
    found = sp.split_dataframe(spark.range(total), ratios, seed=3).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in found} == {n: c for n, c in zip(ratios, counts) if c}


@pytest.mark.parametrize(
    "ratios, message", [({"a": 1.0}, "at least two"), ({"a": -0.5, "b": 1.5}, ">= 0"), ({"a": 0.5, "b": 0.4}, "sum")]
)
def test_bad_ratios(ratios, message):
    with pytest.raises(ValueError, match=message):
        sp.validate_ratios(ratios)


def test_splits_are_slices_of_the_permutation(spark, monkeypatch):
    # Small groups force several rounds of counting.
    monkeypatch.setattr(sp, "_DIGITS", 1)
    monkeypatch.setattr(sp, "_SMALL_GROUP", 3)
    ratios = {"train": 0.7, "val": 0.1, "test": 0.2}
    total = 3000
    one = spark.range(total)
    placed = sp.shuffle_positions(one, 7)
    order = [r["id"] for r in placed.orderBy("position").collect()]
    assert sorted(order) == list(range(total)) and order != sorted(order)
    assert [r["position"] for r in placed.orderBy("position").collect()] == list(range(total))
    want = {i: "train" if n < 2100 else "val" if n < 2400 else "test" for n, i in enumerate(order)}
    for parts in (1, 8):
        rows = sp.split_dataframe(one.repartition(parts), ratios, 7).collect()
        assert {r["id"]: r["split"] for r in rows} == want
    other = sp.split_dataframe(one, ratios, 8).where("split = 'val'").collect()
    assert {r["id"] for r in other} != {i for i, name in want.items() if name == "val"}


@pytest.mark.parametrize("parts", [1, 7])
def test_splits_come_in_shuffled_order(spark, parts):
    ratios = {"train": 0.7, "val": 0.1, "test": 0.2}
    df = spark.range(2000).repartition(3)
    order = [r["id"] for r in sp.shuffle_positions(df, 7).orderBy("position").collect()]
    ranges = sp.split_ranges(df, ratios, 7)
    ordered = sp.in_split_order(df, 7, ranges, dict.fromkeys(ranges, parts))
    rows = ordered.withColumn("p", F.spark_partition_id()).collect()
    assert [r["id"] for r in rows] == order
    assert [[r["_split"] for r in rows].count(k) for k in range(3)] == [1400, 200, 400]
    for k in range(3):
        assert len({r["p"] for r in rows if r["_split"] == k}) == parts
    # One shuffle, no second read for a sample of the keys.
    assert str(ordered._jdf.queryExecution().executedPlan()).count("Exchange") == 2


def test_repeated_ids_are_refused(spark):
    same = spark.range(4000).select(F.lit(1).cast("long").alias("id"))
    with pytest.raises(ValueError, match="repeated"):
        sp.split_dataframe(same, {"a": 0.5, "b": 0.5}, 1)
    few = spark.range(10).select(F.lit(1).cast("long").alias("id"))
    with pytest.raises(ValueError, match="repeated"):
        sp.split_dataframe(few, {"a": 0.5, "b": 0.5}, 1)

from collections import Counter

from pyspark.sql import functions as F

from meterlake.operators import dedupe
from meterlake.operators.dedupe import SURPLUS, drop_copies, keep_latest, mark_surplus
from meterlake.sources.tables import with_row_id


def stored(spark, tmp_path, data, schema):
    path = str(tmp_path / "rows")
    spark.createDataFrame(data, schema).repartition(4).write.parquet(path)
    return with_row_id(spark.read.parquet(path))


def test_keep_latest_breaks_ties_by_content(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "p"), ("a", 2, "q"), ("b", None, "x"), ("b", 1, "y"), (None, 1, "n"), (None, 2, "m")],
        "k string, t int, v string",
    )
    assert rows(keep_latest(df, ["k"], ["t", "v"])) == [("a", 2, "q"), ("b", 1, "y"), (None, 2, "m")]


def test_keep_latest_drops_losers_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keep_latest(df, ["k"], ["id"]))
    tree = text.split("\n\n")[0]
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange") > tree.index("WindowGroupLimit")


def test_surplus_of_identical_copies_is_all_but_one(spark, tmp_path):
    data = [("hot", 1, "same")] * 500 + [("hot", 0, "old")] * 300 + [(f"k{i}", 1, "x") for i in range(50)]
    marked = mark_surplus(stored(spark, tmp_path, data, "k string, t int, v string"), ["k"], ["t", "v"])
    counts = Counter((r["k"] == "hot", r["t"], r[SURPLUS]) for r in marked.collect())
    assert counts == {
        (True, 1, False): 1,
        (True, 1, True): 499,
        (True, 0, True): 300,
        (False, 1, False): 50,
    }


def test_null_keys_and_null_times(spark, tmp_path, rows):
    data = [(None, 1), (None, 1), ("a", None), ("a", 5), ("b", None), ("b", None)]
    marked = mark_surplus(stored(spark, tmp_path, data, "k string, t int"), ["k"], ["t"])
    assert rows(marked, "k", "t", SURPLUS) == [
        ("a", 5, False),
        ("a", None, True),
        ("b", None, False),
        ("b", None, True),
        (None, 1, False),
        (None, 1, False),
    ]


def test_drop_copies_uses_the_columns_there_are(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, t int")
    assert rows(drop_copies(df, ["k", "absent"]), "k") == [("a",), ("b",)]
    assert drop_copies(df, ["absent"]).count() == 3


def test_no_window_over_the_key(spark, tmp_path, plan):
    marked = mark_surplus(stored(spark, tmp_path, [("a", 1), ("a", 2)], "k string, t int"), ["k"], ["t"])
    assert "Window" not in plan(marked)


def test_only_rows_of_repeated_keys_are_sorted(spark, tmp_path, monkeypatch):
    """The keys of all rows are counted by hash; the maximum over text, which sorts, sees copies alone."""
    settled = []
    real = dedupe.settle_measured
    monkeypatch.setattr(dedupe, "settle_measured", lambda df, label: settled.append((label, df)) or real(df, label))
    data = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]
    mark_surplus(stored(spark, tmp_path, data, "k string, t int, v string"), ["k"], ["t", "v"])
    plans = {label: df._jdf.queryExecution().executedPlan().toString() for label, df in settled}
    assert "SortAggregate" not in plans["repeated-keys"] and "HashAggregate" in plans["repeated-keys"]
    assert "_repeated" in plans["kept-copies"]


MIXED = [
    *[("hot", i % 7, "x") for i in range(400)],
    *[("hot", 6, "y")] * 3,
    *[(f"k{i % 40}", i % 3, "z") for i in range(100)],
    *[(None, 1, "n")] * 5,
    ("one", None, "x"),
    ("two", None, "x"),
    ("two", None, "x"),
]


def by_id(marked):
    return sorted((r["_row_file"], r["_row_number"], r["k"] or "", r[SURPLUS]) for r in marked.collect())


def test_too_many_repeated_keys_to_broadcast_give_the_same_marks(spark, tmp_path):
    """With and without a key that is too frequent to be ranked in one task."""
    df = stored(spark, tmp_path, MIXED, "k string, t int, v string")
    small = mark_surplus(df, ["k"], ["t", "v"])
    assert Counter(r[SURPLUS] for r in small.collect()) == {True: 402 + 60 + 1, False: 1 + 40 + 5 + 1 + 1}
    for rows_per_task in (1_000, 50):
        ranked = mark_surplus(df, ["k"], ["t", "v"], limit_bytes=-1, rows_per_task=rows_per_task)
        assert ranked.columns == small.columns
        assert by_id(ranked) == by_id(small)
        kept = dedupe.kept_copies(df, ["k"], ["t", "v"], limit_bytes=-1)
        assert by_id(dedupe.with_surplus(df, kept, ["k"])) == by_id(small)


def test_too_many_repeated_keys_to_broadcast_cost_one_shuffle_of_the_rows(spark, tmp_path, plan, monkeypatch):
    settled = []
    real = dedupe.settle_measured
    monkeypatch.setattr(dedupe, "settle_measured", lambda df, label: settled.append(label) or real(df, label))
    df = stored(spark, tmp_path, MIXED, "k string, t int, v string")
    marked = mark_surplus(df, ["k"], ["t", "v"], limit_bytes=-1)
    tree = plan(marked, "simple")
    assert tree.count("Exchange") == 1 and "Join" not in tree
    assert settled == ["repeated-keys", "hot-keys"]


def test_a_key_over_the_rows_of_a_task_is_not_ranked_in_one(spark, tmp_path):
    df = stored(spark, tmp_path, MIXED, "k string, t int, v string")
    marked = mark_surplus(df, ["k"], ["t", "v"], limit_bytes=-1, rows_per_task=50)
    held = marked.withColumn("part", F.spark_partition_id()).where("k = 'hot'").groupBy("part").count().collect()
    assert max(r["count"] for r in held) < 300

"""Sliced windows must equal plain windows and brute force, whatever the group sizes."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import skew


@pytest.fixture(scope="module")
def rows():
    """One key with most rows, a null key, single-row keys, ties and null values."""
    rng = random.Random(7)
    out = []
    for i in range(300):
        key = rng.choice(["hot"] * 6 + ["warm", None, "cold"])
        out.append((key, rng.randrange(12), i, rng.choice([None, 1.0, 2.0, 5.5])))
    out.append(("single", 3, 300, 4.0))
    rng.shuffle(out)
    return out


@pytest.fixture
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, id int, x double").repartition(3)


ORDER = ["v", "id"]


def grouped(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def result(frame, out):
    return {r["id"]: r[out] for r in frame.collect()}


@pytest.mark.parametrize("sliced", [False, True])
class TestWindows:
    @pytest.fixture(autouse=True)
    def limit(self, spark, sliced):
        spark.conf.set("spark.tidemark.hotGroupRows", "40" if sliced else "100000")
        yield
        spark.conf.unset("spark.tidemark.hotGroupRows")

    def test_numbered(self, df, rows):
        expected = {r[2]: i + 1 for g in grouped(rows).values() for i, r in enumerate(g)}
        assert result(skew.numbered(df, ["k"], [F.col(c) for c in ORDER], "n"), "n") == expected

    def test_numbered_without_partition(self, df, rows):
        ordered = sorted(rows, key=lambda r: (r[1], r[2]))
        expected = {r[2]: i + 1 for i, r in enumerate(ordered)}
        assert result(skew.numbered(df, [], [F.col(c) for c in ORDER], "n"), "n") == expected

    def test_lagged(self, df, rows):
        expected = {r[2]: (g[i - 1][3] if i else None) for g in grouped(rows).values() for i, r in enumerate(g)}
        assert result(skew.lagged(df, ["k"], [F.col(c) for c in ORDER], "x", "p"), "p") == expected

    @pytest.mark.parametrize("preceding", [1, 2, 7])
    def test_moving_average(self, df, rows, preceding):
        expected = {}
        for g in grouped(rows).values():
            for i, r in enumerate(g):
                window = [q[3] for q in g[max(0, i - preceding) : i + 1] if q[3] is not None]
                expected[r[2]] = pytest.approx(sum(window) / len(window)) if window else None
        got = result(skew.moving_average(df, ["k"], [F.col(c) for c in ORDER], "x", preceding, "m"), "m")
        assert got == expected

    def test_running_total_shares_ties(self, df, rows):
        expected = {}
        for g in grouped(rows).values():
            for r in g:
                seen = [q[3] for q in g if q[1] <= r[1] and q[3] is not None]
                expected[r[2]] = sum(seen) if seen else None
        assert result(skew.running_total(df, ["k"], "v", "x", "s"), "s") == expected

    @pytest.mark.parametrize("dense", [False, True])
    @pytest.mark.parametrize("descending", [False, True])
    def test_ranked(self, df, rows, dense, descending):
        expected = {}
        for g in grouped(rows).values():
            for r in g:
                before = [q[1] for q in g if (q[1] > r[1] if descending else q[1] < r[1])]
                expected[r[2]] = 1 + (len(set(before)) if dense else len(before))
        got = result(skew.ranked(df, ["k"], "v", "r", descending=descending, dense=dense), "r")
        assert got == expected

    def test_ranked_with_nulls_last(self, df, rows):
        got = result(skew.ranked(df, [], "x", "r"), "r")
        values = [r[3] for r in rows]
        for r in rows:
            better = sum(1 for v in values if v is not None and (r[3] is None or v > r[3]))
            assert got[r[2]] == 1 + better


@pytest.mark.parametrize("limit", ["40", "2"])
@pytest.mark.parametrize("kind", ["int", "double", "decimal(10,2)"])
def test_both_ways_have_the_same_rows_and_types(spark, df, kind, limit):
    typed = df.withColumn("x", F.col("x").cast(kind))
    order = [F.col(c) for c in ORDER]
    ways = {
        "sum": lambda: skew.running_rows(typed, ["k"], order, F.col("x"), "o"),
        "total": lambda: skew.running_total(typed, ["k"], "v", "x", "o"),
        "mean": lambda: skew.moving_average(typed, ["k"], order, "x", 2, "o"),
        "lag": lambda: skew.lagged(typed, ["k"], order, "x", "o"),
        "rank": lambda: skew.ranked(typed, ["k"], "x", "o"),
    }
    for build in ways.values():
        plain = build()
        spark.conf.set("spark.tidemark.hotGroupRows", limit)
        sliced = build()
        spark.conf.unset("spark.tidemark.hotGroupRows")
        assert [(f.name, f.dataType) for f in sliced.schema] == [(f.name, f.dataType) for f in plain.schema]
        assert result(sliced, "o") == result(plain, "o")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


STEPS = {
    "numbered": lambda df: skew.numbered(df, ["k"], [F.col(c) for c in ORDER], "out"),
    "lagged": lambda df: skew.lagged(df, ["k"], [F.col(c) for c in ORDER], "x", "out"),
    "moving": lambda df: skew.moving_average(df, ["k"], [F.col(c) for c in ORDER], "x", 3, "out"),
    "total": lambda df: skew.running_total(df, ["k"], "v", "x", "out"),
    "rank": lambda df: skew.ranked(df, ["k"], "v", "out"),
    "dense": lambda df: skew.ranked(df, ["k"], "v", "out", dense=True),
}


@pytest.mark.parametrize("share", ["most", "few"])
def test_rows_are_told_apart_only_where_hot_keys_hold_few_of_them(spark, small_groups, share):
    """One hot key among small ones, one of them null, with most or fewer than half of the rows."""
    hot, small = (30, 8) if share == "most" else (12, 30)
    keys = ["hot"] * hot + [None if i % 10 == 9 else f"k{i % 10}" for i in range(small)]
    rows = [(k, i * 7 % 5, i, None if i % 4 == 0 else float(i % 3)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, v int, id int, x double")
    got = {name: step(df) for name, step in STEPS.items()}
    assert ["LeftAnti" in plan(frame) for frame in got.values()] == [share == "few"] * len(got)
    spark.conf.set("spark.tidemark.hotGroupRows", "100000")
    for name, step in STEPS.items():
        plain = step(df)
        assert got[name].schema == plain.schema or [f.dataType for f in got[name].schema] == [f.dataType for f in plain.schema]
        assert result(got[name], "out") == result(plain, "out"), name


def test_group_stats_match_null_keys(df, rows):
    got = {(r["k"], r["id"]): r["n"] for r in skew.with_group_stats(df, ["k"], F.count(F.lit(1)).alias("n")).collect()}
    sizes = {k: len(g) for k, g in grouped(rows).items()}
    assert got == {(r[0], r[2]): sizes[r[0]] for r in rows}


def test_empty_input(spark, small_groups):
    empty = spark.createDataFrame([], "k string, v int, id int, x double")
    assert skew.numbered(empty, ["k"], [F.col("v")], "n").collect() == []
    assert skew.ranked(empty, [], "v", "r").collect() == []


def test_latest_per_key_limits_before_the_shuffle(df):
    plan = skew.latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan

"""Plan shapes against brute force, with chunks and hot-key limits small enough to matter."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tracewarden.plans import ordering
from tracewarden.plans.ordering import chunks_of
from tracewarden.plans.running import Previous, RunningDistinct, RunningSum, with_row_number, with_running
from tracewarden.plans.skew import split_join
from tracewarden.plans.sliding import BUCKETS_A_SECOND, trailing_counts
from tracewarden.plans.topk import first_k, k_smallest


def sample(seed, n=300):
    rnd = random.Random(seed)
    numbers = sorted(rnd.sample(range(3 * n), n))
    # One key holds a third of the rows; some keys and values are NULL.
    keys = ["hot"] * (n // 3) + [rnd.choice(["a", "b", "c", None]) for _ in range(n - n // 3)]
    rnd.shuffle(keys)
    return [(no, k, rnd.choice([1, 2, 3, None]), rnd.choice([-2, 0, 5, None])) for no, k in zip(numbers, keys)]


@pytest.mark.parametrize("seed, width", [(1, 4), (2, 16), (3, 1), (4, 100_000)])
def test_running(spark, seed, width):
    rows = sample(seed)
    total, seen, last, last_all, count = defaultdict(int), defaultdict(set), {}, None, 0
    expected = []
    for no, key, item, value in rows:
        total[key] += value or 0
        seen[key].add(item)
        count += 1
        expected.append((no, key, total[key], len(seen[key]), last.get(key), last_all, count))
        if value is not None:
            last[key] = last_all = value
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "no long, key string, item int, value int").repartition(5)
    got = with_running(df, "no", [
        RunningSum("total", ("key",), F.coalesce("value", F.lit(0))),
        RunningDistinct("items", ("key",), "item"),
        Previous("before", ("key",), F.col("value")),
        Previous("before_all", (), F.col("value")),
        RunningSum("n", (), F.lit(1)),
    ], width).select("no", "key", "total", "items", "before", "before_all", "n").orderBy("no")
    assert [tuple(r) for r in got.collect()] == expected


def test_running_over_many_chunk_groups(spark):
    step = 1 << 13
    rows = [(i * step,) for i in range(50)]
    got = with_row_number(spark.createDataFrame(rows, "no long"), "no", "n", width=1).orderBy("no").collect()
    assert [r.n for r in got] == list(range(1, 51))


def test_row_number_over_files(spark, tmp_path):
    from tracewarden.sources.logs import log_scan

    for f in range(3):
        (tmp_path / f"{f}.txt").write_text("".join(f"{f}-{i}\n" for i in range(20)))
    numbered = with_row_number(log_scan(spark, str(tmp_path)), "seq", "n", width=7)
    assert [r.line for r in numbered.orderBy("n").collect()] == [f"{f}-{i}" for f in range(3) for i in range(20)]


def test_running_keeps_rows_in_one_exchange(spark):
    df = spark.range(100).select(F.col("id").alias("no"), (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("v"))
    plan = with_running(df, "no", [
        RunningSum("a", ("k",), F.col("v")), RunningSum("b", ("k", "v"), F.col("v")), RunningSum("c", (), F.col("v")),
    ])._jdf.queryExecution().executedPlan().toString()
    # The windows over rows are above the last exchange of the rows.
    head = plan[:plan.index("Exchange")]
    assert head.count("Window [") == 3 and "Union" not in head


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_join(spark, how):
    rows = spark.createDataFrame([(i, k) for i, (_, k, _, _) in enumerate(sample(5))], "i long, key string")
    table = spark.createDataFrame([("hot", 1), ("a", 2), ("zzz", 3)], "key string, v int")
    plain = rows.join(table, "key", how)
    split = split_join(rows, table, ["key"], ["i"], how, hot_rows=10)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.select(split.columns).collect()))


def test_split_join_divides_the_hot_key(spark):
    rows = spark.range(1000).select("id", F.lit("hot").alias("key"))
    table = spark.createDataFrame([("hot", 1)], "key string, v int")
    joined = split_join(rows, table, ["key"], ["id"], hot_rows=100)
    assert joined.count() == 1000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_counts(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "a"]), rnd.randrange(0, 3000) / 8) for _ in range(400)]
    df = spark.createDataFrame(rows, "key string, t double")
    got = {(r.key, r.t): r.in_window for r in trailing_counts(df, ["key"], "t", 60).collect()}
    assert got == {
        (k, t): sum(1 for k2, t2 in rows if k2 == k and t - 60 <= t2 <= t) for k, t in set(rows)}


def test_first_and_smallest(spark):
    rows = [("a", i, f"v{(i * 7) % 5}") for i in range(20)] + [("b", 0, "z")]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    assert {r.k: r.x for r in first_k(df, ["k"], "o", F.col("v"), 3, "x").collect()} == {
        "a": ["v0", "v2", "v4"], "b": ["z"]}
    top = k_smallest(df, ["k"], "v", 2, "x")
    assert {r.k: r.x for r in top.collect()} == {"a": ["v0", "v1"], "b": ["z"]}
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_sparse_keys_give_full_chunks(spark):
    # Keys 1e9 apart, and a dense run behind a wide gap.
    far = spark.range(20_000).select((F.col("id") * 1_000_000_000).alias("no"))
    both = spark.range(10_000).select((F.col("id") + (1 << 60)).alias("no")).unionByName(far)
    for df, n in ((far, 20_000), (both, 30_000)):
        chunks = chunks_of(df, "no", 1000)
        sizes = [r.n for r in df.groupBy(chunks.of(F.col("no")).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) <= n / 1000 + 2 and max(sizes) <= 2000 and sum(sizes) == n
        groups = df.select(chunks.group(chunks.of(F.col("no"))).alias("g")).distinct().count()
        assert groups <= len(sizes)
        numbered = with_row_number(df, "no", "n", width=1000)
        assert [r.n for r in numbered.orderBy("no").collect()] == list(range(1, n + 1))


def test_ranges_are_parted(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGES", 4)
    df = spark.range(2000).select(((F.col("id") - 1000) * (1 << 50)).alias("no"))
    chunks = chunks_of(df, "no", 50)
    assert len(chunks.bounds) == 5 and chunks.parts == 10
    rows = df.select("no", chunks.of(F.col("no")).alias("c")).orderBy("no").collect()
    assert [r.c for r in rows] == sorted(r.c for r in rows)
    sizes = Counter(r.c for r in rows)
    assert len(sizes) >= 35 and max(sizes.values()) <= 100
    assert [r.n for r in with_row_number(df, "no", "n", width=50).orderBy("no").collect()] == list(range(1, 2001))


def test_trailing_counts_of_a_hot_minute_are_spread(spark):
    # 200,000 distinct times of one address in 50 seconds: no bucket of time holds more than a second's share of them.
    n = 200_000
    df = spark.range(n).select(F.lit("hot").alias("key"), (F.lit(1.7e9) + F.col("id") / 4000).alias("t"))
    got = trailing_counts(df, ["key"], "t", 20)
    bad = got.join(df.select("t", F.monotonically_increasing_id().alias("_")), "t").filter(
        F.col("in_window") != F.least(F.round((F.col("t") - 1.7e9) * 4000).cast("bigint"), F.lit(80_000)) + 1)
    assert got.count() == n and bad.count() == 0
    rows = df.groupBy(F.floor(F.col("t") * BUCKETS_A_SECOND)).count().agg(F.max("count")).first()[0]
    assert rows == 4000 / BUCKETS_A_SECOND


@pytest.mark.parametrize("key", ["no", "struct(path, block, pos)"])
def test_tasks_of_running_values_grow_with_the_chunks(spark, key):
    """A task held as many chunks as there were more of them than shuffle partitions, and sorted them all at once."""
    df = spark.range(1000).selectExpr(
        "id AS no", "'f' AS path", "0L AS block", "id AS pos", "id % 7 AS a", "id % 3 AS b").withColumn("at", F.expr(key))
    specs = [RunningSum("n", ("a",), F.lit(1).cast("bigint")), RunningSum("m", ("a", "b"), F.col("no")), RunningSum("all", (), F.lit(1).cast("bigint"))]
    got = with_running(df, "at", specs, width=10)
    assert got.rdd.getNumPartitions() == 200
    assert all(r.n == r.no // 7 + 1 and r["all"] == r.no + 1 and r.m == sum(range(r.no % 21, r.no + 1, 21)) for r in got.collect())

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import joins
from riskloom.operators import visits as vis
from riskloom.operators.keyed import latest_by_key
from riskloom.operators.running import running


@pytest.fixture(scope="module")
def fact(spark):
    hot = spark.range(900).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    other = spark.range(300).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("v"),
    )
    return hot.unionByName(other)


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)] + [("unused", 9)]
    return spark.createDataFrame(rows, "k string, w int")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_split_equals_plain_join(fact, dim, how):
    want = rows(fact.join(dim, "k", how))
    got = joins.hot_split_join(fact, dim, ["k"], how, min_hot_rows=20)
    assert rows(got) == want
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    counts = fact.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(joins.hot_split_join(fact, dim, ["k"], how, counts, 1200, 20)) == want
    assert rows(joins.hot_split_join(fact, dim, ["k"], how)) == want
    assert rows(joins.lookup_join(fact, dim, ["k"], how, limit=0)) == want
    assert rows(joins.lookup_join(fact, dim, ["k"], how)) == want


def test_hot_keys_absent_from_the_lookup_stay(fact, dim):
    cold_dim = dim.filter("k <> 'hot'")
    got = joins.hot_split_join(fact, cold_dim, ["k"], "left", min_hot_rows=20)
    assert got.count() == fact.count()


def test_measured_bytes_grow_with_the_rows(spark):
    short = spark.createDataFrame([("a", [1.0])], "s string, v array<double>")
    long = spark.createDataFrame([("a" * 1000, [1.0] * 100)] * 3, "s string, v array<double>")
    assert joins.measured_bytes(spark.createDataFrame([], "a int")) == 0
    assert joins.measured_bytes(short) < 200
    assert joins.measured_bytes(long) >= 3 * (1000 + 800)


def test_stream_join_with_a_large_dimension(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    visits = spark.range(200).select(
        F.lit("2026-01-01T00:00:00").alias("timestamp"),
        F.concat(F.lit("u"), "id").alias("user_id"),
        F.when(F.col("id") < 150, "1.1.1.1").otherwise(F.concat(F.lit("ip"), "id")).alias("ip"),
        F.lit(1).alias("session_duration"),
        F.lit(1).alias("pages_visited"),
        F.lit(False).alias("is_bot"),
        F.lit(False).alias("flag_ataque"),
    )
    visits.write.parquet(source)
    listed = spark.createDataFrame([("1.1.1.1", "X"), ("ip199", "Y")], schemas.BLACKLIST)
    stream = spark.readStream.schema(schemas.VISIT).parquet(source)
    joined = joins.lookup_join(stream, vis.one_row_per_ip(listed), ["ip"], "left", limit=0)
    query = (
        joined.writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(target)
    assert got.count() == 200
    assert got.filter("riesgo_historico = 'X'").count() == 150
    assert got.filter("riesgo_historico = 'Y'").count() == 1


def test_latest_by_key(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 1, None), (None, 1, "n")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    got = {r.k: r.v for r in latest_by_key(df, ["k"], ["t"]).collect()}
    assert got == {"a": "z", "b": None, None: "n"}


DENSE, SPARSE = (0, 1, 2, 5, 9, 10, 11, 40), (-(10**17), -1001, -3, 0, 3, 999, 10**12, 10**17 + 1)


@pytest.mark.parametrize("block, values", [(1, DENSE), (3, DENSE), (1000, DENSE), (1000, SPARSE)])
@pytest.mark.parametrize("descending", [True, False])
def test_running_total_over_blocks(spark, block, descending, values):
    data = [(k, t, (t * 7) % 5) for k in ("a", "b", None) for t in values]
    df = spark.createDataFrame(data, "k string, t bigint, v bigint")
    got = running(df, ["k"], "t", F.col("v"), block, descending=descending).collect()
    assert len(got) == len(data)
    for row in got:
        same = [(t, v) for k, t, v in data if k == row.k]
        upto = sum(v for t, v in same if (t >= row.t if descending else t <= row.t))
        assert row.running == upto


def test_running_total_over_a_million_sparse_blocks_without_a_key(spark):
    rows = spark.range(1_000_000).select((F.col("id") * 10**9 + F.col("id") % 7).alias("t"), (F.col("id") % 10).alias("v"))
    got = running(rows, [], "t", F.col("v"), 1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    # No window of totals holds more than the blocks of one block.
    widest = rows.selectExpr("t div 1000000 AS block", "t div 1000 AS own").groupBy("block").agg(F.count_distinct("own").alias("n"))
    assert widest.agg(F.max("n")).first()[0] <= 2000
    n = F.floor(F.col("t") / 10**9)
    want = F.floor(n / 10) * 45 + (n % 10) * (n % 10 + 1) / 2
    assert got.filter(F.col("running") != want).count() == 0 and got.count() == 1_000_000


def test_running_totals_of_equal_numbers_follow_the_ties(spark):
    rows = [("k", 1, v, name) for v, name in ((1, "a"), (2, "b"), (4, "c"))] + [("k", None, 8, "d")]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint, name string")
    for block in (2, 1000):
        got = running(df, ["k"], "t", F.col("v"), block, ties=(F.desc("name"),)).collect()
        assert {r.name: r.running for r in got} == {"d": 8, "c": 12, "b": 14, "a": 15}

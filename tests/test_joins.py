import pytest
from conftest import rows
from pyspark.sql import functions as F

from floorwatch.operators import joins


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows under one key, a third copies of one row without a key."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"),
        F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id")).alias("v"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k2", 3), ("k5", 4), (None, 5), ("none", 6)], "key string, w long"
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_shuffled_join_equals_broadcast_join(facts, dim, how):
    also = F.col("w") < 4
    small = joins.dim_join(facts, dim, [("k", "key")], how, also, limit=1 << 30)
    large = joins.dim_join(facts, dim, [("k", "key")], how, also, limit=0, salts=7)
    position = joins.dim_join(
        facts, dim, [("k", "key")], how, also, limit=0, spread=F.monotonically_increasing_id()
    )
    assert small.columns == large.columns
    assert rows(small) == rows(large) == rows(position)


def test_plans_follow_the_measured_size(facts, dim):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert joins.measured_bytes(dim) > len("hothotk2k5none")
    assert "BroadcastHashJoin" in plan(joins.dim_join(facts, dim, [("k", "key")]))
    assert "_salt" in plan(joins.dim_join(facts, dim, [("k", "key")], limit=0))


def test_hot_keys(facts):
    found = rows(joins.hot_keys(facts, ["k"], parts=10))
    assert found == [("hot",), (None,)]


def test_hot_key_rows_are_spread(facts, dim):
    joined = joins.dim_join(facts, dim, [("k", "key")], "inner", limit=0, fits=False, salts=8)
    # Every hot row meets both of its dimension rows exactly once.
    assert joined.filter("k = 'hot'").count() == 2000

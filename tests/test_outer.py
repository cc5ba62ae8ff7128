"""The full outer merge with hot keys against the plain full outer join."""
import pytest

from starledger.operators.joins import outer_merge
from starledger.operators.outer import _dealt, _hot_keys, outer_merge_hot


def sides(spark):
    left = [(1, "x", i % 50) for i in range(400)] + [(k, "y", k) for k in range(2, 60)] + [(None, "x", 1), (5, None, 2), (900, "h", 0)] + [(700, "h", i) for i in range(90)]
    right = [(1, "x", f"r{i % 20}") for i in range(40)] + [(k, "y", "s") for k in range(30, 90)] * 2 + [(None, "x", "n"), (800, "h", "z")] + [(801, "h", "same")] * 90
    return (spark.createDataFrame(left, "a int, b string, v int"), spark.createDataFrame(right, "a int, b string, w string"))


@pytest.mark.parametrize("share", [0.0, 0.01, 0.05, 1.0])
def test_equals_the_full_outer_join(spark, share):
    left, right = sides(spark)
    got, want = outer_merge_hot(left, right, ["a", "b"], share), outer_merge([left, right], ["a", "b"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_sides(spark):
    left, right = sides(spark)
    assert outer_merge_hot(left.limit(0), right, ["a", "b"]).count() == right.count()
    assert outer_merge_hot(left, right.limit(0), ["a", "b"]).count() == left.count()
    assert outer_merge_hot(left.limit(0), right.limit(0), ["a", "b"]).count() == 0


def test_a_hot_key_is_dealt_to_many_cells(spark):
    left, right = sides(spark)
    hot = _hot_keys(left, right, ["a", "b"], 0.02)
    assert hot.count() <= 2 / 0.02
    cells = _dealt(left.join(hot, ["a", "b"]).where("a = 1"), "_l", "_r", "_lt").groupBy("__l", "__r").sum("_lt").collect()
    assert len({c["__l"] for c in cells}) > 10 and max(c["sum(_lt)"] for c in cells) < 400 / 4
    assert sum(c["sum(_lt)"] for c in cells if c["__r"] == 0) == 400

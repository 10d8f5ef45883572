"""Lists of the adaptive silhouette tree."""

from covaria.operators.adaptive import _lists


def test_even_leaves_are_far_through_their_own_grid_only(spark):
    """On an even tree no (leaf, far cell) pair is listed, and leaves are near at most nine."""
    rows = [(lv, i, j, lv == 4) for lv in range(5) for i in range(2**lv) for j in range(2**lv)]
    near, apart = _lists(spark.createDataFrame(rows, "level int, ix long, iy long, leaf boolean"))
    assert near.count() == sum(min(i + 1, 15) - max(i - 1, 0) + 1 for i in range(16)) ** 2
    assert apart is None or apart.count() == 0

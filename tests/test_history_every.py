"""The forward set at every size, per run."""

from covaria.operators.history import replay_forward_every


def test_every_size_per_run(spark):
    rows = [
        ("a", 1, ["x", "y"], 2), ("a", 2, ["z"], 3), ("a", 3, ["w"], 4), ("a", 4, [], 4),
        ("b", 1, ["q"], 1), ("b", 2, ["r", "s"], 3),
    ]
    history = spark.createDataFrame(rows, "run string, step int, feature_added array<string>, total_features int")
    found = sorted(tuple(r) for r in replay_forward_every(history, "run").collect())
    assert found == [
        ("a", 1, 2, "x,y"), ("a", 2, 3, "x,y,z"), ("a", 3, 4, "x,y,z,w"),
        ("b", 1, 1, "q"), ("b", 2, 3, "q,r,s"),
    ]
    one = replay_forward_every(history.where("run = 'b'").drop("run"))
    assert [tuple(r) for r in one.orderBy("step").collect()] == [(1, 1, "q"), (2, 3, "q,r,s")]
    assert replay_forward_every(history.limit(0), "run").count() == 0

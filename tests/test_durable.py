import pytest

from covaria.operators import durable


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


class _Session:
    def __init__(self, context, named=None):
        self.sparkContext, self.named, self.conf = context, named, self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default


def test_the_folder_the_cluster_names_is_used():
    context = _Context("spark://host:7077")
    durable._ensure_checkpoint_dir(_Session(context, "hdfs:///shared/checkpoints"))
    assert context.current == "hdfs:///shared/checkpoints"


def test_a_folder_already_set_stays():
    context = _Context("local[2]", "file:/set/before")
    durable._ensure_checkpoint_dir(_Session(context, "hdfs:///other"))
    assert context.current == "file:/set/before"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        durable._ensure_checkpoint_dir(_Session(_Context("yarn")))


def test_settled_rows_are_the_same(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    settled = durable.settle(df)
    assert settled.columns == ["id", "twice"] and settled.count() == 100
    assert settled.exceptAll(df).count() == 0


def test_stored_rows_are_the_same_and_can_be_removed(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    table = durable.stored(df)
    assert table.schema == df.schema or table.columns == df.columns
    assert table.exceptAll(df).count() == 0 and table.count() == 100
    assert durable.stored(df.limit(0)).count() == 0
    durable.forget(spark)
    with pytest.raises(Exception):
        table.count()

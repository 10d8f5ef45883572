"""A key passed as label stops the pass inside the tasks, before class vectors pile up."""

import pytest

from covaria.operators import merged, moments
from covaria.operators.features import FeatureTable


@pytest.mark.parametrize("fit", [moments.fit_moments, merged.merged_moments])
def test_too_many_classes_stop_in_the_tasks(spark, monkeypatch, fit):
    monkeypatch.setattr(moments, "MAX_CLASSES", 50)
    monkeypatch.setattr(merged, "MAX_CLASSES", 50)
    rows = [(f"key{i}", [float(i), float(i % 7)]) for i in range(400)]
    df = spark.createDataFrame(rows, "label string, x array<double>").repartition(1)
    table = FeatureTable.of(df, ["a", "b"], "label", array="x")
    with pytest.raises(Exception, match="more than 50 distinct values in one task"):
        fit(table)

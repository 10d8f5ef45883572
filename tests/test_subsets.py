"""PCA of many subsets as one job, against fits on the driver."""

import numpy as np
import pytest

from covaria.operators.moments import fit_moments
from covaria.operators.pca import pca_from_moments
from covaria.operators.subsets import pca_of_subsets
from covaria.plans import bindings as B


def test_ten_thousand_subsets(spark, sf_dir):
    moments = fit_moments(B.vectors(spark, sf_dir))
    names = list(moments.features)
    rng = np.random.default_rng(1)
    subsets = [(k, [names[j] for j in rng.choice(64, size=rng.integers(1, 12), replace=False)]) for k in range(10_000)]
    subsets += [(10_000, None), (10_001, ["nothing", "e1", "e1"]), (10_002, ["e1", "e2", "e2", "missing"])]
    table = spark.createDataFrame(subsets, "subset_id long, features array<string>").repartition(8)
    found = {r["subset_id"]: r for r in pca_of_subsets(spark, moments, table).collect()}
    assert len(found) == len(subsets)
    for k, features in subsets[::97] + subsets[-3:]:
        chosen = sorted(set(f for f in (features or []) if f in names), key=names.index)
        row = found[k]
        assert row["n_features"] == len(chosen)
        if len(chosen) < 2:
            assert row["pc1_percent"] is None and row["pc2_percent"] is None
            continue
        model = pca_from_moments(moments.subset(chosen))
        assert row["pc1_percent"] == pytest.approx(model.explained_percent[0], abs=1e-9)
        assert row["pc2_percent"] == pytest.approx(model.explained_percent[1], abs=1e-9)
    assert pca_of_subsets(spark, moments, table.limit(0)).count() == 0

"""PCA of many feature subsets as one job.

Refitting a PCA on a subset needs only the submatrix of the correlation matrix. Subsets come
as a table (``subset_id``, ``features``: an array of names), so there may be any number of
them; the correlation matrix and the names of usable features go to the executors once, as a
broadcast whose size is checked first, and each task solves the subsets of its rows. Nothing
loops over subsets on the driver.

A subset keeps its usable features (``profile.usable_features`` under the policy); names
that are not features, or repeated, count once or not at all. Fewer than two usable features
give NULL percentages, like ``pca.pca_by_group``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from covaria.operators.moments import Moments
from covaria.operators.profile import usable_features

#: The correlation matrix is sent to every executor up to this size.
BROADCAST_BYTES = 64 << 20

RESULT = "subset_id long, n_features int, pc1_percent double, pc2_percent double"


def pca_of_subsets(spark: SparkSession, moments: Moments, subsets: DataFrame, nan_policy: str = "drop_column") -> DataFrame:
    """One row per subset: usable features and the percent of variance of the first two components."""
    used = usable_features(moments.scaling, nan_policy)
    at = {f: j for j, f in enumerate(moments.features)}
    keep = np.array([at[f] for f in used], dtype=np.int64)
    r = moments.correlation()[np.ix_(keep, keep)] if len(keep) else np.zeros((0, 0))
    if r.nbytes > BROADCAST_BYTES:
        raise ValueError(f"{len(keep)} usable features: the correlation matrix exceeds {BROADCAST_BYTES} bytes")
    shared = spark.sparkContext.broadcast((list(used), r))

    def solve(frames):
        names, matrix = shared.value
        place = {f: j for j, f in enumerate(names)}
        for frame in frames:
            ids, counts, first, second = [], [], [], []
            for subset_id, features in zip(frame["subset_id"], frame["features"]):
                chosen = sorted({place[f] for f in (features if features is not None else []) if f in place})
                ids.append(subset_id)
                counts.append(len(chosen))
                if len(chosen) < 2:
                    first.append(None)
                    second.append(None)
                    continue
                sub = matrix[np.ix_(chosen, chosen)]
                values = np.linalg.eigvalsh(sub)[::-1]
                total = float(np.trace(sub))
                pct = np.maximum(values[:2], 0.0) / total * 100.0 if total > 0 else np.zeros(2)
                first.append(float(pct[0]))
                second.append(float(pct[1]))
            yield pd.DataFrame({"subset_id": ids, "n_features": counts, "pc1_percent": first, "pc2_percent": second})

    return subsets.select("subset_id", "features").mapInPandas(solve, RESULT)

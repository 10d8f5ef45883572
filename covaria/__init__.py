"""Multivariate analysis of numeric tables as Spark jobs.

Sub-packages
------------
sources     readers for sample, entity and pair tables; feature catalogue and categories
functions   column expressions shared by the operators
operators   profile, scaling, moments, PCA, pair links, PLS-DA, metrics, selection, history
plans       whole analyses composed from the operators
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions sent to executors carry their code along, so that a cluster needs no copy of
# this package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

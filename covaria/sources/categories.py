"""Element categories and the class-from-category lookups built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Category name and its element symbols.
ELEMENT_CATEGORIES = (
    ("alkali_metals", ("Li", "Na", "K", "Rb", "Cs", "Fr")),
    ("alkaline_earth_metals", ("Be", "Mg", "Ca", "Sr", "Ba", "Ra")),
    ("transition_metals", ("Sc", "Ti", "V", "Cr", "Mn", "Fe", "Co", "Ni", "Cu", "Zn", "Y", "Zr", "Nb", "Mo", "Tc", "Ru", "Rh", "Pd", "Ag", "Cd", "Hf", "Ta", "W", "Re", "Os", "Ir", "Pt", "Au", "Hg", "Rf", "Db", "Sg", "Bh", "Hs", "Mt", "Ds", "Rg", "Cn")),
    ("lanthanides", ("La", "Ce", "Pr", "Nd", "Pm", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm", "Yb", "Lu")),
    ("actinides", ("Ac", "Th", "Pa", "U", "Np", "Pu", "Am", "Cm", "Bk", "Cf", "Es", "Fm", "Md", "No", "Lr")),
    ("metalloids", ("B", "Si", "Ge", "As", "Sb", "Te", "Po")),
    ("non_metals", ("H", "C", "N", "O", "P", "S", "Se")),
    ("halogens", ("F", "Cl", "Br", "I", "At", "Ts")),
    ("noble_gases", ("He", "Ne", "Ar", "Kr", "Xe", "Rn", "Og")),
    ("post_transition_metals", ("Al", "Ga", "In", "Sn", "Tl", "Pb", "Bi", "Nh", "Fl", "Mc", "Lv")),
)

# Fixed value: category of a symbol that no category lists.
UNKNOWN_CATEGORY = "other"

# Bound on what the inverted table takes: some hundred symbols with the name of a category.
CATEGORY_BYTES = 16 * 1024

_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType(), False),
        T.StructField("ord", T.IntegerType(), False),
        T.StructField("symbols", T.ArrayType(T.StringType(), False), False),
    ]
)


def element_categories(spark: SparkSession) -> DataFrame:
    """One row per category: ``category, ord, symbols ARRAY<STRING>``."""
    rows = [(name, ord_, list(symbols)) for ord_, (name, symbols) in enumerate(ELEMENT_CATEGORIES)]
    return spark.createDataFrame(rows, _SCHEMA)

"""Operations of a training-data pipeline over tables of documents.

Nothing outside this package imports it; ``queries`` and ``oracle_sql`` hand its registered
queries to the entry module.
"""

from covaria.llm.queries import QUERIES
from covaria.llm.sql import ORACLES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

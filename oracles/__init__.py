"""The registered queries once more, as SQL over the same tables."""

from oracles.sql import oracle_sql  # noqa: F401

"""Driver queries: every operator on a mapping of the test tables, and its SQL twin."""

from hubcat.queries import citations, models, papers, ranking, sources, weekly

_PARTS = (models, papers, citations, ranking, weekly, sources)


def queries():
    return {k: v for part in _PARTS for k, v in part.QUERIES.items()}


def oracle_sql():
    return {k: v for part in _PARTS for k, v in part.ORACLE.items()}

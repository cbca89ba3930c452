"""All registered queries."""

from cellindex.catalog import cells, documents, indexes, registry, streams  # noqa: F401


def all_queries():
    return dict(registry.QUERIES)


def all_sql():
    return dict(registry.SQL)

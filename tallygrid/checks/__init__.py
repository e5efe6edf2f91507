"""Registered queries with the SQL that verifies each of them."""


def _load() -> None:
    from tallygrid.checks import context_queries, load_queries, metric_queries, operator_queries  # noqa: F401


def all_queries():
    from tallygrid.checks import registry

    _load()
    return dict(registry.QUERIES)


def all_oracles():
    from tallygrid.checks import registry

    _load()
    return dict(registry.ORACLES)

"""All registered queries and their oracle SQL."""

from importlib import import_module

MODULES = (
    "views", "core", "finance", "supply", "commercial", "governance", "actions", "detection",
    "documents", "search", "forecasting", "memory", "evaluation", "jobs", "sqlcalls",
)


def collect():
    queries, oracles = {}, {}
    for name in MODULES:
        reg = import_module(f"{__name__}.{name}").REG
        clash = queries.keys() & reg.queries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        queries.update(reg.queries)
        oracles.update(reg.oracles)
    return queries, oracles

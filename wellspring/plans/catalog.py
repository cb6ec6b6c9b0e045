"""All registered queries and their oracle SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("queries", "queries_lab", "queries_cells", "queries_text", "queries_io", "queries_sources", "queries_flows")


def _load() -> None:
    for m in _MODULES:
        import_module(f"{__package__}.{m}")


def all_queries() -> dict:
    _load()
    from .queries import REGISTRY

    return dict(REGISTRY)


def all_oracle_sql() -> dict:
    _load()
    from .oracle import ORACLE

    return dict(ORACLE)

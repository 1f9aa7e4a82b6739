"""Every operator as a named query over the given tables, with its SQL twin."""

from presswork.catalog.registry import CATALOG, Query


def load() -> dict[str, Query]:
    from presswork.catalog import (  # noqa: F401
        cleaning,
        features,
        invariants,
        models,
        scores,
        similarity,
        tables,
        vectors,
    )

    return CATALOG


__all__ = ["CATALOG", "Query", "load"]

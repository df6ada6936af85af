"""Registry of the queries exposed to the driver: key -> fn(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from annolytics.plans import oracle

QUERIES: dict[str, Callable] = {}

# Hold-out rules for the driver's annotation view (annotators are U00..U24;
# U07 plays the hold-out annotator, U03 with sources containing SRC1 the
# pattern rule).
DRIVER_RULES = (("U07", None), ("U03", "SRC1"))
# Rushed-annotator threshold in seconds for the driver's view, where duplicate
# resolution leaves few short lead times (the library's default is 10).
DRIVER_MIN_MEAN_LEAD = 80.0


def query(key: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB twin (omit for rows-only)."""

    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            oracle.register(key, sql)
        return fn

    return deco


def load_all() -> None:
    # Importing the modules fills the registry.
    from annolytics.plans import (  # noqa: F401
        cleaning,
        profiling,
        metrics,
        annotators,
        textual,
        ingest,
        training,
    )

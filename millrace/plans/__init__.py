"""The reference's own operators as runnable queries over the driver's tables."""

from __future__ import annotations

from millrace.plans import aggregates, companies, directories, documents, events, linking, pages, ranking, records, registry, scalars, storing, streams, texts, validation  # noqa: F401

FLAGSHIP = "pages_by_domain"


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict:
    return dict(registry.ORACLES)

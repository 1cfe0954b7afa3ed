"""All registered queries, gathered from the catalog modules."""

from __future__ import annotations


def all_queries():
    from tidecast.plans import catalog, catalog_models, catalog_nulls, catalog_trees  # noqa: F401  (registers its queries on import)
    return dict(catalog.QUERIES)

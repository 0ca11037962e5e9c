"""Registered queries over the driver tables, each next to its SQL."""

from __future__ import annotations

from savormap.plans.registry import REGISTRY, Entry


def load_all() -> dict[str, Entry]:
    """All registered queries; importing a module registers its queries."""
    from savormap.plans import (  # noqa: F401
        geo_queries,
        metric_queries,
        model_queries,
        recommend_queries,
        shaping_queries,
        source_queries,
        stream_queries,
        text_queries,
    )

    return dict(REGISTRY)

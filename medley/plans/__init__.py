"""Every operator applied to whole tables, with the SQL that must give the same rows."""

from medley.plans import business, extraction, loading, quality, relational, scalars, series, storage
from medley.plans.base import REGISTRY

__all__ = ["REGISTRY", "business", "extraction", "loading", "quality", "relational", "scalars", "series", "storage"]

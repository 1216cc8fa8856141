"""All registered queries."""

from panelwright.plans import catalog_checks, catalog_extended, catalog_features, catalog_metrics, catalog_model, catalog_panel, catalog_profile  # noqa: F401
from panelwright.plans.registry import CATALOG

__all__ = ["CATALOG"]

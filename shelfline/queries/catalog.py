"""Imports every query module so that its registrations exist."""

from shelfline.queries.registry import ORACLES, PLANS
from shelfline.queries import checks, distincts, files, kpi_store, kpis, layers, primitives, reports, streams  # noqa: F401

__all__ = ["ORACLES", "PLANS"]

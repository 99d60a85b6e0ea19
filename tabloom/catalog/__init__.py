"""Every operator as a query on the test tables, with the DuckDB text of the same result."""

from __future__ import annotations

from tabloom.catalog import cleaning, evaluation, fitting, grouping, searching
from tabloom.catalog.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query", "cleaning", "evaluation", "fitting", "grouping", "searching"]

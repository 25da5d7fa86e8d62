"""tillroll: the retail sales cube, its top-k queries, load contracts and
row-count reports as distributed Spark DataFrame jobs.

The main entry points, importable from the package root (loaded on first
use)::

    from tillroll import sales_cube, top_products, run_weekly
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "configure": "tillroll.session",
    "read_sales": "tillroll.sources.files",
    "read_sales_csv": "tillroll.sources.files",
    "read_jdbc": "tillroll.sources.files",
    "generate_sales": "tillroll.sources.generator",
    "sales_cube": "tillroll.plans.cube",
    "top_products": "tillroll.operators.topk",
    "top_products_from_cells": "tillroll.operators.topk",
    "top_products_sql": "tillroll.operators.topk",
    "chart_labels": "tillroll.operators.presentation",
    "dashboard_region": "tillroll.operators.presentation",
    "dashboard_product": "tillroll.operators.presentation",
    "dashboard_period": "tillroll.operators.presentation",
    "dashboard_query": "tillroll.operators.presentation",
    "sales_contract": "tillroll.operators.contracts",
    "rowstore_cube": "tillroll.operators.contracts",
    "warehouse_cube": "tillroll.operators.contracts",
    "pk_violations": "tillroll.operators.contracts",
    "row_counts": "tillroll.operators.monitoring",
    "catalog_row_counts": "tillroll.operators.monitoring",
    "estimated_row_counts": "tillroll.operators.monitoring",
    "row_count_report": "tillroll.operators.monitoring",
    "write_sales_csv": "tillroll.sources.sinks",
    "write_parquet": "tillroll.sources.sinks",
    "refresh_table": "tillroll.sources.sinks",
    "write_jdbc": "tillroll.sources.sinks",
    "run_weekly": "tillroll.plans.weekly",
}

__all__ = list(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'tillroll' has no attribute {name!r}")

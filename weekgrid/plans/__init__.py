"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

import importlib

MODULES = ["core", "profile", "evaluate", "series", "quality", "products", "models"]


def _load():
    for name in MODULES:
        importlib.import_module(f"weekgrid.plans.{name}")
    return importlib.import_module("weekgrid.plans.registry")


def all_queries():
    return dict(_load().QUERIES)


def all_sql():
    return dict(_load().SQL)

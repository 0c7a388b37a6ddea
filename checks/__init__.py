"""Queries for the driver, each with a SQL twin where SQL can express it."""

from __future__ import annotations

from importlib import import_module

MODULES = ["tables", "gold", "reports", "ops", "quality", "audit", "flows"]


def all_checks() -> None:
    for name in MODULES:
        import_module(f"checks.{name}")

"""Queries over the test tables, by topic."""

from __future__ import annotations

import importlib
from types import ModuleType

MODULES = ("problems", "cleaning", "linking", "reporting")


def modules() -> list[ModuleType]:
    return [importlib.import_module(f"shelfmark.plans.{m}") for m in MODULES]

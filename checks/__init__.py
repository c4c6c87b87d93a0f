"""Registered queries over the bound tables, each with the SQL that must agree."""

from __future__ import annotations

import importlib

FAMILIES = ("models", "funnels", "cohorts", "experiments", "business", "trust", "pipelines", "relational")


def load():
    for family in FAMILIES:
        importlib.import_module(f"checks.{family}")
    return importlib.import_module("checks.registry")

"""Registered queries by family; importing a module registers its queries."""

from __future__ import annotations

import importlib

FAMILIES = (
    "gates",
    "naming",
    "texts",
    "geometry",
    "ledger",
    "matching",
    "joins",
    "runs",
    "censuses",
    "vectors",
    "rasters",
    "sets",
    "feeds",
    "streams",
    "extensions",
)


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"tidemark.plans.{family}")

"""Operators for training corpora; nothing else in the library imports this package."""

from __future__ import annotations

import importlib


def load() -> None:
    """Register the queries of the ten operators with the catalog."""
    importlib.import_module("ledgerloom.llm.queries")

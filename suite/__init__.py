"""Registered queries over the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType

DOMAINS = ("market", "explore", "history", "rentals", "text", "catalog", "feeds", "documents")


def load() -> ModuleType:
    """The registry with every domain's queries in it."""
    for domain in DOMAINS:
        import_module(f"suite.{domain}")
    return import_module("suite.registry")

"""Queries by key, each with comparison SQL where SQL can express it."""

from __future__ import annotations

from importlib import import_module
from typing import NamedTuple

SECTIONS = ("prep", "labels", "signals", "evaluation", "learning")


class Registry(NamedTuple):
    queries: dict
    oracles: dict


def load() -> Registry:
    from tallyloom.registry import base

    for section in SECTIONS:
        import_module(f"tallyloom.registry.{section}")
    return Registry(dict(base.QUERIES), dict(base.ORACLES))

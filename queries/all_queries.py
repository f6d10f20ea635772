from __future__ import annotations

import importlib

MODULES = ["records", "texts", "html", "portugal", "france", "germany", "runs", "upkeep"]


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"queries.{name}")

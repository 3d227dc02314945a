"""Imports every query module, which registers its queries."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("feature_queries", "select_queries", "shard_queries", "training_queries", "source_queries", "model_queries", "stream_queries")


def load() -> None:
    for name in _MODULES:
        import_module(f"{__package__}.{name}")


load()

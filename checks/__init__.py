"""The queries of `__spark_entry__`: each operator run over whole tables, with
the same result written as SQL for an independent engine where SQL can say it."""

from importlib import import_module

from .registry import ORACLE, QUERIES

for _module in ("bronze", "policy", "text", "pages", "ranking", "vectors", "graph", "streams"):
    import_module(f"{__name__}.{_module}")

__all__ = ["ORACLE", "QUERIES"]

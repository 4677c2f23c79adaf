"""Intermediate tables of the corpus operators: those of ``placeloom.stored``, in the folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

from ..stored import bucketed, new_path, observed, release, root, table, tables, tidy

__all__ = ["bucketed", "new_path", "observed", "release", "root", "table", "tables", "tidy"]

"""Helpers for wide expression lists written as SQL text.

Feature tables have dozens of columns; one selectExpr call with text is parsed
once on the JVM, where building every column through the Python API costs
several calls per column.
"""

from __future__ import annotations

import math


def name(column: str) -> str:
    """Quoted column reference."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """Double literal that keeps every bit; NaN and infinities have no literal of their own."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"


def rows(structs: list[str]) -> str:
    """Generator that turns each struct(...) text into one output row."""
    return f"inline(array({', '.join(structs)}))"

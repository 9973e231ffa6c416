"""Column names that no column has yet."""

from __future__ import annotations

from collections.abc import Iterable


def fresh_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name

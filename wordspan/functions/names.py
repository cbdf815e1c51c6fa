"""Names of helper columns that clash with none of the input's."""

from __future__ import annotations

from collections.abc import Iterable


def free(taken: Iterable[str], *wanted: str) -> list[str]:
    """Each wanted name, with underscores before it until nothing in `taken` is called so; case doesn't matter."""
    held = {name.lower() for name in taken}
    out = []
    for name in wanted:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """The name as it is written in an expression, whatever stands in it."""
    return f"`{name.replace('`', '``')}`"

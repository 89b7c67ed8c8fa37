"""Pieces shared by the comparison SQL."""

from __future__ import annotations

from collections.abc import Iterable


# White space, spelled out for an engine whose \s is ASCII.
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def quoted(words: Iterable[str]) -> str:
    """A list of SQL text literals."""
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def half_up(total: str, count: str, digits: int) -> str:
    """``total / count`` of whole numbers, rounded half away from zero without a floating-point tie."""
    scale = 10**digits
    return f"(sign({total}) * ((abs({total}) * {2 * scale} + {count}) // (2 * {count})) / {scale}.0)::DOUBLE"

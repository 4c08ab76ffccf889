"""Numbers and times as people read them."""

from __future__ import annotations

UNITS = ("B", "kB", "MB", "GB", "TB", "PB", "EB")
SPANS = (("day", 86400), ("hour", 3600), ("minute", 60), ("second", 1))


def size_text(n_bytes: float) -> str:
    """A size in the largest unit of thousands that it reaches."""
    value, unit = float(n_bytes), 0
    while abs(value) >= 1000 and unit < len(UNITS) - 1:
        value, unit = value / 1000, unit + 1
    return f"{value:.0f} {UNITS[0]}" if unit == 0 else f"{value:.2f} {UNITS[unit]}"


def ago_text(seconds: float) -> str:
    """How long ago something was, in the largest unit of which it has one whole."""
    for name, span in SPANS:
        if seconds >= span:
            n = int(seconds // span)
            return f"{n} {name}{'s' if n > 1 else ''} ago"
    return "just now"

"""Order-insensitive comparison of two results given as columns and rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal


def _text(value) -> str:
    """Text that shows the kind of a value as well, so 1, 1.0 and '1' differ."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{round(value, 9) + 0.0!r}"
    if isinstance(value, Decimal):
        return f"d:{value:f}"
    if isinstance(value, datetime):
        return f"t:{value.replace(tzinfo=None).isoformat()}"
    if isinstance(value, date):
        return f"D:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_text(v) for v in value) + "]"
    return f"s:{value}"


def _lines(columns: Sequence[str], rows: Sequence[Sequence]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("\t".join(_text(row[i]) for i in order) for row in rows)


def difference(our_columns, our_rows, their_columns, their_rows) -> str | None:
    """None when both hold the same rows, else a short description."""
    if sorted(our_columns) != sorted(their_columns):
        return f"columns differ: {sorted(set(our_columns) ^ set(their_columns))}"
    if len(our_rows) != len(their_rows):
        return f"{len(our_rows)} rows against {len(their_rows)}"
    if not our_rows:
        return "both are empty"
    a, b = _lines(our_columns, our_rows), _lines(their_columns, their_rows)
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if not wrong:
        return None
    return f"{len(wrong)} rows differ\n   {', '.join(sorted(our_columns))}\n   {wrong[0][0]}\n   {wrong[0][1]}"

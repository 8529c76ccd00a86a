"""Text in SQL, and membership tests on the text form of a field.

Expressions that would take many small calls from Python are written as one
piece of SQL; the helpers here quote what goes into it.
"""

from __future__ import annotations

from collections.abc import Iterable


def name(column: str) -> str:
    """A column name, quoted for SQL."""
    return "`" + column.replace("`", "``") + "`"


def names(columns: Iterable[str]) -> str:
    return ", ".join(name(c) for c in columns)


def literal(text: str) -> str:
    """A string, quoted for SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_values(values: str | list[str] | tuple[str, ...]) -> list[str]:
    """A comma-separated list: trailing empty entries go, nothing is trimmed.

    Lists are taken as they are.
    """
    if not isinstance(values, str):
        return list(values)
    if "," not in values:
        return [values]
    kept = values.rstrip(",")
    return kept.split(",") if kept else []


def text_form(field: str, match_null: bool = True) -> str:
    """A field as text, in SQL; null reads as the text ``null`` if that is to match."""
    text = f"CAST({field} AS STRING)"
    return f"coalesce({text}, 'null')" if match_null else text


def text_in(text: str, values: list[str]) -> str:
    """SQL that is true where a text is in the list, and false otherwise."""
    listed = ", ".join(literal(v) for v in values)
    return f"coalesce({text} IN ({listed}), false)" if values else "false"

"""Name handling shared by all modules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Name = str | Column


def col(name: Name) -> Column:
    """Column by its plain name: dots and blanks belong to the name, they never mean a struct field."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: str | Iterable[str] | None) -> list[str]:
    """One name or several, as a list."""
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def ordering(order_by: Name | Iterable[Name]) -> list[Column]:
    """Sort columns with nulls first in both directions; ``"-name"`` sorts downwards."""
    names = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    out = []
    for name in names:
        if isinstance(name, Column):
            out.append(name)
        elif name.startswith("-"):
            out.append(col(name[1:]).desc_nulls_first())
        else:
            out.append(col(name).asc_nulls_first())
    return out

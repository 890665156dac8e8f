"""One check of a frame's columns against what a step needs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def expect_columns(
    df: DataFrame,
    needed: Iterable[str],
    what: str,
    *,
    allowed: Iterable[str] | None = None,
    numeric: Iterable[str] = (),
) -> None:
    """Raise one ``ValueError`` that lists everything wrong with the columns of ``df``.

    ``allowed``: no columns but these and the needed ones. ``numeric``: these must hold numbers or booleans.
    """
    types = {f.name: f.dataType for f in df.schema}
    needed = list(needed)
    absent = [c for c in needed if c not in types]
    surplus = [] if allowed is None else [c for c in types if c not in {*needed, *allowed}]
    mistyped = [c for c in numeric if c in types and not isinstance(types[c], (T.NumericType, T.BooleanType))]
    found = (("lacks", absent), ("does not expect", surplus), ("needs numbers in", mistyped))
    faults = [f"{verb} {', '.join(columns)}" for verb, columns in found if columns]
    if faults:
        raise ValueError(f"{what} {' and '.join(faults)}")

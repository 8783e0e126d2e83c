"""Column names: camelCase as the services send them, snake_case as the tables store them."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

# Fixed value: the boundary rule the stored column names depend on. Matches do not overlap, so a
# run of capitals splits in pairs (avgROE -> avg_ro_e).
WORD_BOUNDARY = r"(\w)([A-Z])"


def snake_name(name: str) -> str:
    """camelCase -> snake_case; names already in snake_case stay as they are."""
    return re.sub(WORD_BOUNDARY, r"\1_\2", name[:1].lower() + name[1:]).lower()


def snake_map(names: Iterable[str]) -> dict[str, str]:
    """``{camel: snake}``; two names that would meet in one column are an error."""
    mapping = {name: snake_name(name) for name in names}
    if len(set(mapping.values())) < len(mapping):
        raise ValueError(f"names collide in snake_case: {sorted(mapping)}")
    return mapping


def camel_map(mapping: dict[str, str]) -> dict[str, str]:
    """The inverse of :func:`snake_map`."""
    return {snake: camel for camel, snake in mapping.items()}


def to_snake(df: DataFrame) -> DataFrame:
    """Rename every column by the rule of :func:`snake_name`."""
    snake_map(df.columns)
    return df.toDF(*(snake_name(c) for c in df.columns))


def to_camel(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Undo :func:`to_snake` with the mapping it was made from."""
    return df.withColumnsRenamed(camel_map(mapping))

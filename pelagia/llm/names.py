"""Columns of an operator beside those of the user, whatever they are called."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame


def free(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like ``wanted`` that differ, without regard to case, from each other and from ``taken``."""
    known, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        out.append(name)
    return out


def others(df: DataFrame, made: Sequence[str]) -> list[str]:
    """Columns that stay beside those an operator makes; a column called like one of these gives way."""
    gone = {m.lower() for m in made}
    return [c for c in df.columns if c.lower() not in gone]


def ddl(df: DataFrame, names: Sequence[str]) -> str:
    """Schema text of some columns of a frame."""
    return "".join(f"`{n.replace('`', '``')}` {df.schema[n].dataType.simpleString()}, " for n in names)


def batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

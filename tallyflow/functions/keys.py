"""Rerun-stable keys: a hash of the natural key instead of a sequence or a random id.

Parts are SQL expressions: a column name, or a quoted constant such as "'usage'".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "n"


def _parts(expressions: tuple[str, ...]) -> str:
    """Each part with its length in front, so that parts cannot run into each other; NULL is unlike any text."""
    texts = [f"cast({e} AS STRING)" for e in expressions]
    return ", ".join(f"coalesce(cast(length({t}) AS STRING) || ':' || {t}, '{NULL_TOKEN}')" for t in texts)


def surrogate_key(*expressions: str) -> Column:
    """md5 over the parts as text, each with its length, joined by '-'."""
    return F.expr(f"md5(concat_ws('-', {_parts(expressions)}))")


def numeric_key(*expressions: str) -> Column:
    """64-bit key for dimension rows, needing no global counter."""
    return F.expr(f"xxhash64({_parts(expressions)})")

"""Digests of ordered groups, as a stream: a group's values are never held together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def joined_sha256(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, separator: str, to: str) -> DataFrame:
    """One row per group: its columns and, as ``to``, the SHA-256 of its values in order, joined by ``separator``.

    Null groups are groups, null values are empty. A task reads its sorted groups batch by batch and keeps one hash
    state, so memory does not grow with a group. SHA-256 has no parts that could be computed apart: the values of one
    group pass through one task, as bytes only.
    """
    names = list(group)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema), f"`{to}` string"])
    kinds = [pa.string() if t == "string" else pa.int64() if t == "bigint" else None for _, t in df.select(*names).dtypes]
    between = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        types: list = list(kinds)

        def rows(done: list) -> pa.RecordBatch:
            keys = [pa.array([k[i] for k, _ in done], types[i]) for i in range(len(names))]
            return pa.RecordBatch.from_arrays([*keys, pa.array([d for _, d in done], pa.string())], names=[*names, to])

        for batch in batches:
            types = [kind or batch.column(i).type for i, kind in enumerate(kinds)]
            done = []
            for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
                key = tuple(key)
                if state is None or key != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = key, hashlib.sha256(text or b"")
                else:
                    state.update(between + (text or b""))
            if done:
                yield rows(done)
        if state is not None:
            yield rows([(current, state.hexdigest())])

    keys = [F.col(f"`{n}`") for n in names]
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *(F.col(f"`{o}`") for o in order))
    return ordered.select(*keys, F.col(f"`{value}`").cast("binary").alias("_value")).mapInArrow(run, schema)

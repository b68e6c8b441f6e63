"""Nested JSON to (variable, value) leaves.

Path rule: an object key adds ``_<key>``; an array step adds ``_`` (no index);
scalar array items are dropped; the top-level path is empty, so keys of the
top object start with ``_``. Values are Python-style text: ``None``,
``True``/``False``, numbers and strings as text.

One narrow pass: each task walks its rows' documents, whatever their depth, and
nothing is shuffled or kept between levels. (A recursive query over
``variant_explode`` gives the same leaves, but Spark writes down every level and
stops at ``spark.sql.cteRecursionRowLimit`` rows, a million by default.)
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Leaves that a task gathers before it hands them on.
HELD_LEAVES = 50_000


def _not_json(_: str):
    raise ValueError("NaN and Infinity are not JSON")


_DECODER = json.JSONDecoder(parse_constant=_not_json)


def leaves(text: str | None) -> Iterator[tuple[str, str]]:
    """(variable, value) of the leaves of one document; none if it is no JSON or a scalar."""
    try:
        open_values = [("", _DECODER.decode(text))] if text else []
    except (ValueError, RecursionError):
        return
    while open_values:
        path, value = open_values.pop()
        if isinstance(value, dict):
            for key, item in value.items():
                if isinstance(item, (dict, list)):
                    open_values.append((f"{path}_{key}", item))
                else:
                    yield f"{path}_{key}", str(item)
        elif isinstance(value, list):
            open_values += [(f"{path}_", item) for item in value if isinstance(item, (dict, list))]


def _walk(key_cols: list[str]):
    names = [*key_cols, "variable", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i) for i in range(len(key_cols))]
            at, variables, values = [], [], []

            def gathered():
                own = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [*(k.take(own) for k in keys), pa.array(variables, pa.string()), pa.array(values, pa.string())], names)

            for i, text in enumerate(batch.column(len(key_cols))):
                for variable, value in leaves(text.as_py()):
                    at.append(i)
                    variables.append(variable)
                    values.append(value)
                    if len(at) >= HELD_LEAVES:
                        yield gathered()
                        at, variables, values = [], [], []
            yield gathered()
    return run


def flatten_json(df: DataFrame, key_cols: list[str], json_col: str) -> DataFrame:
    """Leaves of a JSON text column: (key..., variable, value).

    Rows whose text is null, not valid JSON or nested deeper than the JSON
    parser goes (about 1,000 levels) have no leaves. A key column is carried as
    it is, also if it is called like a result column. Of equal keys in one
    object the last counts.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in key_cols], F.col(f"`{json_col}`").cast("string").alias("__json"))
    schema = StructType([*rows.schema.fields[:-1], StructField("variable", StringType()), StructField("value", StringType())])
    return rows.mapInArrow(_walk(key_cols), schema)

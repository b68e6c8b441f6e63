"""Column preparation (P1-P13): null fill, forced categoricals, type selection,
membership, constant-column drop, content-type inference, struct flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, IntegerType, LongType, NumericType,
                               ShortType, StringType, StructType)

INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def columns_of_type(df: DataFrame, kinds: list[str]) -> list[str]:
    """Select columns by kind (P7): 'numeric', 'integral', 'string', 'boolean',
    or a Spark simple type name such as 'double' / 'timestamp_ntz'."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        tags = {t.simpleString()}
        if isinstance(t, NumericType):
            tags.add("numeric")
        if isinstance(t, INTEGRAL):
            tags.add("integral")
        if isinstance(t, StringType):
            tags.add("string")
        if isinstance(t, BooleanType):
            tags.add("boolean")
        if tags & set(kinds):
            out.append(f.name)
    return out


def check_target_type(df: DataFrame, target: str) -> None:
    """Raise before any job when the target is not an integer column."""
    t = df.schema[target].dataType
    if not isinstance(t, INTEGRAL):
        raise TypeError(f"column {target!r} holds {t.simpleString()} values; a target needs whole-number classes")


def fill_nulls(df: DataFrame, num_na=0, cat_na: str = ".") -> DataFrame:
    """Numeric nulls -> ``num_na``, boolean ones -> its truth value, string nulls -> ``cat_na``."""
    num, cat = numeric_columns(df), string_columns(df)
    out = df
    if flags := columns_of_type(df, ["boolean"]):
        out = out.fillna(bool(num_na), subset=flags)
    if num:
        out = out.fillna(num_na, subset=num)
    if cat:
        out = out.fillna(cat_na, subset=cat)
    return out


def as_categorical(df: DataFrame, cols: list[str], suffix: str = "_") -> DataFrame:
    """Force columns to categories: text value plus a suffix, after the fill (P5)."""
    return df.withColumns({c: F.concat(F.col(c).cast("string"), F.lit(suffix)) for c in cols})


def prepare(df: DataFrame, categorical_columns: list[str] | None = None,
            cat_na: str = ".", num_na=0) -> DataFrame:
    """``data_process``: fill by type, then force the listed columns to categories."""
    return as_categorical(fill_nulls(df, num_na, cat_na), categorical_columns or [])


def is_member(df: DataFrame, col: str, values, small_limit: int = 1000) -> DataFrame:
    """Flag membership of ``col`` in ``values``.

    A Python list up to ``small_limit`` items becomes an ``isin`` predicate;
    a DataFrame of values is joined (left join on the distinct values, so the
    result never duplicates rows). Adds boolean column ``is_member``.
    """
    if isinstance(values, DataFrame):
        vals = values.select(F.col(values.columns[0]).alias(col)).distinct().withColumn("is_member", F.lit(True))
        return df.join(vals, col, "left").withColumn("is_member", F.coalesce("is_member", F.lit(False)))
    values = list(values)
    if len(values) > small_limit:
        vals = df.sparkSession.createDataFrame([(v,) for v in values], [col])
        return is_member(df, col, vals)
    return df.withColumn("is_member", F.coalesce(F.col(col).isin(values), F.lit(False)))


def drop_low_cardinality(df: DataFrame, profile: DataFrame, min_vals: int = 2,
                         keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Drop columns with fewer than ``min_vals`` distinct values.

    ``profile`` is the univariate table (one row per column, bounded by the
    column count), so collecting the names is safe.
    """
    keep = set(keep or [])
    names = [r["variable"] for r in profile.where(F.col("var_vals") < min_vals).select("variable").collect()]
    names = [n for n in names if n not in keep]
    return df.drop(*names), names


def drop_constant(df: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Drop columns with fewer than two distinct non-null values (P9): no two values
    are distinct where the smallest is the largest, so one aggregation tells."""
    names = [c for c in df.columns if c not in set(keep or [])]
    if not names:
        return df, []
    row = df.agg(*[F.coalesce(F.min(F.col(f"`{c}`")) == F.max(F.col(f"`{c}`")), F.lit(True)).alias(f"c{i}")
                   for i, c in enumerate(names)]).first()
    dropped = [c for i, c in enumerate(names) if row[f"c{i}"]]
    return df.drop(*dropped), dropped


# Regular expressions for the content of text columns.
INTEGER_TEXT = r"^\s*[-+]?[0-9]+\s*$"
FLOAT_TEXT = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
BOOLEAN_TEXT = r"^(True|False|true|false)$"


def infer_column_types(df: DataFrame, type_list: list[str] | None = None) -> DataFrame:
    """Content type of each column (P10) in one aggregation pass.

    Typed columns map from their Spark type (integer, floating, boolean,
    datetime64, ...). Text columns are ``integer`` / ``floating`` / ``boolean``
    when every non-null value parses as such, else ``string``; an all-null
    column is ``empty``. Returns (variable, inferred_type, selected) where
    ``selected`` tells whether the type matches any pattern of ``type_list``.
    """
    type_list = type_list or ["string", "floating"]
    aggs, plan = [], []
    for i, f in enumerate(df.schema.fields):
        t = f.dataType.simpleString()
        if isinstance(f.dataType, StringType):
            c = F.col(f"`{f.name}`")
            aggs += [F.count(c).alias(f"nn{i}"),
                     F.count_if(c.rlike(INTEGER_TEXT)).alias(f"int{i}"),
                     F.count_if(c.rlike(FLOAT_TEXT)).alias(f"flt{i}"),
                     F.count_if(c.rlike(BOOLEAN_TEXT)).alias(f"bool{i}")]
            plan.append((f.name, i, None))
        else:
            if isinstance(f.dataType, INTEGRAL):
                label = "integer"
            elif isinstance(f.dataType, NumericType):
                label = "floating" if t in ("double", "float") else "decimal"
            elif isinstance(f.dataType, BooleanType):
                label = "boolean"
            elif t.startswith("timestamp"):
                label = "datetime64"
            elif t == "date":
                label = "date"
            else:
                label = "mixed"
            plan.append((f.name, i, label))
    row_exprs = []
    for name, i, label in plan:
        if label is None:
            nn, it, fl, bo = (F.col(f"nn{i}"), F.col(f"int{i}"), F.col(f"flt{i}"), F.col(f"bool{i}"))
            lab = (F.when(nn == 0, F.lit("empty")).when(it == nn, F.lit("integer"))
                   .when(fl == nn, F.lit("floating")).when(bo == nn, F.lit("boolean"))
                   .otherwise(F.lit("string")))
        else:
            lab = F.lit(label)
        row_exprs.append(F.struct(F.lit(name).alias("variable"), lab.alias("inferred_type")))
    pattern = "|".join(type_list)
    base = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    return (base.select(F.explode(F.array(*row_exprs)).alias("r")).select("r.*")
            .withColumn("selected", F.col("inferred_type").rlike(pattern)))


def flatten_struct(df: DataFrame, filler: str = "_") -> DataFrame:
    """Flatten nested struct columns to single names joined by ``filler`` with a
    trailing filler (P11): ``a.b`` -> ``a_b_``; top-level plain columns get the
    trailing filler too, as every name does in the pandas version."""
    def walk(schema: StructType, prefix: list[str]):
        for f in schema.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, StructType):
                yield from walk(f.dataType, path)
            else:
                yield path
    cols = []
    for path in walk(df.schema, []):
        ref = ".".join(f"`{p}`" for p in path)
        cols.append(F.col(ref).alias(filler.join(path) + filler))
    return df.select(*cols)


def complement_probability(p: Column | str) -> Column:
    """1 - p (P13)."""
    p = F.col(p) if isinstance(p, str) else p
    return F.lit(1.0) - p

"""Column-level steps. All are JVM expressions, lazy and shuffle-free."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.catalog import quote
from tablesync.spec import SpecError

NESTED = (T.StructType, T.ArrayType, T.MapType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)

# The patterns and the decimal type of typed ingest.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
DATE_PATTERN = "yyyy-MM-dd"
AMOUNT_TYPE = T.DecimalType(20, 7)


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it holds."""
    return F.col(quote(name))


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns. Expression text costs one call to the JVM per column,
    which a wide table feels when its plans are built."""
    return df.selectExpr(*map(quote, names))


def nested_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, NESTED)]


def nested_to_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn struct, array and map columns into JSON text.

    Null struct fields are left out of the text and a null value stays null.
    """
    chosen = nested_columns(df.schema) if columns is None else list(columns)
    return df.withColumns({c: F.to_json(column(c)) for c in chosen}) if chosen else df


def scalars_to_text(df: DataFrame) -> DataFrame:
    """Cast every column that is not nested to text, for text-only targets."""
    nested = set(nested_columns(df.schema))
    return df.selectExpr(
        *[q if c in nested else f"CAST({q} AS STRING) AS {q}" for c in df.columns for q in [quote(c)]]
    )


def text_to_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give text columns the types in ``schema``; text that does not fit is null."""
    typed = {f.name: column(f.name).try_cast(f.dataType) for f in schema}
    return df.select(*[typed.get(c, column(c)).alias(c) for c in df.columns])


def typed_ingest(
    df: DataFrame,
    timestamps: Iterable[str] = (),
    dates: Iterable[str] = (),
    amounts: Iterable[str] = (),
    booleans: Iterable[str] = (),
    timestamp_pattern: str = TIMESTAMP_PATTERN,
    date_pattern: str = DATE_PATTERN,
) -> DataFrame:
    """Type the columns of a raw text load; what cannot be parsed becomes null."""
    typed = {c: F.try_to_timestamp(column(c), F.lit(timestamp_pattern)) for c in timestamps}
    typed |= {c: F.try_to_date(column(c), date_pattern) for c in dates}
    typed |= {c: column(c).try_cast(AMOUNT_TYPE) for c in amounts}
    typed |= {c: column(c).try_cast("boolean") for c in booleans}
    return df.withColumns(typed) if typed else df


def add_derived(df: DataFrame, derived: Mapping[str, str]) -> DataFrame:
    """Add partition columns computed by SQL expressions, stored as text; empty text is null."""
    if not derived:
        return df
    return df.withColumns(
        {alias: F.nullif(F.expr(e).cast("string"), F.lit("")) for alias, e in derived.items()}
    )


def blank_partitions_to_null(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Empty text in partition columns as null, which is how a table stores it."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    chosen = {c: F.nullif(column(c), F.lit("")) for c in partition_by if c in text}
    return df.withColumns(chosen) if chosen else df


def split_columns(
    columns: Sequence[str], partition_by: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Each column goes to exactly one place: body (data order) or partitions (given order)."""
    missing = [c for c in partition_by if c not in columns]
    if missing:
        raise SpecError(f"partition columns not in the data: {missing}")
    return [c for c in columns if c not in set(partition_by)], list(partition_by)


def partition_columns_last(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    body, partitions = split_columns(df.columns, partition_by)
    return pick(df, body + partitions)


def _fits(source: T.DataType, target: T.DataType) -> bool:
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return not isinstance(source, NESTED)
    if isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
        return True
    return isinstance(source, _TEMPORAL) and isinstance(target, _TEMPORAL)


def conform(df: DataFrame, target: T.StructType, case_sensitive: bool = False) -> DataFrame:
    """Select the target's columns, in its order and types.

    The column sets must be equal. Types may differ where Spark's own store
    assignment lets them; anything else is refused by name.
    """
    key = (lambda c: c) if case_sensitive else str.lower
    given = {key(f.name): f for f in df.schema}
    wanted = {key(f.name): f for f in target}
    missing = [f.name for k, f in wanted.items() if k not in given]
    extra = [f.name for k, f in given.items() if k not in wanted]
    if missing or extra:
        raise SpecError(f"columns differ from the table: missing {missing}, unknown {extra}")
    chosen = []
    for k, field in wanted.items():
        source = given[k]
        if not _fits(source.dataType, field.dataType):
            raise SpecError(
                f"column {field.name}: {source.dataType.simpleString()} does not fit "
                f"{field.dataType.simpleString()}"
            )
        value = quote(source.name)
        if source.dataType != field.dataType:
            value = f"CAST({value} AS {field.dataType.simpleString()})"
        chosen.append(f"{value} AS {quote(field.name)}")
    return df.selectExpr(*chosen)


def row_bytes(schema: T.StructType) -> Column:
    """About how much memory a row takes: text by its length, the rest by word."""
    widths = [str(16 + 8 * len(schema))]
    for field in schema:
        name = quote(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(f"coalesce(octet_length({name}), 0)")
        elif isinstance(field.dataType, NESTED):
            widths.append(f"coalesce(octet_length(to_json({name})), 0)")
        elif isinstance(field.dataType, T.DecimalType):
            widths.append("16")
    return F.expr(f"CAST({' + '.join(widths)} AS BIGINT)")

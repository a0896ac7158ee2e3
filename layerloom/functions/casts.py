"""Casts: tolerant ones for the two columns that are known to be dirty, strict ones elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that cannot be read as a date becomes null here; the other column known to be dirty,
# Reputation, stays text until Gold reads it with ``tolerant_int``.
TOLERANT_DATES = frozenset({"creationdate"})
_ZONED = r"\d:\d{2}.*?(Z|z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)\s*$"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def tolerant_int(value: Column) -> Column:
    """Any value, by way of text, to int: a decimal part is cut off, other text gives null.

    ``try_cast`` alone would lose ``'101.0'``, which is what an integer column with nulls looks
    like after a trip through floats.
    """
    text = F.regexp_replace(value.cast("string"), r"(?<![0-9])\.", "0.")
    return F.regexp_replace(text, r"\.[0-9]*\s*$", "").try_cast("int")


def tolerant_timestamp(value: Column) -> Column:
    """Text to a timestamp without zone, null where it does not parse; timestamps pass as is.

    Text that names a zone or an offset is a point in time and is given in UTC; text without one is
    taken as it stands.
    """
    text = value.cast("string")
    local = text.try_cast(T.TimestampType()).cast(T.TimestampNTZType())
    in_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    plain = value.try_cast(T.TimestampNTZType())
    return F.when(text.rlike(_ZONED), in_utc).otherwise(plain)


def strict(value: Column, to: T.DataType, name: str) -> Column:
    """``value`` as ``to``; the job fails on a value that has no such form instead of losing it.

    A number with a zero decimal part, also as text (``'12.0'``), is a whole number.
    """
    text = value.cast("string")
    if isinstance(to, _INTEGRAL):
        whole = F.regexp_replace(F.trim(text), r"(?<=[0-9])\.0*(?=$|[eE])", "")
        exact = whole.try_cast("decimal(38,0)")
        plain = ~F.lower(whole).contains("e") & ~F.contains(whole, F.lit("."))
        # Floats may come in exponent form, whose digits the decimal keeps.
        same = F.when(plain, exact).otherwise(
            F.when(whole.try_cast("double") == exact.cast("double"), exact)
        )
        read = same.cast("string").try_cast(to)
    else:
        read = value.try_cast(to)
    unreadable = F.concat(F.lit(f"{name}: not a {to.simpleString()}: "), F.substring(text, 1, 100))
    fails = value.isNotNull() & read.isNull()
    return F.when(fails, F.raise_error(unreadable).cast(to)).otherwise(read)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Bring a batch to the declared columns and types.

    Columns are matched as Spark matches them, whatever their case. An absent column becomes a
    typed null if it may be null; a required one that is absent is an error. Values are read
    strictly, so nothing turns null unnoticed; only unreadable ``TOLERANT_DATES`` do. Columns the
    schema does not name are dropped unless ``keep_extra`` is set.
    """
    spark = df.sparkSession
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    fold = (lambda n: n) if exact else str.lower
    have = {fold(f.name): f for f in df.schema}
    if len(have) < len(df.columns):
        raise ValueError(f"columns whose names differ only in case: {', '.join(df.columns)}")
    absent = [f.name for f in schema if not f.nullable and fold(f.name) not in have]
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    out = []
    for f in schema:
        found = have.get(fold(f.name))
        if found is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif found.dataType == f.dataType:
            out.append(F.col(f"`{found.name}`").alias(f.name))
        elif fold(f.name) in TOLERANT_DATES or f.name.lower() in TOLERANT_DATES:
            out.append(tolerant_timestamp(F.col(f"`{found.name}`")).alias(f.name))
        else:
            out.append(strict(F.col(f"`{found.name}`"), f.dataType, f.name).alias(f.name))
    if keep_extra:
        declared = {fold(f.name) for f in schema}
        out += [F.col(f"`{n}`") for n in df.columns if fold(n) not in declared]
    return df.select(*out)

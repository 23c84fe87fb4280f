"""Type coercion where a missing number is zero and a missing flag is false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = {"int": "int", "long": "bigint", "short": "smallint"}
_REAL = {"double": "double", "float": "float"}
TARGETS = ("string", "int", "long", "double", "float", "short", "boolean", "object")


def coerce_column(value: Column, source: T.DataType, target: str, safe: bool = False) -> Column:
    """``value`` of type ``source`` as ``target``.

    Null becomes 0 or false (text and ``object`` keep null). Text that is not a
    number raises, or becomes null when ``safe``. Text is a true flag only when
    it reads "true" in any case.
    """
    if target not in TARGETS:
        raise ValueError(f"cannot coerce to {target!r}; known targets: {', '.join(TARGETS)}")
    if target == "object":
        return value
    if target == "string":
        return value.cast("string")
    is_text = isinstance(source, T.StringType)
    if target == "boolean":
        flag = value if isinstance(source, T.BooleanType) else F.lower(value.cast("string")) == "true"
        return F.coalesce(flag, F.lit(False))
    spark_type = _WHOLE.get(target) or _REAL[target]
    zero = F.lit(0).cast(spark_type)
    if not is_text:
        return F.coalesce(value.cast(spark_type), zero)
    if target in _WHOLE:
        parsed = F.when(value.rlike(r"^[+-]?[0-9]+\z"), value.try_cast(spark_type))
    else:
        parsed = value.try_cast(spark_type)
    failed = F.lit(None) if safe else F.raise_error(
        F.concat(F.lit("cannot coerce to " + target + ": "), value)
    )
    return F.when(value.isNull(), zero).when(parsed.isNotNull(), parsed).otherwise(
        failed.cast(spark_type)
    )


def coerce(df: DataFrame, targets: dict[str, str], safe: bool = False) -> DataFrame:
    """Coerce the named columns in place."""
    return df.withColumns(
        {
            name: coerce_column(F.col(name), df.schema[name].dataType, target, safe)
            for name, target in targets.items()
        }
    )

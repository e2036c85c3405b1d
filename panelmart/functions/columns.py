"""Column builders shared by every operator (all JVM-side expressions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

POS_INF = float("inf")
NEG_INF = float("-inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL; Spark keeps NaN and NULL apart, the warehouse must not."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def nan_to_null_all(df, columns=None):
    """Apply :func:`nan_to_null` to every float/double column of ``df``."""
    floats = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (DoubleType, FloatType))
        and (columns is None or f.name in columns)
    }
    if not floats:
        return df
    return df.withColumns({n: nan_to_null(F.col(n)) for n in floats})


def ieee_div(a, b) -> Column:
    """Division with IEEE results under ANSI mode, NaN folded to NULL.

    x/0 is +/-Infinity for x != 0, 0/0 and NULL operands give NULL and
    Infinity/Infinity (NaN) gives NULL.
    """
    a, b = col(a).cast("double"), col(b).cast("double")
    q = (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, a / b)
        .when(a > 0, F.lit(POS_INF))
        .when(a < 0, F.lit(NEG_INF))
        .otherwise(F.lit(None).cast("double"))
    )
    return nan_to_null(q)


#: Texts that stand for no code.
NO_CODE = ("", "nan", "none", "null", "inf", "-inf", "infinity", "-infinity")


def normalize_code(c) -> Column:
    """Entity code -> canonical string ('3204'), keeping NULL as NULL.

    Works for numeric and text input alike.  What reads as a number is its
    whole part without loss (3204, 3204.0 and '3204.0' all give '3204',
    truncating toward zero); other text is kept as it is, trimmed; the
    spellings of no value are NULL.
    """
    text = F.trim(col(c).cast("string"))
    number = text.try_cast("decimal(38,6)")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(~F.lower(text).isin(*NO_CODE), F.coalesce(whole.cast("string"), text))


def any_null(columns) -> Column:
    """OR-fold of ``isNull`` over ``columns``."""
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in columns])


def label_map(c, mapping: dict) -> Column:
    """Constant dict lookup as a CASE expression (unmapped -> NULL)."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    return out


def round_doubles(df, digits: int = 6):
    """Round every double column to ``digits`` places as round(x * 10^d) /
    10^d on the binary value (so every engine gets the same double; the
    decimal-string rounding of ``round(x, d)`` differs at half-way cases);
    adding 0.0 folds a rounded -0.0 into 0.0."""
    return df.select(*[
        (F.round(F.col(f.name) * F.lit(10.0 ** digits), 0) / F.lit(10.0 ** digits)
         + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])

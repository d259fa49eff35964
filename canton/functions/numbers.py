"""Number coercion, rounding and ratios.

Spark 4 runs in ANSI mode: a failed cast or a division by zero raises. These
helpers use the ``try_`` forms, so an undefined value becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from canton.functions.text import decimal_point, strip


# What counts as a number. The JVM parser would also take "1d", "1f" and
# hexadecimal floats, and throws (slowly) on anything else.
_NUMBER = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)
_DIGITS = r"^\s*[+-]?\d+\s*$"
_COUNT = r"^([+-]?\d+)(?:[.,]0*)?$"


def _parsed(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(_NUMBER)), text.try_cast("double"))


def to_double(c: Column, default: float | None = None) -> Column:
    """Text to double; unparsable or blank gives ``default``, NaN gives NULL.

    Numeric input passes through: ``typeof`` is a plan-time constant, so only
    the branch of the actual type is left in the compiled plan. Text is parsed
    as it stands; the full strip runs only when that fails.
    """
    text = c.cast("string")
    trimmed = strip(text)
    value = F.when(F.typeof(c) != "string", c.try_cast("double")).otherwise(
        F.coalesce(_parsed(text), F.when(trimmed != text, _parsed(trimmed)))
    )
    if default is not None:
        value = F.coalesce(value, F.lit(float(default)))
    return F.nanvl(value, F.lit(None).cast("double"))


def to_long(c: Column, default: int | None = None, decimal_comma: bool = False) -> Column:
    """Text to whole number, cut toward zero ("1.9" -> 1).

    Plain digits are cast directly, so long codes stay exact; other text goes
    through double, with ``decimal_comma`` also as "1,9".
    """
    text = c.cast("string")
    direct = F.when(
        (F.typeof(c) == "string") & F.rlike(text, F.lit(_DIGITS)), text.try_cast("long")
    )
    number = to_double(decimal_point(text) if decimal_comma else c).try_cast("long")
    value = F.when(F.typeof(c) == "bigint", c.try_cast("long")).otherwise(
        F.coalesce(direct, number)
    )
    return value if default is None else F.coalesce(value, F.lit(default).cast("long"))


def count_or_fail(c: Column, number: Column | None = None) -> Column:
    """A whole number, also as "12.0" or "12,0"; other text fails the job, NULL stays NULL.

    ``number`` may give the text's ``plain_number`` as a column, where it would
    otherwise be parsed twice.
    """
    text = c.cast("string")
    number = plain_number(c) if number is None else number
    # The cast also takes blanks, controls, signs and zeros around a number. A text
    # of the number's own length has no room for them: no pattern is matched.
    digits = F.when(number < 10, 1)
    for n in range(2, 8):
        digits = digits.when(number < 10**n, n)
    plain = (number >= 0) & (F.octet_length(text) == digits)
    other = F.regexp_extract(strip(text), _COUNT, 1).try_cast("long")
    failed = F.raise_error(F.concat(F.lit("no whole number: "), text)).cast("long")
    return (
        F.when(F.typeof(c) == "bigint", c.try_cast("long"))
        .when(plain, number)
        .when(c.isNotNull(), F.coalesce(other, failed))
    )


def plain_number(c: Column) -> Column:
    return c.cast("string").try_cast("long")


def double_columns(df: DataFrame, names, default: float | None = None) -> list[Column]:
    """``to_double`` for the text columns among ``names``; typed ones stay."""
    types = dict(df.dtypes)

    def typed(name: str) -> Column:
        if types[name] != "double":
            return to_double(F.col(name), default).alias(name)
        return F.col(name) if default is None else F.coalesce(name, F.lit(default)).alias(name)

    return [typed(n) for n in names]


def truncated(c: Column) -> Column:
    """Double to long, cut toward zero."""
    return c.cast("double").try_cast("long")


def whole(c: Column) -> Column:
    """Nearest whole number, halves to even, as a nullable long."""
    return F.rint(c).try_cast("long")


def half_even(c: Column, digits: int = 2) -> Column:
    """Round halves to even on the scaled binary value (``rint(x * 10^n) / 10^n``)."""
    scale = F.lit(float(10 ** digits))
    return F.rint(c * scale) / scale


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct(a: Column, b: Column, guard: bool = False) -> Column:
    """``a / b`` in percent with two digits.

    ``guard=True`` gives 0.0 where ``b`` is not positive; otherwise a zero
    denominator gives NULL.
    """
    if guard:
        share = F.when(b > 0, ratio(a, b) * 100).otherwise(F.lit(0.0))
    else:
        share = ratio(a, b) * 100
    return half_even(share)


def per_mille(n: Column, population: Column) -> Column:
    """Cases per thousand inhabitants; 0.0 for an empty area, NULL if unknown."""
    return F.when(population == 0, F.lit(0.0)).otherwise(ratio(n, population) * 1000)

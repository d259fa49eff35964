"""String expressions used to conform codes, labels and names."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Letters folded by slugs, and characters that become "_".
SLUG_ACCENTS = "éèêëàâäîïôöùûüç"
SLUG_LETTERS = "eeeeaaaiioouuuc"
SLUG_SEPARATORS = "'- ()/"


def strip(c: Column) -> Column:
    """Trim every kind of whitespace; plain ``trim`` only removes spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros and never cut, unlike bare ``lpad``."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))


def lstrip_zeros(c: Column) -> Column:
    return F.ltrim(c, F.lit("0"))


def drop_decimal_suffix(c: Column, anywhere: bool = False) -> Column:
    """Remove the ``.0`` a float detour leaves behind a code.

    ``anywhere=True`` removes every literal ``.0``, also inside the text.
    """
    if anywhere:
        return F.replace(c, F.lit(".0"), F.lit(""))
    return F.regexp_replace(c, r"\.0$", "")


def code_text(c: Column, width: int, anywhere: bool = False) -> Column:
    """Canonical code: trimmed, without ``.0``, zero-padded to ``width``."""
    return zfill(drop_decimal_suffix(strip(c), anywhere), width)


def decimal_point(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def contains_any(c: Column, keywords) -> Column:
    """True when the lower-cased text holds one of the keywords."""
    low = F.lower(c)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(k)) for k in keywords])


def slugify(c: Column) -> Column:
    folded = F.translate(
        F.lower(strip(c)),
        SLUG_ACCENTS + SLUG_SEPARATORS,
        SLUG_LETTERS + "_" * len(SLUG_SEPARATORS),
    )
    return F.btrim(F.regexp_replace(folded, "_+", "_"), F.lit("_"))


def sql_name(name: str) -> str:
    """A column name, quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_double(value: float) -> str:
    """A double as SQL text; text like ``infD`` would be no number."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value!r}' AS DOUBLE)"

"""Business keys: padded codes, composite keys and election labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from canton.functions.text import code_text, strip, zfill


def composite_key(*parts: Column, sep: str = "-") -> Column:
    """Join parts; NULL as soon as one part is NULL (a key has no holes)."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit(sep), part.cast("string")]
    return F.concat(*pieces)


def commune_id(c: Column) -> Column:
    """``69-1``, ``69-001`` or ``69-1.0`` to ``69-001``; undashed text is trimmed."""
    area = zfill(strip(F.substring_index(c, "-", 1)), 2)
    local = code_text(F.regexp_extract(c, "(?s)-(.*)", 1), 3, anywhere=True)
    return F.when(F.contains(c, F.lit("-")), composite_key(area, local)).otherwise(strip(c))


def insee_commune_id(c: Column) -> Column:
    """Five-character area code (padded when short) to ``DD-CCC``."""
    code = zfill(strip(c), 5)
    return composite_key(F.substring(code, 1, 2), F.substr(code, F.lit(3)))


def election_label(year: Column, round_: Column) -> Column:
    """``2022_T1``."""
    return composite_key(year, round_, sep="_T")


def numbered_id(n: Column, prefix: str, width: int = 3) -> Column:
    """``prefix`` + number padded to ``width``; longer numbers stay whole."""
    return F.concat(F.lit(prefix), zfill(n.cast("string"), width))

"""Change fingerprints for slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def row_hash(cols: Sequence[str | Column], sep: str = SEPARATOR) -> Column:
    """16-byte MD5 of the columns joined with ``sep``; NULL counts as the empty string.

    That matches CONCAT semantics where NULL arguments are skipped but the separators
    between them stay, so NULL and '' hash alike and are not a change. Decimals are hashed
    through their text form, which keeps the scale ("45.00").
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        for c in cols
    ]
    return F.unhex(F.md5(F.concat_ws(sep, *parts)))


def hash_hex(c: str | Column) -> Column:
    """Lower-case hex text of a binary hash (for reports and cross-engine comparison)."""
    return F.lower(F.hex(F.col(c) if isinstance(c, str) else c))

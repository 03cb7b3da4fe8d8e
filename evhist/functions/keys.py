"""Surrogate keys (X9) and key text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import SK_SEPARATOR, SK_TIMESTAMP_FORMAT


def ts_text(c: Column | str) -> Column:
    """Fixed text form of a timestamp inside keys: ``yyyy-MM-dd HH:mm:ss.SSS``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, SK_TIMESTAMP_FORMAT)


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the parts joined by ``|``, each part ``coalesce(cast(x as string), '')``.

    The coalesce matters: ``concat_ws`` alone would skip NULL parts and make
    ``(NULL, 'a')`` and ``('a', NULL)`` collide.  Pass timestamps through
    ``ts_text`` so the text does not depend on session settings.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws(SK_SEPARATOR, *parts))


def pair_key(a: Column | str, b: Column | str) -> Column:
    """``a || '|' || b`` (NULL if either part is NULL, as in SQL)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.concat(a, F.lit(SK_SEPARATOR), b)

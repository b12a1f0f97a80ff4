"""Hash keys and hashdiffs (md5 as 32 lower-case hex characters).

Text forms are the canonical ones both Spark and ANSI SQL engines agree on:
decimals carry their scale (``500000.00``), dates are ISO, booleans are
``true``/``false``.  Prices are cast to decimal *before* they are hashed;
double text differs between engines.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between hashdiff parts.
HASHDIFF_SEPARATOR = "||"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column, null_as_empty: bool = False) -> Column:
    """Column as text; ``null_as_empty`` turns null into '' (coalesce)."""
    text = _col(c).cast("string")
    return F.coalesce(text, F.lit("")) if null_as_empty else text


def hash_key_sql(business_key: str) -> str:
    """:func:`hash_key` of one column, as SQL."""
    return f"md5(cast(`{business_key}` as string))"


def hashdiff_sql(columns: Sequence[str], null_as_empty: Collection[str] = ()) -> str:
    """:func:`hashdiff` of columns as text, as SQL; those of ``null_as_empty`` take part as '' when null."""
    texts = [f"coalesce(cast(`{c}` as string), '')" if c in null_as_empty else f"cast(`{c}` as string)" for c in columns]
    return f"md5(concat_ws('{HASHDIFF_SEPARATOR}', {', '.join(texts)}))"


def hash_key(*business_key: str | Column) -> Column:
    """md5 of the business key text; a null key gives a null hash key."""
    if len(business_key) == 1:
        return F.md5(as_text(business_key[0]))
    return F.md5(F.concat_ws(HASHDIFF_SEPARATOR, *[as_text(c) for c in business_key]))


def hashdiff(*parts: Column, null_safe: bool = False) -> Column:
    """md5 over the '||'-joined text parts; concat_ws skips null parts.

    Skipping lets two rows collide when a null moves (``(a, null)`` and ``(null, a)``).
    ``null_safe`` puts a character no text form contains in a null's place instead;
    the default stays, as its hashes are the ones stored."""
    if null_safe:
        parts = tuple(F.coalesce(p, F.lit("\x00")) for p in parts)
    return F.md5(F.concat_ws(HASHDIFF_SEPARATOR, *parts))

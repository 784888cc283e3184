"""Random numbers that depend on a row's key, not on its place in a partition.

``rand()`` follows the partition layout, so a retried or repartitioned job
draws other numbers. These functions hash ``tag:id:...`` instead; the same key
gives the same draw in any layout, and in any engine that has MD5.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def digest(tag: str | int, ids: Sequence[ColumnLike]) -> Column:
    """Hash of the key as hex text; ordering by it shuffles the keys."""
    return F.md5(F.concat(F.lit(f"{tag}:"), joined(":", ids)) if ids else F.lit(str(tag)))


def joined(separator: str, ids: Sequence[ColumnLike]) -> Column:
    """The ids as one string, which no other ids share.

    Separators and backslashes within an id are escaped by a backslash, and null
    is written as one before an ``N``; all other ids appear as they are.
    """
    parts = []
    for item in ids:
        part = (F.col(item) if isinstance(item, str) else item).cast("string")
        for sign in ("\\", separator):
            part = F.replace(part, F.lit(sign), F.lit("\\" + sign))
        parts.append(F.coalesce(part, F.lit("\\N")))
    return F.concat_ws(separator, *parts)


def keyed_bits(tag: str | int, *ids: ColumnLike) -> Column:
    """The first 32 bits of the hash, as a non-negative integer."""
    return F.conv(F.substring(digest(tag, ids), 1, 8), 16, 10).cast("bigint")


def keyed_uniform(tag: str | int, *ids: ColumnLike) -> Column:
    """Uniform draw in [0, 1) from the first 32 bits of the hash."""
    return keyed_bits(tag, *ids).cast("double") / F.lit(4294967296.0)


def keyed_normal(tag: str | int, *ids: ColumnLike) -> Column:
    """Standard normal draw (Box-Muller on two keyed uniforms)."""
    radius = F.greatest(keyed_uniform(f"{tag}/r", *ids), F.lit(1e-12))
    angle = keyed_uniform(f"{tag}/a", *ids)
    return F.sqrt(F.lit(-2.0) * F.ln(radius)) * F.cos(F.lit(2.0 * math.pi) * angle)


def keyed_int(low: int, high: int, tag: str | int, *ids: ColumnLike) -> Column:
    """Integer draw from the closed range ``low..high``."""
    return (F.lit(low) + F.floor(keyed_uniform(tag, *ids) * F.lit(high - low + 1))).cast("int")


def keyed_rank(tag: str | int, *ids: ColumnLike) -> Column:
    """60-bit non-negative integer; ordering by it shuffles the keys."""
    return F.conv(F.substring(digest(tag, ids), 1, 15), 16, 10).cast("bigint")


def uniform_of(tag: str | int, *ids: object) -> float:
    """The draw of :func:`keyed_uniform` for one key, on the driver."""
    text = ":".join(str(part) for part in (tag, *ids))
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0

"""Row hashes that do not depend on partitioning, engine or session settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 15   # of an md5: as a number they always fit a non-negative bigint
HIGHEST = "g"     # sorts after every hexadecimal text


def key_text(key: Sequence[str]) -> Column:
    """The row key as one string. Key columns must be integers or strings, never doubles."""
    return F.concat_ws(":", *[F.col(k).cast("string") for k in key])


def key_hex(key: Sequence[str], *salt: int) -> Column:
    """Hash of ``salt:...:key`` as 15 hexadecimal digits; text order equals numeric order."""
    text = F.concat_ws(":", *[F.lit(str(s)) for s in salt], key_text(key))
    return F.substring(F.md5(text), 1, HEX_DIGITS)


def key_hash(key: Sequence[str], *salt: int) -> Column:
    """The same hash as a bigint, uniform over ``[0, 2**60)``."""
    return F.conv(key_hex(key, *salt), 16, 10).cast("bigint")

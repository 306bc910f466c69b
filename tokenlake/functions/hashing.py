"""Seeded hashes that do not depend on partitioning or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_number(text: Column, digits: int = 8) -> Column:
    """The first hexadecimal digits of the md5 as BIGINT (at most 15 digits)."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, digits), 16, 10).cast("bigint")


def keyed(*parts) -> Column:
    """Parts joined by ':' to one hash input."""
    return F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def uniform(*parts) -> Column:
    """A number strictly between 0 and 1, drawn from the hash of the parts."""
    return (md5_number(keyed(*parts)) + F.lit(0.5)) / F.lit(float(1 << 32))


def gumbel(*parts) -> Column:
    """Standard Gumbel noise; the arg max of logit + noise is a categorical draw."""
    return -F.log(-F.log(uniform(*parts)))

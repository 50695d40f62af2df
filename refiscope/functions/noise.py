"""Reproducible per-key noise from a hash of the key (no generator state)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(key, salt: str = "") -> Column:
    """Uniform in [0, 1) from the first 32 bits of ``md5(key || salt)``."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(k, F.lit(salt)) if salt else k
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return bits / F.lit(4294967296.0)


def uniform_between(key, salt: str, lo: float, hi: float) -> Column:
    return F.lit(lo) + uniform(key, salt) * F.lit(hi - lo)


def gaussian(key, salt: str) -> Column:
    """Standard normal by the Box-Muller transform of two salted uniforms."""
    u1 = F.greatest(uniform(key, salt + "#r"), F.lit(1e-12))
    u2 = uniform(key, salt + "#a")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)

"""Value encoders of the scoring model, as array/number columns.

Scalar encoder: the clipped value falls in bucket ``b`` of
``(max - min) / resolution + 1`` buckets and switches on bits ``b .. b+w-1``.
Season encoder: the day of year picks a centre on a ring of
``w * 366 / radius`` bits and switches on ``w`` bits around it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.settings import DEFAULT, ScoreSettings


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def clipped(x: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    return F.least(F.greatest(_c(x), F.lit(s.scalar_min)), F.lit(s.scalar_max))


def scalar_bucket(x: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    """Bucket index 0..n_buckets-1 (int)."""
    half = s.scalar_resolution / 2
    return F.floor((clipped(x, s) - F.lit(s.scalar_min) + F.lit(half)) / F.lit(s.scalar_resolution)).cast("int")


def bucket_value(b: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    """Value a bucket stands for (its lower edge)."""
    return _c(b) * F.lit(s.scalar_resolution) + F.lit(s.scalar_min)


def scalar_bits(x: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    b = scalar_bucket(x, s)
    return F.sequence(b, b + F.lit(s.scalar_w - 1))


def season_centre(ts: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    return F.floor((F.dayofyear(_c(ts)) - 1) * F.lit(s.season_bits) / F.lit(366)).cast("int")


def season_bits(ts: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    """``w`` bits centred on the day's position, wrapping round the ring."""
    c = season_centre(ts, s)
    half = s.season_w // 2
    return F.transform(F.sequence(c - F.lit(half), c + F.lit(s.season_w - 1 - half)),
                       lambda i: F.pmod(i, F.lit(s.season_bits)))


def record_bits(x: str | Column, ts: str | Column, s: ScoreSettings = DEFAULT) -> Column:
    """Measurement bits first, season bits shifted past the scalar code."""
    return F.concat(scalar_bits(x, s),
                    F.transform(season_bits(ts, s), lambda i: i + F.lit(s.scalar_bits)))

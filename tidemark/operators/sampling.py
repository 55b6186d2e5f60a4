"""Random samples of a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 0) -> DataFrame:
    """Bernoulli sample of the rows."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_keys(df: DataFrame, key: str, fraction: float = 0.1, seed: int = 0) -> DataFrame:
    """Sample decided by a hash of the key: the same rows whatever the partitioning, retries included."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.where(draw < int(fraction * (1 << 32)))

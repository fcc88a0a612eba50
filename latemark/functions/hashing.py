"""Row digests for splits that do not depend on how rows are laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: number of values of :func:`digest_position`
POSITIONS = 1 << 32


def content_digest(columns: Sequence[str], seed: int) -> Column:
    """md5 over the seed and the named columns; the same row always gets the same digest."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def digest_position(digest: Column) -> Column:
    """Place of a digest in [0, 2^32), taken from its first eight hexadecimal digits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")

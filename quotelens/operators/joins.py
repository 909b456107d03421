"""Joins whose strategy depends on a size that is looked at first."""

from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20


def fits(df, limit=BROADCAST_ROWS, most_bytes=BROADCAST_BYTES):
    """Row count of ``df`` if it has at most ``limit`` rows and ``most_bytes`` as JSON, else None.

    It never looks further than one row over the limit.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    n, found = df.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return n if n <= limit and found <= most_bytes else None


def hinted(df, rows):
    """``df`` with a broadcast hint if its row count is known to be small."""
    return df if rows is None else F.broadcast(df)


def join_small(df, other, on, how="inner", limit=BROADCAST_ROWS):
    """Broadcast ``other`` if it has at most ``limit`` rows, else shuffle both sides."""
    return df.join(hinted(other, fits(other, limit)), on, how)

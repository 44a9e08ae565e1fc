"""Join helpers: size-checked broadcast of a derived small side.

Spark's static planner cannot see that an aggregate (e.g. trial counts per
drug) is small — it estimates it at its input's size — so without help the
big side would be shuffled for a sort-merge join and AQE would only convert
the join after that shuffle was written.  ``bounded_broadcast`` materialises
the small side once into the shared checkpoint folder (reliable, survives
executor loss), checks its row count and size, and marks it for broadcast
only within both bounds; beyond them the checkpointed side is returned
unmarked and the join stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.session import ensure_checkpoint_dir

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast-mark ``df`` only if it has at most ``max_rows`` rows and
    about ``max_bytes`` of data (JSON text length as the size measure).

    Rows and size come from one aggregate over the materialised side."""
    ensure_checkpoint_dir(df.sparkSession)
    snap = df.checkpoint(eager=True)
    row = snap.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length(F.to_json(F.struct(*[F.col(c) for c in snap.columns])))).alias("size"),
    ).first()
    if row["n"] > max_rows or (row["size"] or 0) > max_bytes:
        return snap
    return F.broadcast(snap)

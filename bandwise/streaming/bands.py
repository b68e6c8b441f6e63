"""Running KS/Gini bands over a stream.

State is one row per band (at most ``len(edges) - 1`` rows), so the
streaming aggregation needs no watermark; each micro-batch recomputes the
KS/Gini table from the running counts in ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bandwise.operators.bins import band_bounds, band_expr
from bandwise.operators.evaluate import event_flag, ks_gini_table


def stream_band_counts(stream: DataFrame, score_col: str, target_col: str, edges: list[float],
                       event=1) -> DataFrame:
    """Running Event / Total per band of a streaming (or batch) DataFrame."""
    banded = stream.select(band_expr(F.col(score_col).cast("double"), edges).alias("band_id"),
                           event_flag(target_col, event).alias("__flag"))
    lo, hi = band_bounds("band_id", edges)
    return (banded.where(F.col("band_id").isNotNull())
            .groupBy("band_id")
            .agg(F.sum("__flag").cast("long").alias("Event"), F.count(F.lit(1)).alias("Total"))
            .select("band_id", lo.alias("band_lo"), hi.alias("band_hi"), "Event", "Total"))


def band_monitor(stream: DataFrame, score_col: str, target_col: str, edges: list[float],
                 sink: Callable[[DataFrame, int], None], checkpoint_location: str, event=1,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start a query that hands the current KS/Gini table of every micro-batch
    to ``sink(table, epoch_id)``. ``checkpoint_location`` must be a shared,
    reliable folder on a cluster."""
    counts = stream_band_counts(stream, score_col, target_col, edges, event)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        sink(ks_gini_table(batch), epoch_id)

    writer = (counts.writeStream.outputMode("complete").foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()

"""Catalog: the band monitor over a stream of lineitem rows (streaming form of V2/V3)."""

from __future__ import annotations

import uuid

from bandwise.operators.evaluate import score_performance
from bandwise.plans.catalog import register
from bandwise.plans.common import rounded
from bandwise.plans.oracle_sql import ks_table_select, ks_table_sql, quantile_counts_cte
from bandwise.plans.q_evaluate import _LI_BASE
from bandwise.session import checkpoint_dir
from bandwise.streaming import band_monitor


def stream_bands(spark, sf_dir):
    """Edges fitted on lineitem (batch), then the same rows streamed through the
    band monitor (file stream source, running band state); the table of the
    last micro-batch equals the batch KS/Gini table."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    batch = spark.read.parquet(path).select("l_extendedprice", "l_returnflag")
    _, edges = score_performance(batch, "l_extendedprice", "l_returnflag", event="R", bins=10)
    # A file stream source watches a directory: the scale-factor folder, lineitem file only.
    stream = (spark.readStream.schema(batch.schema).option("pathGlobFilter", "lineitem.parquet")
              .parquet(sf_dir.rstrip("/")))
    tables = {}

    def sink(table, epoch):
        # The KS/Gini table of a micro-batch has at most bins + 1 rows.
        tables[epoch] = (table.collect(), table.schema)

    q = band_monitor(stream, "l_extendedprice", "l_returnflag", edges, sink,
                     f"{checkpoint_dir(spark).rstrip('/')}/stream_bands-{uuid.uuid4().hex}", event="R")
    q.awaitTermination()
    rows, schema = tables[max(tables)]
    return rounded(spark.createDataFrame(rows, schema))


register("stream_bands", ks_table_sql(quantile_counts_cte(_LI_BASE, 10)) + ks_table_select())(stream_bands)

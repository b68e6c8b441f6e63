"""Connected components of a link table, never gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import release, stored


def _flattened(hooks: DataFrame) -> DataFrame:
    """Pointer jumping: every hook (hi -> lo, lo < hi) ends at the last node of its chain."""
    while True:
        nxt = hooks.select(F.col("hi").alias("via"), F.col("lo").alias("end"))
        jumped = stored(hooks.join(nxt, hooks["lo"] == nxt["via"], "left")
                        .select("hi", F.coalesce("end", "lo").alias("lo"), F.col("end").isNotNull().alias("moved")), True)
        release(hooks)
        hooks = jumped
        if jumped.filter("moved").isEmpty():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); root is the component's smallest node.

    Each round looks up the present roots of both ends of every link, hooks the
    larger root to the smallest root it meets, and flattens the chains of hooks
    by pointer jumping, so the number of rounds grows with the logarithm of a
    component's size. A hub's links are the probing side of joins between
    stored tables, which Spark splits when one key is hot.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("root")), True)
    while True:
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        met = (links.select("a", "b").join(left, "a").join(right, "b").filter("ra <> rb")
               .select(F.greatest("ra", "rb").alias("hi"), F.least("ra", "rb").alias("lo")))
        # A root may itself have a smaller root.
        point = (roots.filter("node <> root").select(F.col("node").alias("hi"), F.col("root").alias("lo"))
                 .join(roots.select(F.col("root").alias("hi")).distinct(), "hi", "left_semi"))
        hooks = stored(met.union(point).groupBy("hi").agg(F.min("lo").alias("lo")), True)
        if hooks.isEmpty():
            release(hooks)
            return roots
        hooks = _flattened(hooks)
        found = hooks.select(F.col("hi").alias("root"), F.col("lo").alias("to"))
        moved = stored(roots.join(found, "root", "left").select("node", F.coalesce("to", "root").alias("root")), True)
        release(roots, hooks)
        roots = moved

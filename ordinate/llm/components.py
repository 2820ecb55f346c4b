"""Connected components of a table of links, without bringing links or components together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import stored

ROUNDS = 64


def _edges(df: DataFrame) -> DataFrame:
    return df.where("a <> b").distinct()


def _minima(df: DataFrame):
    """Each node's smallest neighbour or itself.  A table of its own, so that the join after it can split hot nodes."""
    return stored(df.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "minima")


def _large_star(edges: DataFrame) -> tuple[DataFrame, list]:
    """Every node links its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low, drop = _minima(both)
    out = both.where("b > a").join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _edges(out), [drop]


def _small_star(edges: DataFrame) -> tuple[DataFrame, list]:
    """Every node links itself and its smaller neighbours to the smallest one."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low, drop = _minima(down)
    near = down.join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _edges(near.unionByName(low.select("a", F.col("low").alias("b")))), [drop]


def components(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """For links ``(a, b)`` between numbers: every linked node and the smallest node it can reach.

    Large-star and small-star steps alternate until nothing changes.  Each is a grouped minimum
    (partly done before the shuffle) and a join that Spark may split at hot nodes; links never grow
    in number.  Every step is a table in the shared folder, so lineage stays short.
    Rows with a null end are ignored, and so are repeated links.

    :returns: ``(node, root)``; no row for nodes without a link.
    """
    now, drop = stored(_edges(edges.select("a", "b").na.drop()), "links")
    mark = None
    for _ in range(rounds):
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = seen
        for star in (_large_star, _small_star):
            step, spent = star(now)
            after, drop_after = stored(step, "links")
            for f in [drop, *spent]:
                f()
            now, drop = after, drop_after
    raise RuntimeError(f"links still change after {rounds} rounds")

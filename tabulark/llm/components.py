"""Connected components of a link table by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.llm.common import written
from tabulark.session import ROWS_PER_PART, shuffle_width

MOST_ROUNDS = 60
#: Doublings of the pointers in one plan: a path shrinks to a fourth of its length per round.
DOUBLINGS = 2


def kept(df: DataFrame, rows: int, label: str = "links") -> DataFrame:
    """``df``, at most about ``rows`` narrow rows, written in as few files as that asks for."""
    parts = max(1, min(shuffle_width(df.sparkSession), -(-rows // ROWS_PER_PART)))
    return written(df.coalesce(parts), label)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node with a link.

    Each round points every label at its smallest neighbour, doubles the pointers
    and keeps the links between labels that still differ. A pointer that has not
    reached its root yet leaves such a link, so nothing is lost, and a path
    shrinks to a fourth per round. The labels of all rounds are put together at
    the end. Every aggregate is a minimum, which meets before the shuffle, so a
    node with very many links is no burden. Each round is written, so neither
    plans nor lineage grow.
    """
    low, high = F.least(a, b).alias("u"), F.greatest(a, b).alias("v")
    first = written(links.select(low, high).where(F.col("u") != F.col("v")).distinct(), "links")
    # No later table has more rows than twice this.
    rows = 2 * first.count()
    edges, jumps = first, []
    while rows and not edges.isEmpty():
        if len(jumps) == MOST_ROUNDS:
            raise RuntimeError("components did not settle")
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        jump = kept(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")), rows)
        for _ in range(DOUBLINGS):
            step = jump.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
            jump = jump.join(step, F.col("p") == F.col("_u"), "left").select("u", F.coalesce("_p", "p").alias("p"))
        jump = kept(jump, rows)
        jumps.append(jump)
        to_u = jump.select(F.col("u"), F.col("p").alias("pu"))
        to_v = jump.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = kept(
            edges.join(to_u, "u").join(to_v, "v")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct(),
            rows,
        )
    labels = first.select("u").union(first.select("v")).distinct().select(F.col("u").alias("node"), F.col("u").alias("component"))
    for jump in jumps:
        labels = labels.join(jump.withColumnRenamed("u", "component"), "component", "left").select(
            "node", F.coalesce("p", "component").alias("component")
        )
    return kept(labels, rows, "components")

"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregate (smallest neighbour of every node) and one join back, so no node's
neighbour list is gathered: a star of any size is a partial minimum plus a join that AQE can split.
A step turns one row into two by an explode, not by a union of two branches: a plan holds its source
twice for each step, so that planning and tasks, all kept by the driver, stay few."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.llm.common import Stages


def _with_least(arcs: DataFrame) -> DataFrame:
    """arcs (u, v) plus m = the smallest of u and all its v. The join key is a struct, so that both
    sides are shuffled anew and AQE can split a node with very many arcs."""
    least = arcs.groupBy("u").agg(F.min("v").alias("low")).select(F.struct("u").alias("w"), F.least("u", "low").alias("m"))
    return arcs.join(least, F.struct(arcs.u) == least.w, "inner").select("u", "v", "m")


def _pairs(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """For each row one arc (u, v) for each pair of its columns."""
    arcs = F.array(*(F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends))
    return rows.select(F.explode(arcs).alias("arc")).select("arc.u", "arc.v")


def large_star(edges: DataFrame) -> DataFrame:
    """Arcs may repeat; there are as many as edges at most."""
    out = _with_least(_pairs(edges, ("u", "v"), ("v", "u"))).where(F.col("v") > F.col("u"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return _pairs(_with_least(down), ("v", "m"), ("u", "m")).where("u <> v").distinct()


def components(edges: DataFrame, stages: Stages, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable. Nodes without an edge are absent.

    Null ends and self-loops are ignored; repeated edges count once; an empty table gives no rows.
    Every round is written to the shared folder, which cuts the lineage; the loop ends when every edge
    leads to a star's centre, which large-star/small-star reach in O(log^2 n) rounds."""
    now = stages.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct(), f"{label}-0")
    rounds = 0
    while not _settled(now):
        rounds += 1
        if rounds > max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        now = stages.keep(small_star(large_star(now)), f"{label}-{rounds}")
        stages.drop(f"{label}-{rounds - 1}")
    return _pairs(now, ("u", "v"), ("v", "v")).distinct().toDF("node", "component")


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges (u > v) are stars around their smallest nodes: every u has one v, and no v is a u."""
    up, down = F.sum("up").alias("up"), F.max("down").alias("down")
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("end"))
    return ends.select("end.*").groupBy("node").agg(up, down).where("up > 1 OR (up = 1 AND down = 1)").agg(F.count("*")).first()[0] == 0

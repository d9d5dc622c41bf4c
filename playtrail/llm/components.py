"""Connected components of an edge table, by alternating large and small stars.

Each round joins every node's smallest neighbour to its other neighbours, as
plain aggregations and joins, and is written to the shared folder, which cuts the
lineage; the round before is then deleted. No list of neighbours is ever collected,
so a node may have any number: least neighbours combine on the map side, and the
join that hands them on also matches a hash of the node, so that it is shuffled for
its own sake and adaptive execution can split a node with very many neighbours. It
asks for a merge join, as the files of an edge table, which Spark takes for its size,
are far smaller than the table in a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.store import discard, scratch_path, written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (u, v), v < u. Large star: neighbours above a node go to its smallest one."""
    if larger:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    h = {"h": F.xxhash64("u", F.lit("star"))}
    joined = around.withColumns(h).join(least.withColumns(h).hint("merge"), ["h", "u"])
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), two longs; root is the least node."""
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    current = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
        path,
    )
    state = None
    while True:
        found = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")
        ).first()
        if found == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = found
        old, path = path, scratch_path(spark, "edges")
        current = written(_star(_star(current, larger=True), larger=False), "edges", path)
        discard(spark, old)

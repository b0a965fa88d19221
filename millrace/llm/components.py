"""Connected components by contraction, as joins and minima."""

from pyspark.sql import DataFrame, functions as F

from millrace.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts lineage, gives sizes."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node of ``edges`` (columns ``a`` and ``b``, no loops).

    Each round maps every node to the smallest in its neighbourhood and contracts the graph by
    that map.  Nodes named by hashes shrink by a constant factor a round, whatever the shape; a
    star is done in one.  Tables stay distributed, and a node with very many links only meets
    aggregates that combine before the shuffle and joins that adaptive execution can split.
    """
    names = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = names.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        ways = edges.union(edges.select("b", "a"))
        to = ways.groupBy("a").agg(F.min("b").alias("least"))
        to = stored(to.select("a", F.least("a", "least").alias("to")), "contract")
        roots = stored(
            roots.join(to, roots["root"] == to["a"], "left").select("node", F.coalesce("to", "root").alias("root")),
            "roots",
        )
        far = to.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        ends = edges.join(to, "a").join(far, "b").filter("to != to_b")
        edges = stored(ends.select(F.least("to", "to_b").alias("a"), F.greatest("to", "to_b").alias("b")).distinct(), "edges")
    return roots

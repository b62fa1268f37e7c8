"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barloom.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for nodes of ``links`` (columns a, b).

    Rounds of taking the smallest label around and then the label's own label, each written to the
    shared folder. The number of rounds follows the logarithm of the longest path. A hot node only
    adds rows that are combined before they move, or to a join that adaptive execution splits.
    """
    both = scratch.keep(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = scratch.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("label")), "labels-0",
    )
    step = 0
    while True:
        step += 1
        told = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        heard = told.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        now = labels.join(heard, "node", "left").select(
            "node", F.col("label").alias("was"), F.least("label", F.coalesce("heard", "label")).alias("label")
        )
        owner = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        now = now.join(owner, "label", "left").select(
            "node", "was", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        now = scratch.keep(now, f"labels-{step}")
        changed = now.where("label <> was").limit(1).count()
        scratch.drop(f"labels-{step - 1}")
        labels = now.select("node", "label")
        if not changed:
            scratch.drop("links")
            return labels

"""Connected components of a link table, without collecting any of it."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import free, stage


def connected_components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``a``, ``b``);
    ``component`` is the smallest node of its component.

    ``known`` is an earlier result for other links of the same graph: its
    components are joined by ``links``, and its nodes are part of the result.

    Each round points every node at its first neighbour, or itself, in an
    order, replaces links by links between the nodes pointed at, and drops
    those that became loops. The first order is the ids' own, which folds a
    star around its smallest node at once; later ones are hashed anew, so a
    long chain also loses a constant share of its nodes in each round. Rows
    with a null are ignored, repeated links and loops do no harm.
    """
    if known is not None:
        for end in ("a", "b"):
            found = links.join(known.toDF(end, "component"), end, "left")
            links = found.withColumn(end, F.coalesce("component", end)).select("a", "b")
        joined = connected_components(links).toDF("component", "whole")
        return stage(
            known.union(joined.join(known, joined["component"] == known["node"], "left_anti").selectExpr("component", "component"))
            .join(joined, "component", "left")
            .select("node", F.coalesce("whole", "component").alias("component")),
            "components",
        )
    edges = stage(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        order = "0" if not steps else f"xxhash64({len(steps)}, {{0}})"
        both = edges.select("a", "b").union(edges.select("b", "a"))
        first = F.min(F.struct(F.expr(order.format("b")).alias("o"), F.col("b").alias("to")))
        own = F.struct(F.expr(order.format("node")).alias("o"), F.col("node").alias("to"))
        step = stage(
            both.groupBy(F.col("a").alias("node")).agg(first.alias("near"))
            .select("node", F.least("near", own).getField("to").alias("to")),
            "step",
        )
        steps.append(step)
        before, edges = edges, stage(
            edges.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
        free(before)
    if not steps:
        return edges.selectExpr("a AS node", "a AS component")

    def follow(labels: DataFrame, step: DataFrame) -> DataFrame:
        joined = labels.join(step.toDF("label", "next"), "label", "left")
        return joined.select("node", F.coalesce("next", "label").alias("label"))

    labels = stage(reduce(follow, steps[1:], steps[0].toDF("node", "label")), "labels")
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    out = stage(labels.join(smallest, "label").select("node", "component"), "components")
    free(edges, labels, *steps)
    return out


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the ``n`` points that the links (i, j) connect each with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            return label

"""Connected components of a link table, as label passes between written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import materialise


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """Smallest reachable id of every id that has a link.

    ``edges`` has long columns ``a`` and ``b`` (any order, repeats and loops allowed; rows with a
    NULL end are ignored). Returns ``node``, ``comp``. Empty links give an empty table.

    Each pass sends every label over every link, keeps the smallest, then jumps to the label's own
    label, so long chains shorten by half or more a pass. Labels are combined map-side before each
    shuffle, and each pass is written out, so links at a hub are dealt anew by a skew join.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = materialise(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{tag}-links")
    labels = materialise(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.least(F.min("b"), F.first("a")).alias("comp")), f"{tag}-labels")
    while True:
        sent = both.join(labels.withColumnRenamed("node", "a"), "a").select(F.col("b").alias("node"), "comp")
        lowest = labels.union(sent).groupBy("node").agg(F.min("comp").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("lower"))
        passed = materialise(
            lowest.join(jump, "low", "left").join(labels, "node")
            .select("node", F.least("low", F.coalesce("lower", "low")).alias("comp"),
                    F.col("comp").alias("was")), f"{tag}-labels")
        labels = passed.select("node", "comp")
        if passed.where("comp <> was").isEmpty():
            return labels

"""Clusters of phrases that are near each other on the surface.

Linked phrases share a pair of characters or their whole normalised form, or one is a single
character of the other, so candidates come from a join on those, not from all pairs. Components
of few links are found in one task; of more, by passing the least phrase along links until nothing
changes, each round cut from its lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurlake.functions import text as tx
from murmurlake.session import cut


def normalised(phrase: F.Column) -> F.Column:
    return F.regexp_replace(tx.strip(phrase), r"(?s)(.)\1+", "$1")


def links(phrases: DataFrame, min_overlap: float = 0.5) -> DataFrame:
    """(a, b, link): linked phrases, a < b; link is normalised_variant, contained_phrase or surface_overlap.

    ``phrases`` has the column phrase; blank ones are left out and repeats count once.
    """
    base = phrases.select(tx.strip(F.col("phrase")).alias("p")).where("p <> ''").distinct().select("p", normalised(F.col("p")).alias("n"))
    base = base.withColumn("g", tx.bigrams(F.col("n")))
    keys = base.select("p", "n", "g", F.explode(F.array_append("g", F.concat(F.lit("="), F.col("n")))).alias("k"))
    # A form of one character may be contained in the earlier phrase of a pair.
    single = base.where(F.length("n") == 1).select("p", "n", "g", F.col("n").alias("k"))
    chars = base.where(F.length("n") >= 2).select("p", "n", "g", F.explode(F.array_distinct(F.split("n", ""))).alias("k"))
    other = keys.union(single).select(F.col("p").alias("b"), F.col("n").alias("nb"), F.col("g").alias("gb"), "k")
    pairs = keys.union(chars).select(F.col("p").alias("a"), F.col("n").alias("na"), F.col("g").alias("ga"), "k").join(other, "k").where("a < b").drop("k").distinct()
    inside = (F.length("na") >= 2) & (F.col("na").contains(F.col("nb")) | F.col("nb").contains(F.col("na")))
    both = (F.size("ga") > 0) & (F.size("gb") > 0)
    link = (
        F.when(F.col("na") == F.col("nb"), F.lit("normalised_variant"))
        .when(inside, F.lit("contained_phrase"))
        .when(both & (tx.jaccard(F.col("ga"), F.col("gb")) >= min_overlap), F.lit("surface_overlap"))
    )
    return pairs.select("a", "b", link.alias("link")).where("link is not null")


#: Links up to this number are joined up by one task: some 10 MB. Mined phrases, whose number the settings bound, have fewer.
LINKS_IN_TASK = 100_000


def _joined_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    above: dict = {}

    def top(x):
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"], pdf["b"], strict=True):
            low, high = sorted((top(a), top(b)))
            above[high] = low
    if above:  # an empty frame has no type that suits texts
        yield pd.DataFrame({"id": list(above), "root": [top(x) for x in list(above)]})


def components(edges: DataFrame, in_task: int = LINKS_IN_TASK) -> DataFrame:
    """(id, root): the least member of each node's component; ``edges`` has a and b.

    Up to ``in_task`` links go to one task; more go through rounds, with the same result.
    """
    if edges.count() <= in_task:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.select("a", "b").coalesce(1).mapInPandas(_joined_up, f"id {kind}, root {kind}")
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")), "labels")
    held = labels
    while True:
        seen = both.join(labels.withColumnsRenamed({"id": "b", "root": "r"}), "b").groupBy(F.col("a").alias("id")).agg(F.min("r").alias("r"))
        # A root's own root is followed too, which halves long chains.
        far = labels.select(F.col("id").alias("via"), F.col("root").alias("rr"))
        moved = labels.join(seen, "id").withColumn("best", F.least("root", "r")).join(far, F.col("best") == F.col("via"), "left")
        new = cut(moved.select("id", F.least("best", F.coalesce("rr", F.col("best"))).alias("root"), (F.least("best", F.coalesce("rr", F.col("best"))) != F.col("root")).alias("changed")), "labels", replaces=held)
        held = new
        labels = new.select("id", "root")
        if not new.where("changed").limit(1).count():
            return labels


def clusters(phrases: DataFrame, min_overlap: float = 0.5) -> DataFrame:
    """(cluster_id, canonical_phrase, size, members, link_types): components of at least two phrases.

    ``phrases`` has phrase, freq and style_keyness; of rows with one phrase the last by
    freq counts. Members come by frequency, length and spelling.
    """
    edges = cut(links(phrases, min_overlap), "links")
    roots = components(edges)
    kinds = edges.select(F.explode(F.array("a", "b")).alias("id"), "link").groupBy("id").agg(F.array_sort(F.collect_set("link")).alias("link_types"))
    facts = phrases.groupBy(tx.strip(F.col("phrase")).alias("id")).agg(F.max(F.struct("freq", "style_keyness")).alias("f"))
    member = F.struct((-F.col("f.freq")).alias("o1"), F.length("id").alias("o2"), F.col("id").alias("phrase"), F.col("f.freq").alias("freq"), F.col("f.style_keyness").alias("style_keyness"), "link_types")
    grouped = roots.join(facts, "id").join(kinds, "id").groupBy("root").agg(F.array_sort(F.collect_list(member)).alias("m"))
    names = F.array_sort(F.transform("m", lambda x: x["phrase"]))
    return grouped.select(
        F.concat(F.lit("cluster_"), F.substring(F.sha2(F.array_join(names, "\u0000"), 256), 1, 12)).alias("cluster_id"),
        F.element_at("m", 1)["phrase"].alias("canonical_phrase"),
        F.size("m").alias("size"),
        F.transform("m", lambda x: F.struct(x["phrase"].alias("phrase"), x["freq"].alias("freq"), x["style_keyness"].alias("style_keyness"), x["link_types"].alias("link_types"))).alias("members"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("m", lambda x: x["link_types"])))).alias("link_types"),
        F.lit("pending").alias("review_status"),
    )

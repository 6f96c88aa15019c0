"""Review samples of fixed size per stratum, and the template for their decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def strata(size: int) -> dict[str, tuple[F.Column, int]]:
    """Name → (condition, rows): the strata of a review."""
    bucket, style = F.col("bucket"), F.col("scores.style_score")
    return {
        "candidates_high_score": ((bucket == "candidates") & (style >= 8), size // 2),
        "candidates_low_score": ((bucket == "candidates") & (style > 0) & (style < 8), size // 2),
        "rejected_high_style_score": ((bucket == "rejected") & (style >= 4), size),
        "chaos_style": (bucket == "chaos_style", size),
        "need_anonymize": (bucket == "need_anonymize", size),
        "debatable": (bucket == "debatable", size),
    }


def stratified_sample(blocks: DataFrame, size: int, seed: int, by: str = "review_id") -> DataFrame:
    """The blocks of each stratum whose seeded hash is least: exactly ``size`` or all, the same ones every time.

    Adds stratum. The rank is limited within each partition before rows move, so a
    stratum of most rows costs no more than one of few. Equal ids are told apart by text.
    """
    named = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("stratum"), F.lit(k).alias("k"))) for n, (c, k) in strata(size).items()]))
    rows = blocks.withColumn("__s", F.explode(named)).withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(by).cast("string"))))
    w = Window.partitionBy("__s.stratum").orderBy("__h", F.col(by), "my_text")
    ranked = rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= size)
    return ranked.where(F.col("__r") <= F.col("__s.k")).withColumn("stratum", F.col("__s.stratum")).drop("__s", "__h", "__r")


def decision_template(sample: DataFrame) -> DataFrame:
    return sample.where(F.coalesce("review_id", F.lit("")) != "").select(
        F.lit("block").alias("kind"), F.col("review_id").alias("key"), F.lit("pending").alias("decision"), F.lit("").alias("reason")
    )

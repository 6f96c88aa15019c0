"""How distinctive a term is per record: a two-Poisson mixture per term.

The records that have a term use it at one of two rates: an ordinary one, or an elite one
where the record is about it. For each term both rates and the elite share are fitted by
expectation-maximisation on the term's frequency histogram (how many records of a size
class have it how often); each occurrence count is then scored by the posterior
probability that it comes from the elite component. A histogram of occurrences has no
zeros, so both components are zero-truncated. The ordinary rate has a weak prior at the
term's overall rate: a term that only elite records have shows no ordinary ones.

One elite rate can't hold a term that a record uses at 60 % and another at 3 %: records
far above the ordinary rate are set aside once they are elite, and what is left is fitted
anew, as long as anything in it stands out. A count's posterior is its largest of all fits.

The histogram is aggregated before it is shuffled by term, and its cells – not records –
are what one task sees of a term, so a term that every record has costs no more than its
number of distinct (count, size class) cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size classes are powers of this base; a class's exposure is its records' mean size.
SIZE_BASE = 1.25
#: Steps of one fit; a term stops by itself once its rates move by less than the tolerance.
EM_STEPS = 500
EM_TOLERANCE = 1e-6
#: The prior of the ordinary rate, in occurrences seen at the term's overall rate.
PRIOR = 2.0
#: What is left of a term is fitted again while a rate in it is this many times the overall one.
STANDS_OUT = 3.0
#: A component below this many times the overall rate is that of a common term, not an elite one.
ABOVE = 2.0
#: From this posterior on a term is called characteristic of a record.
ELITE = 0.5


def latest_counts(stats: DataFrame) -> DataFrame:
    """(run_id, phrase, n, recorded, source_file): the row mined last for each run and trimmed phrase.

    n is the sum of ``bucket_freq``, or ``freq`` where that is null; null values in the
    map count 0, and a phrase without either counts 0. Ties of ``mined_at`` go to the
    larger count. Rows without run or phrase, or with a blank phrase, are left out.
    """
    n = F.coalesce(
        F.aggregate(F.map_values("bucket_freq"), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0))), F.col("freq"), F.lit(0)
    ).cast("long")
    rows = stats.select(
        "run_id", F.regexp_replace("phrase", r"(?U)^\s+|\s+$", "").alias("phrase"), n.alias("n"), F.col("style_keyness").alias("recorded"), "mined_at"
    ).where(F.col("run_id").isNotNull() & (F.length("phrase") > 0))
    last = F.max(F.struct(F.coalesce(F.col("mined_at"), F.lit("0001-01-01").cast("timestamp")), "n", "recorded")).alias("last")
    return rows.groupBy("run_id", "phrase").agg(last).select("run_id", "phrase", F.col("last.n").alias("n"), F.col("last.recorded").alias("recorded"))


def _missing(rate: np.ndarray) -> np.ndarray:
    """P(count > 0) of a Poisson variable."""
    return -np.expm1(-np.maximum(rate, 1e-12))


def _odds(count: np.ndarray, size: np.ndarray, low: np.ndarray, elite: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log-odds of the elite component for counts above 0."""
    gap = (np.log(elite) - np.log(low)) * count - (elite - low) * size - np.log(_missing(elite * size)) + np.log(_missing(low * size))
    return gap + np.log(share) - np.log1p(-share)


def _fit(count: np.ndarray, size: np.ndarray, weight: np.ndarray, starts: np.ndarray, overall: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM for many terms at once; cells of a term are neighbours, ``starts`` are their first cells.

    ``overall`` is each term's rate over all records, those without it included. Both rates
    start there, so that all that tells them apart is learnt; cells above that rate are taken for elite in the first step. Each term stops
    for itself.
    """
    low, elite, share = overall.copy(), overall.copy(), np.full(len(starts), 0.1)
    lengths = np.diff(np.append(starts, len(count)))
    term = np.repeat(np.arange(len(starts)), lengths)
    going = np.arange(len(starts))
    for step in range(steps):
        cells = np.flatnonzero(np.isin(term, going)) if len(going) < len(starts) else np.arange(len(term))
        c, s, w, n = count[cells], size[cells], weight[cells], lengths[going]
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        sums = lambda x: np.add.reduceat(x, first)
        lo, el, sh = (np.repeat(x[going], n) for x in (low, elite, share))
        post = np.where(c / s > np.repeat(overall[going], n), 0.9, 0.1) if step == 0 else 1 / (1 + np.exp(-np.clip(_odds(c, s, lo, el, sh), -700, 700)))
        # A truncated Poisson count stands for size / P(count > 0) of exposure.
        n1, t1 = sums(w * post * c), sums(w * post * s / _missing(el * s))
        n0, t0 = sums(w * (1 - post) * c), sums(w * (1 - post) * s / _missing(lo * s))
        new_share = (sums(w * post) + 0.1) / (sums(w) + 1)
        new_low = (n0 + PRIOR) / (t0 + PRIOR / overall[going])
        new_elite = np.maximum(n1 / np.maximum(t1, 1e-12), 1e-12)
        moved = np.maximum(np.abs(np.log(new_elite / elite[going])), np.abs(np.log(new_low / low[going])))
        low[going], elite[going], share[going] = new_low, new_elite, new_share
        going = going[(moved >= EM_TOLERANCE) | (step == 0)]
        if not len(going):
            break
    return low, elite, share


def fit_histograms(histograms: list[list[tuple[float, float, float]]], overall: list[float], steps: int = EM_STEPS) -> list[list[tuple[float, float, float]]]:
    """The fits (low, elite, share) of each term's histogram of (count, size, records).

    The first fit is of the whole histogram, further ones of what the earlier left over.
    """
    fits: list[list[tuple[float, float, float]]] = [[] for _ in histograms]
    left = {i: np.array(h, float) for i, h in enumerate(histograms) if h}
    while left:
        starts = np.cumsum([0, *[len(h) for h in left.values()]])[:-1]
        cells = np.concatenate(list(left.values()))
        low, elite, share = _fit(cells[:, 0], cells[:, 1], cells[:, 2], starts, np.array([overall[i] for i in left]), steps)
        rest: dict[int, np.ndarray] = {}
        for k, (i, h) in enumerate(left.items()):
            fits[i].append((float(low[k]), float(elite[k]), float(share[k])))
            taken = (elite[k] >= ABOVE * overall[i]) & (elite[k] > low[k]) & (_odds(h[:, 0], h[:, 1], low[k], elite[k], share[k]) > 0)
            over = h[~taken]
            if taken.any() and len(over) and (over[:, 0] / over[:, 1]).max() >= STANDS_OUT * overall[i]:
                rest[i] = over
        left = rest
    return fits


def fit_terms(counts: DataFrame, record: str, term: str, n: str, steps: int = EM_STEPS) -> DataFrame:
    """(term, fits, records, total): the mixtures of each term, array<struct<low, elite, share>>.

    ``counts`` holds each record and term once. Rates are occurrences per term of a record;
    records is how many have the term, total how often.
    """
    sizes = counts.groupBy(record).agg(F.sum(n).cast("double").alias("size")).where("size > 0")
    sizes = sizes.withColumn("class", F.floor(F.log(SIZE_BASE, F.col("size"))).cast("int"))
    # One row for each power of the base: at most some 200, whatever the data.
    classes = sizes.groupBy("class").agg(F.avg("size").alias("mean_size"))
    all_sizes = classes.agg(F.array_sort(F.collect_list(F.struct("class", "mean_size"))).alias("classes")).crossJoin(sizes.agg(F.sum("size").alias("all_size")))
    cells = (
        counts.where(F.col(n) > 0)
        .join(sizes.select(record, "class"), record)
        .groupBy(term, "class", n)
        .agg(F.count(F.lit(1)).alias("records"))
        .groupBy(term)
        .agg(F.array_sort(F.collect_list(F.struct("class", F.col(n).alias("count"), "records"))).alias("cells"))
        .crossJoin(F.broadcast(all_sizes))  # a single row
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            mean = {c["class"]: c["mean_size"] for c in pdf["classes"].iloc[0]}
            histograms = [[(c["count"], mean[c["class"]], c["records"]) for c in own] for own in pdf["cells"]]
            records = [int(sum(c[2] for c in h)) for h in histograms]
            totals = [int(sum(c[0] * c[2] for c in h)) for h in histograms]
            fits = fit_histograms(histograms, [t / a for t, a in zip(totals, pdf["all_size"], strict=True)], steps)
            named = [[{"low": a, "elite": b, "share": c} for a, b, c in f] for f in fits]
            yield pd.DataFrame({"term": pdf[term], "fits": named, "records": records, "total": totals})

    kind = counts.schema[term].dataType.simpleString()
    fitted = cells.mapInPandas(work, f"term {kind}, fits array<struct<low double, elite double, share double>>, records long, total long")
    return fitted.withColumnRenamed("term", term)


def _log_odds(fit: Column, n: Column, size: Column) -> Column:
    low, elite, share = fit["low"], fit["elite"], fit["share"]
    seen = lambda rate: F.log(-F.expm1(-F.greatest(rate * size, F.lit(1e-12))))
    return (F.log(elite) - F.log(low)) * n - (elite - low) * size - seen(elite) + seen(low) + F.log(share) - F.log1p(-share)


def score_terms(counts: DataFrame, record: str = "run_id", term: str = "phrase", n: str = "n", steps: int = EM_STEPS) -> DataFrame:
    """Adds to each (record, term, n): log_odds, posterior, share, overall_share, lift, records.

    posterior is the probability that the count comes from the term's elite component.
    Counts of 0 get posterior 0 and no odds, and so do terms that no record uses at ``ABOVE``
    times the overall rate. An empty input gives an empty result.
    """
    terms = fit_terms(counts, record, term, n, steps)
    sizes = counts.groupBy(record).agg(F.sum(n).alias("record_total"))
    overall = counts.agg(F.sum(n).alias("all_total"))  # one row
    apart = F.filter("fits", lambda f: (f["elite"] > f["low"]) & (f["elite"] * F.col("all_total") >= F.lit(ABOVE) * F.col("total")))
    odds = F.array_max(F.transform(apart, lambda f: _log_odds(f, F.col(n), F.col("record_total"))))
    scored = (
        counts.join(sizes, record)
        .join(terms, term, "left")
        .crossJoin(F.broadcast(overall))
        .withColumn("log_odds", F.when(F.col(n) > 0, odds))
        .withColumn("posterior", F.coalesce(1 / (1 + F.exp(-F.col("log_odds"))), F.lit(0.0)))
        .withColumn("share", F.when(F.col("record_total") > 0, F.col(n) / F.col("record_total")).otherwise(F.lit(0.0)))
        .withColumn("overall_share", F.coalesce(F.col("total") / F.col("all_total"), F.lit(0.0)))
        .withColumn("lift", F.col("share") / F.col("overall_share"))
    )
    return scored.select(
        *counts.columns,
        "log_odds",
        "posterior",
        "share",
        "overall_share",
        "lift",
        F.coalesce("records", F.lit(0)).alias("records"),
        "record_total",
        F.coalesce("total", F.lit(0)).alias("term_total"),
        "all_total",
    )


def characteristic(scored: DataFrame, n: str = "n") -> DataFrame:
    """The rows that are characteristic: selected by their posterior, then checked exactly.

    The check: at least 2 % of the record, at least 4 times the share of all records,
    in at least two records. Whole numbers are compared, so no share is lost to rounding.
    """
    big = lambda c: F.col(c).cast("decimal(19,0)")
    return scored.where(F.col("posterior") > ELITE).where(
        (F.col("records") >= 2)
        & (big(n) * 50 >= big("record_total"))
        & (big(n) * big("all_total") >= big("term_total") * 4 * big("record_total"))
    )

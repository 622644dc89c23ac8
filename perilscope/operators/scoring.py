"""Per-hazard baselines, z-scores and the impact score.

Statistics are a ``groupBy`` (partial aggregation map-side, one row per group)
joined back; never a window partitioned by hazard, which would send every row
of a hazard -- a third of the data or more -- to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clean import log_population
from ..session import materialize

# fixed values of the reference's impact formula
IMPACT_BASE = 20.0
IMPACT_WEIGHTS = {"severity": 20.0, "log_pop": 20.0, "news": 10.0, "tone": 5.0}
IMPACT_CAP = 100.0
TONE_SCALE = 10.0


def hazard_baselines(df: DataFrame, group: str, cols: dict[str, str]) -> DataFrame:
    """AVG and STDDEV_POP per group; ``cols`` maps input column -> output prefix."""
    aggs = []
    for c, p in cols.items():
        aggs += [F.avg(c).alias(f"{p}_mean"), F.stddev_pop(c).alias(f"{p}_std")]
    return df.groupBy(group).agg(*aggs)


def zscore_by(df: DataFrame, group: str, cols: dict[str, str]) -> DataFrame:
    """Adds ``z_<prefix>`` = (x - mean) / NULLIF(std, 0) within ``group``.

    ``group`` is a category with few values (hazard types: one per feed), so the
    statistics table -- one row per group -- is broadcast.
    """
    stats = hazard_baselines(df, group, cols)
    out = df.join(F.broadcast(stats), group, "inner")
    for c, p in cols.items():
        out = out.withColumn(f"z_{p}", F.try_divide(F.col(c) - F.col(f"{p}_mean"),
                                                     F.nullif(F.col(f"{p}_std"), F.lit(0.0))))
    return out.drop(*[f"{p}_{s}" for p in cols.values() for s in ("mean", "std")])


def impact_features(enriched: DataFrame, news_metrics: DataFrame) -> DataFrame:
    """The ``base`` of step 9: enriched incidents + news, log population."""
    n = news_metrics.select("event_id", "news_articles_48h", "news_tone_48h")
    return (enriched.join(n, "event_id", "left")
            .select("event_id", "hazard_type", "start_time", "country_name", "severity",
                    log_population("population_estimate").alias("log_pop"),
                    F.coalesce(F.col("news_articles_48h"), F.lit(0)).cast("bigint").alias("news_articles_48h"),
                    F.coalesce(F.col("news_tone_48h"), F.lit(0.0)).alias("news_tone_48h")))


def impact_score(features: DataFrame, *, group: str = "hazard_type", base: float = IMPACT_BASE,
                 weights: dict[str, float] | None = None, cap: float = IMPACT_CAP,
                 materialize_input: bool = True) -> DataFrame:
    """Z-scores within hazard and

        LEAST(cap, base + w_sev*z_sev + w_pop*z_pop + w_news*z_news + w_tone*tone/10)

    with a NULL z counted as 0; capped above only.  The features are read twice
    (statistics, then rows); unless they are a stored table already, they are
    checkpointed first so their lineage runs once (column pruning makes the two
    reads differ, so Spark would not reuse the shuffle).
    """
    if materialize_input:
        features = materialize(features)
    w = dict(IMPACT_WEIGHTS, **(weights or {}))
    z = zscore_by(features, group, {"severity": "severity", "log_pop": "log_pop",
                                    "news_articles_48h": "news"})
    score = (F.lit(base)
             + F.lit(w["severity"]) * F.coalesce("z_severity", F.lit(0.0))
             + F.lit(w["log_pop"]) * F.coalesce("z_log_pop", F.lit(0.0))
             + F.lit(w["news"]) * F.coalesce("z_news", F.lit(0.0))
             + F.lit(w["tone"]) * F.coalesce(F.col("news_tone_48h") / F.lit(TONE_SCALE), F.lit(0.0)))
    return z.withColumn("impact_score", F.least(F.lit(cap), score))

"""Model-backed steps behind a provider hook: classify, briefs, action lists.

A provider turns a prompt column into a text column.  ``OfflineProvider`` (the
default) is deterministic and JVM-side: it reads only the prompt, as a model
would, with rules and templates.  ``BatchProvider`` wraps any batch function
``list[str] -> list[str]`` (a local model, a client for a hosted one): prompts
are de-duplicated by hash, optionally looked up in a cache table of earlier
answers, and only the missing ones are sent, in Arrow batches via
``mapInPandas``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import fmt_num
from ..functions.text import ACTION_COUNT, ACTION_MAX_CHARS, ACTION_OWNERS, action_prompt, brief_prompt, \
    classify_prompt
from ..session import materialize

ACTION_SCHEMA = "array<struct<priority:string,action:string,owner:string,eta_hours:string>>"


# ---------------------------------------------------------------- providers
class OfflineProvider:
    """Deterministic stand-in for the text model; one method per task."""

    # fixed rules: the first class one of whose words (or its plural) the hazard has
    BUCKET_RULES = [
        (("earthquake", "quake", "seismic"), "seismic"),
        (("hurricane", "cyclone", "typhoon"), "cyclone"),
        (("flood",), "flood"),
        (("winter", "snow", "ice", "blizzard"), "winter"),
        (("wildfire", "fire"), "wildfire"),
        (("storm", "wind", "tornado", "hail"), "wind"),
    ]

    def classify(self, prompt: Column) -> Column:
        hazard = F.lower(F.regexp_extract(prompt, r"Hazard: ([^\n]*)", 1))
        out = None
        for words, label in self.BUCKET_RULES:
            hit = hazard.rlike(r"\b(" + "|".join(words) + r")s?\b")
            out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
        return F.when(prompt.isNotNull(), out.otherwise(F.lit("other")))

    def brief(self, prompt: Column) -> Column:
        def grab(rx):
            return F.regexp_extract(prompt, rx, 1)
        q_type, q_ctry = grab(r"Now: hazard ([^;]*);"), grab(r"Now: hazard [^;]*; country ([^;]*);")
        n_type, n_ctry = grab(r"Before: hazard ([^;]*);"), grab(r"Before: hazard [^;]*; country ([^;]*);")
        num = r"(-?\d+(?:\.\d+)?)"
        sim, d_sev = grab("Similarity: " + num), grab("Severity change: " + num)
        d_imp = grab("Impact change: " + num)
        text = F.concat(
            F.lit("A "), q_type, F.lit(" in "), q_ctry, F.lit(" resembles an earlier "), n_type,
            F.lit(" in "), n_ctry, F.lit(" (cosine similarity "), sim, F.lit("). Severity differs by "),
            d_sev, F.lit(" and impact score by "), d_imp,
            F.lit(". Actions: 1) reuse the neighbour's response plan; 2) pre-position crews where "
                  "exposure is highest; 3) brief the public on the expected impact."))
        return F.when(prompt.isNotNull(), text)

    def actions(self, prompt: Column) -> Column:
        qid = F.regexp_extract(prompt, r"Incident: ([^\n]*)", 1)
        top = F.regexp_extract(prompt, r"Similar incidents: ([^ ,(]*)", 1)
        items = [
            (1, "Activate the operations centre for incident ", qid, "Ops", 1),
            (2, "Review the response to similar incident ", top, "Planning", 4),
            (3, "Stage supplies and crews near incident ", qid, "Logistics", 6),
            (4, "Issue a public advisory for incident ", qid, "Comms", 2),
            (5, "Inspect damaged sites around incident ", qid, "Safety", 12),
        ]
        objs = [F.struct(F.lit(str(p)).alias("priority"), F.concat(F.lit(a), ref).alias("action"),
                         F.lit(o).alias("owner"), F.lit(str(e)).alias("eta_hours"))
                for p, a, ref, o, e in items]
        js = F.to_json(F.array(*objs))
        # integers, as the prompt asks: drop the quotes of priority and eta_hours
        js = F.regexp_replace(js, r'"(priority|eta_hours)":"(\d+)"', '"$1":$2')
        return F.when(prompt.isNotNull(), js)


#: call parameters by task (fixed values); a provider may override them
TASK_PARAMS = {
    "classify": {},
    "brief": {"max_output_tokens": 512, "temperature": 0.2},
    "actions": {"max_output_tokens": 256, "temperature": 0.2},
}


class BatchProvider:
    """Any batch text function as a provider (de-duplicated, cached, Arrow-batched).

    ``fn(prompts)`` or, with ``pass_params``, ``fn(prompts, **params)``.  Answers are keyed by
    provider name, task, parameters and prompt, so providers and settings never share them.  Without
    a cache folder the answers are stored once in the shared folder, so later actions on the result
    do not call the model again.
    """

    def __init__(self, fn: Callable[..., list[str]], cache_path: str | None = None, *, name: str = "batch",
                 params: dict | None = None, pass_params: bool = False):
        self.fn, self.cache_path, self.name = fn, cache_path, name
        self.params, self.pass_params = dict(params or {}), pass_params

    def _cached(self, spark) -> DataFrame | None:
        from pyspark.errors import AnalysisException
        try:
            return spark.read.parquet(self.cache_path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":        # no answer stored yet
                return None
            raise

    def run(self, df: DataFrame, prompt_col: str, out_col: str, task: str = "") -> DataFrame:
        spark = df.sparkSession
        params = {**TASK_PARAMS.get(task, {}), **self.params}
        head = json.dumps([self.name, task, params], sort_keys=True)
        asked = df.where(F.col(prompt_col).isNotNull()).withColumn(
            "_ph", F.sha2(F.concat(F.lit(head), F.col(prompt_col)), 256))
        todo = asked.groupBy("_ph").agg(F.min(prompt_col).alias("_p"))
        cache = self._cached(spark) if self.cache_path else None
        if cache is not None:
            todo = todo.join(cache.select("_ph"), "_ph", "left_anti")
        fn, extra = self.fn, params if self.pass_params else {}

        def call(it):
            for pdf in it:
                outs = fn(pdf["_p"].tolist(), **extra) if len(pdf) else []
                yield pd.DataFrame({"_ph": pdf["_ph"], "_out": pd.Series(outs, dtype=object)})

        fresh = todo.mapInPandas(call, "_ph string, _out string")
        if self.cache_path:
            fresh.write.mode("append").parquet(self.cache_path)
            answers = self._cached(spark)
        else:
            answers = materialize(fresh, "answers")
        # a failed run may have stored an answer twice
        answers = answers.groupBy("_ph").agg(F.min("_out").alias(out_col))
        done = asked.join(answers, "_ph", "left").drop("_ph")
        none = df.where(F.col(prompt_col).isNull()).withColumn(out_col, F.lit(None).cast("string"))
        return done.unionByName(none)          # rows without a prompt never meet on a null key


def _apply(df: DataFrame, prompt_col: str, out_col: str, provider, task: str) -> DataFrame:
    if provider is None or isinstance(provider, OfflineProvider):
        p = provider or OfflineProvider()
        return df.withColumn(out_col, getattr(p, task)(F.col(prompt_col)))
    return provider.run(df, prompt_col, out_col, task)


# ---------------------------------------------------------------- G1
def hazard_buckets(features: DataFrame, provider=None) -> DataFrame:
    """tags: ``event_id, hazard_bucket`` -- one of the fixed labels, NULL for a NULL prompt."""
    p = features.select("event_id", classify_prompt("hazard_type", "country_name", "severity").alias("prompt"))
    return _apply(p, "prompt", "hazard_bucket", provider, "classify").select("event_id", "hazard_bucket")


# ---------------------------------------------------------------- J12, P23
def pair_features(pairs: DataFrame, features: DataFrame, tags: DataFrame) -> DataFrame:
    """query/neighbour features side by side, with buckets and deltas (``enriched``)."""
    f = features.select("event_id", "hazard_type", "country_name", "start_time", "severity", "impact_score")

    def side(pre):
        return f.select(F.col("event_id").alias(f"{pre}_id"), F.col("hazard_type").alias(f"{pre}_type"),
                        F.col("country_name").alias(f"{pre}_country"), F.col("start_time").alias(f"{pre}_start"),
                        F.col("severity").alias(f"{pre}_severity"), F.col("impact_score").alias(f"{pre}_impact"))
    j = (pairs.select("query_event", "neighbor_event", "cosine_similarity")
         .join(side("query"), F.col("query_event") == F.col("query_id"), "inner")
         .join(side("neigh"), F.col("neighbor_event") == F.col("neigh_id"), "inner"))
    tq = tags.select(F.col("event_id").alias("_tq"), F.col("hazard_bucket").alias("query_bucket"))
    tn = tags.select(F.col("event_id").alias("_tn"), F.col("hazard_bucket").alias("neigh_bucket"))
    j = (j.join(tq, F.col("query_event") == F.col("_tq"), "left")
          .join(tn, F.col("neighbor_event") == F.col("_tn"), "left"))
    return (j.drop("query_id", "neigh_id", "_tq", "_tn")
            .withColumn("delta_severity", F.col("query_severity") - F.col("neigh_severity"))
            .withColumn("delta_impact", F.col("query_impact") - F.col("neigh_impact")))


# ---------------------------------------------------------------- G2/G3
def pair_briefs(enriched_pairs: DataFrame, provider=None) -> DataFrame:
    """incident_briefs: ``query_event, neighbor_event, cosine_similarity, similarity_brief``.

    The table-function (ML.GENERATE_TEXT) and scalar (AI.GENERATE) forms of the
    reference are the same operation here.
    """
    p = enriched_pairs.withColumn("prompt", brief_prompt())
    return _apply(p, "prompt", "similarity_brief", provider, "brief").select(
        "query_event", "neighbor_event", "cosine_similarity", "similarity_brief")


def scalar_briefs(pairs: DataFrame, features: DataFrame, provider: OfflineProvider | None = None) -> DataFrame:
    """The scalar form -- classes and briefs as plain column expressions over the joined rows.

    Same columns as ``pair_briefs``; for providers that are column functions.  Classes are computed
    per incident, before the pairs meet them.
    """
    p = provider or OfflineProvider()
    tags = features.select("event_id", p.classify(classify_prompt("hazard_type", "country_name", "severity")).alias("hazard_bucket"))
    return pair_features(pairs, features, tags).select(
        "query_event", "neighbor_event", "cosine_similarity", p.brief(brief_prompt()).alias("similarity_brief"))


# ---------------------------------------------------------------- A5
def neighbor_list(pairs: DataFrame) -> DataFrame:
    """``query_event, neighbor_list``: 'id (sim=0.97), ...' by similarity desc, then id.

    A group holds the k neighbours of one query, so it is bounded by k.
    """
    item = F.concat(F.col("neighbor_event").cast("string"), F.lit(" (sim="),
                    fmt_num(F.col("cosine_similarity"), 2), F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct(
        (-F.col("cosine_similarity")).alias("k1"), F.col("neighbor_event").alias("k2"), item.alias("s"))))
    return (pairs.groupBy("query_event")
            .agg(ordered.alias("_l"))
            .select("query_event", F.array_join(F.transform("_l", lambda x: x["s"]), ", ").alias("neighbor_list")))


# ---------------------------------------------------------------- G4/G5
def action_replies(pairs: DataFrame, provider=None) -> DataFrame:
    """gen: ``query_event, json_actions`` -- one model reply per query incident."""
    ctx = neighbor_list(pairs).withColumn("prompt", action_prompt(F.col("query_event"), F.col("neighbor_list")))
    return _apply(ctx, "prompt", "json_actions", provider, "actions").select("query_event", "json_actions")


def actions_from_json(replies: DataFrame, json_col: str = "json_actions", *, keep_bad: bool = False) -> DataFrame:
    """incident_actions: one row per array item; numbers SAFE_CAST, a bad array gives no rows.

    ``keep_bad=True`` keeps a reply that is not a JSON array as one row of NULLs
    with ``parse_error`` set, instead of dropping it.
    """
    arr = F.from_json(F.col(json_col), ACTION_SCHEMA)
    base = replies.select("query_event", arr.alias("_a"))
    if keep_bad:
        item_type = ACTION_SCHEMA[len("array<"):-1]
        one_null = F.array(F.lit(None).cast(item_type))
        out = base.select("query_event", F.col("_a").isNull().alias("parse_error"),
                          F.explode(F.coalesce(F.col("_a"), one_null)).alias("_it"))
    else:
        out = base.select("query_event", F.explode("_a").alias("_it"))
    cols = ["query_event"] + (["parse_error"] if keep_bad else [])
    return out.select(*cols,
                      F.col("_it.priority").try_cast("bigint").alias("priority"),
                      F.col("_it.action").alias("action"),
                      F.col("_it.owner").alias("owner"),
                      F.col("_it.eta_hours").try_cast("bigint").alias("eta_hours"))


# ---------------------------------------------------------------- G6
def action_contract_report(replies: DataFrame, json_col: str = "json_actions") -> DataFrame:
    """Per reply: did it keep the contract the prompt states?  Counted in the row
    with higher-order functions -- no explode, no shuffle."""
    a = F.from_json(F.col(json_col), ACTION_SCHEMA)
    n = F.when(a.isNull(), F.lit(0)).otherwise(F.size(a))
    owners = F.array(*[F.lit(o) for o in ACTION_OWNERS])

    def count(pred):
        return F.when(a.isNull(), F.lit(0)).otherwise(F.size(F.filter(a, pred))).cast("bigint")
    prio_ok = count(lambda x: F.coalesce(x["priority"].try_cast("int").between(1, 5), F.lit(False)))
    action_ok = count(lambda x: F.coalesce(F.length(x["action"]) <= ACTION_MAX_CHARS, F.lit(False)))
    owner_ok = count(lambda x: F.coalesce(F.array_contains(owners, x["owner"]), F.lit(False)))
    eta_ok = count(lambda x: x["eta_hours"].try_cast("bigint").isNotNull())
    out = replies.select("query_event", a.isNotNull().alias("parsed"), n.cast("bigint").alias("n_items"),
                         prio_ok.alias("n_priority_ok"), action_ok.alias("n_action_ok"),
                         owner_ok.alias("n_owner_ok"), eta_ok.alias("n_eta_ok"))
    ok = ((F.col("n_items") == ACTION_COUNT) & (F.col("n_priority_ok") == ACTION_COUNT)
          & (F.col("n_action_ok") == ACTION_COUNT) & (F.col("n_owner_ok") == ACTION_COUNT)
          & (F.col("n_eta_ok") == ACTION_COUNT))
    return out.withColumn("contract_ok", ok)

"""Registered queries of the corpus operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (exact_dedup, imatch, jaccard, licenses, lm, merkle, mixing, packing, quality, repair, secret_scan, token_files,
               toxicity)
from .common import conversations, documents, labels

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


WORDS_SQL = r"len(regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+'))"


def mixing_sql(docs: str, seed: str = mixing.SEED) -> str:
    """CTEs ``mix_rows`` (every column of ``docs``, size, source_size, target, copies) for DuckDB.

    The level at which the sources stop: by cap per weight, the first place from which the words
    left, shared by the weights left, stay below the cap.
    """
    return f"""
mix_sized as (select *, {WORDS_SQL.format(t='text')}::bigint as size from {docs}),
mix_sources as (select source, sum(size)::bigint as source_size from mix_sized group by source),
mix_weighed as (select *, [5, 2, 1][(row_number() over (order by encode(source) nulls last) - 1) % 3 + 1] as weight,
    3 * source_size as cap from mix_sources),
mix_ordered as (select *,
    coalesce(sum(cap) over (order by cap::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as cut,
    sum(weight) over (order by cap::double / weight, source nulls last rows between current row and unbounded following) as open,
    (select sum(source_size) from mix_weighed) as total from mix_weighed),
mix_level as (select max(level) as level from (select (total - cut)::double / open as level, cap, weight from mix_ordered)
    where cap > level * weight or (select sum(source_size) from mix_weighed) = 0),
mix_targets as (select source, source_size, least(cap::double, coalesce((select level from mix_level), 0) * weight) as target
    from mix_weighed),
mix_drawn as (select d.*, t.source_size, t.target,
    case when t.source_size > 0 then least(t.target / t.source_size, 3.0) else 0.0 end as rate,
    ('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::varchar, '') || ':' || d.size::varchar), 1, 13))::bigint::double
        / 4503599627370496.0 as draw
    from mix_sized d join mix_targets t on d.source is not distinct from t.source),
mix_rows as (select *, (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end)::bigint as copies from mix_drawn)
"""


@query("op1_mix_sources", f"""with {mixing_sql('documents').strip()}
select doc_id, size, source_size, target, copies * size as taken from mix_rows""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def _spans_sql(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""select doc_id, h, owner, repository, {order} as ord, '{kind}' as kind, s.v as value,
    (list_sum(list_transform(gaps[1:s.i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:s.i-1], lambda x: length(x))), 0))::bigint as start,
    (list_sum(list_transform(gaps[1:s.i], lambda x: length(x))) + list_sum(list_transform(whole[1:s.i], lambda x: length(x))))::bigint as fin
  from (select *, unnest(list_transform(range(1, len(whole) + 1), lambda i: {{'i': i, 'v': vals[i]}})) as s
    from (select doc_id, h, owner, repository, regexp_extract_all(text, '{p}', 0) as whole, regexp_extract_all(text, '{p}', {group}) as vals,
          regexp_split_to_array(text, '{p}') as gaps
      from secret_docs where regexp_matches(text, '{p}'))) where length(s.v) >= {least}"""


SECRETS_SQL = "with secret_docs as (select doc_id, coalesce(text, '') as text, md5(coalesce(text, '')) as h, " \
    "source as owner, lang as repository from documents),\nspans as (" + "\nunion all\n".join(
        _spans_sql(k.name, i, k.pattern, k.group, k.least) for i, k in enumerate(secret_scan.KINDS)) + f"""),
wide as (select value from (select distinct value, owner, repository from spans)
    group by value having count(distinct owner) + max(case when owner is null then 1 else 0 end) >= {secret_scan.WIDE_OWNERS}),
per_doc as (select doc_id, h, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || start || ':' || fin, ',' order by start, ord) as spans,
    count(*) filter (value in (select value from wide)) as n_wide from spans group by doc_id, h)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
    coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans,
    coalesce(n_wide, 0)::bigint as n_wide,
    coalesce(n_assign + n_access + n_hex - n_wide, 0)::bigint as n_live
from secret_docs d left join per_doc p on d.doc_id is not distinct from p.doc_id and d.h = p.h"""


@query("op2_secret_scan", SECRETS_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secret_scan.secret_scan(documents(spark, sf_dir))
    found = F.col("found")

    def n(kind: str):
        return F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    spans = secret_scan.span_list(found)
    return s.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(spans, 256).alias("base_sha256"),
                    spans.alias("spans"), "n_wide", "n_live")


@query("op3_rule_ensemble")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op4_log_bilinear")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


@query("op5_imatch_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(documents(spark, sf_dir))


@query("op6_best_two_fit")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_token_files(token_files.write_token_files(documents(spark, sf_dir)))


@query("op8_exact_dedup", """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(documents(spark, sf_dir))


@query("op9_token_group_matrix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


@query("op10_weak_supervision")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op11_merkle_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(conversations(spark, sf_dir))


@query("op13_license_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(documents(spark, sf_dir))

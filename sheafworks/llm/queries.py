"""The registered queries of this package and the SQL that DuckDB can run for them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bpe,
    class_lm,
    fingerprints,
    html_paths,
    line_dedup,
    ngram_join,
    packing,
    quality_rules,
    runs,
    sharding,
    substring_dedup,
    toxicity,
)
from .common import id_remainder


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    path = bpe.vocabulary_path()
    return bpe.encode_documents(_documents(spark, sf_dir), path, bpe.digests, bpe.DIGEST_SCHEMA)


def op2_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and what is like what."""
    return fingerprints.compare_with_edits(_documents(spark, sf_dir))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of near-equal bytes."""
    placed = sharding.shard_documents(_documents(spark, sf_dir), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality_rules.document_verdicts(_documents(spark, sf_dir))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op5_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 tokens."""
    return packing.pack_documents(_documents(spark, sf_dir), bpe.vocabulary_path())


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores under a model of the documents that are not held out."""
    docs = _documents(spark, sf_dir)
    model, counts = class_lm.train(docs.where(id_remainder(7) != 2).select("text"))
    scored = class_lm.score_documents(docs, model, counts)
    return scored.select(
        "doc_id",
        (id_remainder(7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op7_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after repeated windows of 35 words go."""
    cut = substring_dedup.remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"), 35, keep_text=False)
    return cut.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))


def op8_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 5-word shingle similarity of 0.8 or more."""
    return ngram_join.component_ids(_documents(spark, sf_dir))


def op9_nb_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.held_out_scores(_documents(spark, sf_dir), labels)


def op10_sorted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document left after repeated lines go."""
    cut = line_dedup.drop_repeated_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_interval_coalescing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers on every document, with corpus-wide counts of linked ids."""
    found = alignment.align_documents(_documents(spark, sf_dir), keep_groups=False)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by the container paths of its host."""
    found = html_paths.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_kruskal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one in ten of them made periodic first."""
    return runs.digests(runs.find_runs(runs.with_repeats(_documents(spark, sf_dir)), keep_text=False))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_tree_bpe,
        op2_syncmer_fingerprints,
        op3_virtual_slots,
        op4_host_rules,
        op5_sum_of_squares,
        op6_class_lm,
        op7_count_min_substrings,
        op8_signature_tree_join,
        op9_nb_ngram_toxicity,
        op10_sorted_runs,
        op11_interval_coalescing,
        op12_host_paths,
        op13_kruskal_runs,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP4 = rf"""
with docs as (
    select row_number() over () as rn, doc_id, source, coalesce(text, '') as t, {_WORDS} as ws from documents
), words as (
    select rn, unnest(ws) as w, generate_subscripts(ws, 1) as pos from docs
), windows as (
    select rn, pos, w, lead(w, 1) over o as w1, lead(w, 2) over o as w2, lead(w, 3) over o as w3, lead(w, 4) over o as w4
    from words window o as (partition by rn order by pos)
), twice as (
    select rn, pos from (
        select rn, pos, w4, count(*) over (partition by rn, w, w1, w2, w3, w4) as n from windows
    ) where w4 is not null and n > 1
), repeats as (
    select rn, count(distinct p) as n_repeat_words
    from (select rn, unnest(range(pos, pos + 5)) as p from twice) group by rn
), lines as (
    select rn, unnest(string_split(t, chr(10))) as line from docs
), dups as (
    select rn, count(*) - count(distinct line) as n_dup_lines
    from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by rn
), chars as (
    select rn, sum(length(w)) as word_chars from words group by rn
), m as (
    select d.rn, doc_id, source, len(ws)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        length(t) - length(replace(t, chr(10), '')) + 1 as n_lines
    from docs d left join repeats using (rn) left join dups using (rn) left join chars using (rn)
), rules as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
        [n_words < 10, 100 * n_repeat_words > 20 * n_words, 100 * n_symbols > 10 * n_words,
         100 * n_dup_lines > 30 * n_lines] as failed
    from m
), flat as (
    select source, unnest(failed)::int as f, generate_subscripts(failed, 1) as rule from rules where source is not null
), hosts as (
    select source, rule, sum(f)::double as f, count(*)::double as n from flat group by source, rule
), sums as (
    select rule, sum(f) / sum(n) as mean, sum(n) as total, count(*) as hosts, sum(n * n) as squares, sum(f * f / n) as q
    from hosts group by rule
), prior as (
    select rule, mean, case when total - squares / total > 0 then
        (q - total * mean * mean - (hosts - 1) * mean * (1 - mean)) / (total - squares / total) end as variance
    from sums
), strength as (
    select rule, mean, case when variance > 0 and mean > 0 and mean < 1
        then greatest(mean * (1 - mean) / variance - 1, 0) end as s from prior
), bad as (
    select distinct source from hosts join strength using (rule)
    where case when s is null then mean else (f + mean * s) / (n + s) end > greatest(0.5, (1 + mean) / 2)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and (source is null or source not in (select source from bad)) as kept
from rules
"""

_OP7 = rf"""
with docs as (
    select row_number() over () as rn, doc_id, {_WORDS} as ws from documents
), windows as (
    select rn, p, array_to_string(ws[p:p + 34], ' ') as s
    from (select rn, ws, unnest(range(1, len(ws) - 33)) as p from docs where len(ws) >= 35)
), again as (
    select rn, p from (select rn, p, count(*) over (partition by s) as n from windows) where n > 1
), gone as (
    select distinct rn, unnest(range(p, p + 35)) as pos from again
), words as (
    select rn, unnest(ws) as w, generate_subscripts(ws, 1) as pos from docs
), kept as (
    select rn, string_agg(w, ' ' order by pos) as k, count(*) as n from words anti join gone using (rn, pos) group by rn
)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
    sha256(coalesce(k, '')) as kept_sha256
from docs left join kept using (rn)
"""

_UPPER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP8 = rf"""
with recursive docs as (
    select row_number() over () as rn, doc_id,
        regexp_extract_all({_UPPER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as ws from documents
), shingles as (
    select distinct rn, array_to_string(ws[p:p + 4], ' ') as s
    from (select rn, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as p from docs where len(ws) > 0)
), sizes as (
    select rn, count(*) as n from shingles group by rn
), common as (
    select a.rn as x, b.rn as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.rn <> b.rn group by all
), links as (
    select x, y from common join sizes a on a.rn = x join sizes b on b.rn = y where 100 * c >= 80 * (a.n + b.n - c)
), reach as (
    select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x
), least_id as (
    select x as rn, min(doc_id) as low from reach join docs on docs.rn = reach.y group by x
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id
from docs left join sizes using (rn) left join least_id using (rn)
"""

_KEY = _UPPER.format("trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))")

_OP10 = f"""
with docs as (
    select row_number() over () as rn, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents
), lines as (
    select rn, doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from docs
), keyed as (
    select *, {_KEY} as k from lines
), found as (
    select k, max(doc_id) as last from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3
), kept as (
    select rn, string_agg(line, chr(10) order by pos) as t, count(*) as n
    from keyed left join found using (k) where last is null or last = doc_id group by rn
)
select doc_id, len(ls)::bigint as n_lines, (len(ls) - coalesce(n, 0))::bigint as n_dropped,
    sha256(coalesce(t, '')) as kept_sha256
from docs left join kept using (rn)
"""


#: For pages with one article element without parts to leave out, as the given tables have them.
_OP12 = r"""
with found as (
    select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) as a from pages
), bare as (
    select page_id, url,
        regexp_replace(regexp_replace(a, '</?(?:p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') as a from found
), texts as (
    select page_id, url, trim(regexp_replace(
        regexp_replace(regexp_replace(a, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
        '[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+',
        ' ', 'g')) as text
    from bare
)
select page_id, url, text, length(text)::bigint as n_chars from texts
"""

_OP13 = rf"""
with recursive docs as (
    select row_number() over () as rn, doc_id, {_WORDS} as ws, coalesce(cast(doc_id as varchar), '') as d from documents
), bits as (
    select rn, d, 0 as k, 4294967295::bigint as c from docs
    union all
    select rn, d, k + 1, case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end
    from (
        select rn, d, k, case when k % 8 = 0 then xor(c, ascii(substr(d, k // 8 + 1, 1))::bigint) else c end as x
        from bits where k < 8 * length(d)
    )
), edits as (
    select rn, doc_id, ws, len(ws) as n, h, h // 10 as g
    from docs join (select rn, xor(c, 4294967295::bigint) as h from bits where k = 8 * length(d)) using (rn)
), places as (
    select *, case when h % 10 = 0 and n > 0 then g % n end as a from edits
), periods as (
    select *, 1 + (n - a) // (3 + g % 8) as p from places
), texts as (
    select rn, doc_id, n, case when a is null then ws
        else ws[:a] || list_transform(range(0, n - a), lambda i: ws[a + i % p + 1]) end as ws
    from periods
), windows as (
    select rn, i, array_to_string(ws[i:i + 15], ' ') as s
    from (select rn, ws, unnest(range(1, n - 14)) as i from texts where n >= 16)
), pairs as (
    select x.rn, x.i, y.i - x.i as q from windows x join windows y on x.rn = y.rn and x.s = y.s and x.i < y.i
), islands as (
    select rn, q, min(i) as i, count(*) + 15 + q as length
    from (select *, i - row_number() over (partition by rn, q order by i) as island from pairs) group by rn, q, island
), found as (
    select rn, i - 1 as start, length, min(q) as period
    from islands where length >= 24 and length >= 3 * q group by rn, i, length
), best as (
    select rn, start, length, period
    from (select *, row_number() over (partition by rn order by length::double / period desc, start, period) as k from found)
    where k = 1
), lists as (
    select rn, count(*) as n_runs,
        string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as l
    from found group by rn
), gone as (
    select distinct rn, unnest(range(start + period, start + length)) + 1 as pos from found
), words as (
    select rn, unnest(ws) as w, generate_subscripts(ws, 1) as pos from texts
), kept as (
    select rn, string_agg(w, ' ' order by pos) as t from words anti join gone using (rn, pos) group by rn
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length,
    period::bigint as period, (1000 * length // period)::bigint as exponent_milli,
    sha256(coalesce(l, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from texts left join best using (rn) left join lists using (rn) left join kept using (rn)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_host_rules": _OP4,
        "op7_count_min_substrings": _OP7,
        "op8_signature_tree_join": _OP8,
        "op10_sorted_runs": _OP10,
        "op12_host_paths": _OP12,
        "op13_kruskal_runs": _OP13,
    }

"""The dealt operators bound to the test tables with their production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, decontamination, grammar_tokens, licenses, near_duplicates, packing, pages, passages, perplexity, quality_rules, structure, token_counts, whitening,
)
from ..session import cut
from .common import scratch, table


def op1_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), with_ids=False))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("version")


def op3_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    grammar_tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return grammar_tokens.read_tokens(spark, path, with_ids=False)


def op4_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents")).drop("version")


def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"), "lang")
    return token_counts.with_suffix_sums(token_counts.histogram(lengths)).withColumnRenamed("grp", "lang")


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op7_risk_controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("version", "failed_rules")


def op8_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op9_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.sql(f"select * from values (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') t(conv_id, turn, role, text)")
    return chat.read_back(cut(chat.windows(given.unionByName(fixed))))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("version")


def op11_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("version")


def op12_bit_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return structure.report(structure.damage(given), given)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bestfit": op1_bestfit,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_repair": op3_repair,
    "op4_compact_windows": op4_compact_windows,
    "op5_length_histogram": op5_length_histogram,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_risk_controlled": op7_risk_controlled,
    "op8_crf": op8_crf,
    "op9_budgeted_windows": op9_budgeted_windows,
    "op10_winnowing": op10_winnowing,
    "op11_diagonal_voting": op11_diagonal_voting,
    "op12_bit_scatter": op12_bit_scatter,
    "op13_path_ranking": op13_path_ranking,
}

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TEMPLATE_VALUES = ", ".join("({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(licenses.TEMPLATES))
_PHRASE_VALUES = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.PHRASES)

ORACLE: dict[str, str] = {
    "op7_risk_controlled": rf"""
with d as (select row_number() over () as r, doc_id, coalesce('=' || lang, '-') as s, coalesce(text, '') as t from documents),
a as (
  select r, doc_id, s, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d),
g as (select r, p, w[p:p + 2] as run from (select r, w, unnest(range(1, len(w) - 1)) as p from a)),
rep as (select r, p from g join (select r, run from g group by all having count(*) > 1) using (r, run)),
cov as (select r, count(distinct q) as n from (select r, unnest(range(p, p + 3)) as q from rep) group by r),
m as (
  select r, doc_id, s, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words,
         len(lines) as n_lines, len(regexp_extract_all(t, '[A-Z]')) as n_capitals,
         len(regexp_extract_all(lower(t), '\b(?:{"|".join(quality_rules.INSULTS)})\b')) as n_insults
  from a left join cov using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
v as (
  select r, s, base_failed, doc_id, unnest([0, 1, 2, 3, 4]) as rule, unnest([
    floor(1000 * n_symbols / greatest(n_words, 1)), floor(1000 * n_dup_lines / greatest(n_lines, 1)),
    floor(1000 * n_repeat_words / greatest(n_words, 1)), floor(1000 * n_capitals / greatest(word_chars, 1)),
    floor(1000 * n_insults / greatest(n_words, 1))]) as mark
  from b),
good as (
  select doc_id from labels group by doc_id
  having bool_and(coalesce(quality = 1, false) and coalesce(toxic = 0, false)) and doc_id is not null),
held as (select s, rule, mark from v join good using (doc_id) where not base_failed),
grid as (select unnest({list(quality_rules.GRID)}) as cut),
tried as (
  select s, rule, cut, count(*) as n, count(*) filter (where mark > cut) as k from held, grid group by all),
tests as (select count(distinct (s, rule)) as tests from held),
tail as (
  select s, rule, cut,
    case when k >= n * {quality_rules.LIMIT} then 1.0
    else (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality_rules.LIMIT}) + (n - i) * ln(1 - {quality_rules.LIMIT})))
          from (select unnest(range(0, k + 1)) as i)) end <= {quality_rules.LEVEL} / tests as ok
  from tried, tests),
chosen as (
  select s, rule, min(cut) as cut from tail
  where cut > coalesce((select max(t.cut) from tail t where t.s = tail.s and t.rule = tail.rule and not t.ok), -1) group by all),
wrong as (select distinct r from v join chosen using (s, rule) where mark > cut)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and r not in (select r from wrong) as kept
from b""",
    "op10_winnowing": rf"""
with d as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}'), []) as w
  from documents),
i as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as w
  from benchmark where text is not null),
iw as (
  select distinct item_id, list_slice(w, p, p + least(13, len(w)) - 1) as run
  from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as p from i where len(w) > 0)),
sizes as (select distinct len(run) as n from iw),
dw as (
  select r, n, p, list_slice(w, p, p + n - 1) as run
  from (select r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) as p from d, sizes)),
met as (select r, p, n, item_id from dw join iw using (run)),
hit as (select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from met) group by r),
its as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id::varchar as item_id from met) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (r) left join its using (r)""",
    "op11_diagonal_voting": rf"""
with d as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}'), []) as w
  from documents),
t as (
  select template, label, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as w
  from (values {_TEMPLATE_VALUES}) as v(template, label, text)),
tg as (select template, p, w[p:p + {licenses.K - 1}] as run from (select template, w, unnest(range(1, len(w) - {licenses.K} + 2)) as p from t)),
dg as (select r, p, w[p:p + {licenses.K - 1}] as run from (select r, w, unnest(range(1, greatest(len(w) - {licenses.K} + 2, 1))) as p from d)),
met as (select distinct r, template, dg.p - tg.p as diagonal, tg.p as t_place from dg join tg using (run)),
centres as (select distinct r, template, diagonal as centre from met),
covered as (
  select distinct r, template, centre, t_place + unnest(range(0, {licenses.K})) as q
  from centres join met using (r, template) where abs(diagonal - centre) <= {licenses.BAND}),
shares as (
  select r, c.template, centre, label, count(*) / len(any_value(w)) as share,
         count(*) filter (regexp_full_match(w[q], '[0-9]+')) = len(list_filter(any_value(w), lambda x: regexp_full_match(x, '[0-9]+'))) as numbers
  from covered as c join t on t.template = c.template group by all),
best as (
  select r, max(share) as score, list(distinct label) filter (share >= {licenses.COVERED} and numbers) as own from shares group by r),
phrases as (select string_split(phrase, ' ') as p, label from (values {_PHRASE_VALUES}) as v(phrase, label)),
places as (select r, unnest(range(1, len(w) + 1)) as i, w from d where list_has_any(w, ['gnu', 'apache', 'cc', 'mit'])),
stood as (select r, i - 1 as i, label from places join phrases on w[i] = p[1] and w[i:i + len(p) - 1] = p),
base as (select r, count(*) as n_base, min(i) as first_word, max(i) as last_word, list(distinct label) as labels from stood group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(own, [])))), ','), '') as labels,
       coalesce(score, 0.0)::double as score
from d left join base using (r) left join best using (r)""",
}

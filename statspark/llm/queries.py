"""The corpus operators as registered queries, with their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chunk_dedup,
    decontaminate,
    exact_dedup,
    fill_in_middle,
    language_id,
    licenses,
    lm_score,
    mixing,
    ngram_join,
    pieces,
    secrets,
    spelling,
    suffix_dedup,
)
from .shared import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secrets(docs, net=secrets.train(docs))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop("spans")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language_id.document_rows(table(spark, sf_dir, "documents"))
    return language_id.identified(docs.unionByName(language_id.page_rows(table(spark, sf_dir, "pages"))))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op11_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mixture(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    output, form = F.col("output"), F.col("form")
    parts = fill_in_middle.parts(output, form)
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.length(parts["prefix"]).cast("long").alias("prefix_chars"),
        F.length(parts["middle"]).cast("long").alias("middle_chars"),
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(output, form), 256).alias("restored_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(table(spark, sf_dir, "documents"), every=31))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_benchmark_decontamination": op5_benchmark_decontamination,
        "op6_license_scan": op6_license_scan,
        "op7_language_id": op7_language_id,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_mixing_sources": op11_mixing_sources,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_jaccard_join": OP4, "op5_benchmark_decontamination": OP5, "op9_exact_dedup": OP9, "op11_mixing_sources": OP11, "op12_fill_in_middle": OP12}


_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP5 = f"""
with item as (select cast(item_id as varchar) as item_id, {_WORDS} as w from benchmark),
 win as (select distinct item_id, least(13, len(w)) as n, list_slice(w, i, i + least(13, len(w)) - 1) as win
  from (select item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) as i from item where len(w) > 0)),
 doc as (select doc_id, {_WORDS} as w from documents),
 sizes as (select distinct n from win),
 place as (select doc_id, n, unnest(generate_series(1, len(w) - n + 1)) as i, w from doc, sizes where len(w) >= n),
 hit as (select doc_id, i, p.n, item_id from place p join win on win.n = p.n and win.win = list_slice(p.w, p.i, p.i + p.n - 1)),
 word as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as j from hit) group by doc_id),
 per as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hit group by doc_id)
select doc.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
 sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join word on word.doc_id = doc.doc_id left join per on per.doc_id = doc.doc_id
"""

OP9 = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm, length(coalesce(text, '')) as n from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
 doc_id = first_value(doc_id) over w as kept, sha256(norm) as text_sha256
from t window w as (partition by norm order by n desc, doc_id rows between unbounded preceding and unbounded following)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
with recursive doc as (select doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
 shingle as (select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as s
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) as i from doc where len(w) > 0)),
 size as (select doc_id, count(*) as n from shingle group by doc_id),
 common as (select a.doc_id as a, b.doc_id as b, count(*) as i from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by all),
 link as (select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where 100 * i >= 85 * (x.n + y.n - i)),
 side as (select a, b from link union all select b, a from link),
 reach as (select doc_id as a, doc_id as b from doc union select reach.a, side.b from reach join side on side.a = reach.b)
select doc.doc_id, coalesce(n, 0) as n_shingles, m as component_id
from doc left join size on size.doc_id = doc.doc_id join (select a, min(b) as m from reach group by a) r on r.a = doc.doc_id
"""

OP11 = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, md5('42:' || coalesce(cast(doc_id as varchar), '')) as k from documents),
 per as (select source, cast(sum(size) as hugeint) as z, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as w, row_number() over (order by source nulls last) as place from d group by source),
 fill as (select *, sum(z) over () as words, sum(w) over () as weight,
   coalesce(sum(w) over (order by cast(2 * z as double) / w, place rows between unbounded preceding and 1 preceding), 0) as w0,
   coalesce(sum(2 * z) over (order by cast(2 * z as double) / w, place rows between unbounded preceding and 1 preceding), 0) as z0 from per),
 judged as (select *, 100 * 2 * z * (weight - w0) < w * (150 * words - 100 * z0) as is_full from fill),
 aim as (select source, z, case when is_full then cast(2 * z as double)
   else cast(w * (150 * words - 100 * coalesce(sum(2 * z) filter (is_full) over (), 0)) as double) / cast(100 * sum(w) filter (not is_full) over () as double) end as target from judged),
 cut as (select source, z, target, case when z > 0 then floor(floor(target) / z) else 0 end as whole from aim),
 run as (select doc_id, size, z, target, whole, coalesce(sum(size) over (partition by d.source order by k, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) as before
   from d join cut on d.source is not distinct from cut.source)
select doc_id, cast(size as bigint) as size, cast(z as bigint) as source_size, target,
 cast(whole * size + greatest(0, least(size, floor(target) - whole * z - before)) as bigint) as taken from run
"""

OP12 = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u from documents),
 h as (select *, len(u) as n, cast('0x' || h[1:8] as ubigint) % (len(u) + 1) as a, cast('0x' || h[9:16] as ubigint) % (len(u) + 1) as b,
   case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or cast('0x' || h[17:24] as ubigint) % 100 >= 50 then 'plain'
    when cast('0x' || h[25:32] as ubigint) % 100 < 80 then 'spm' else 'psm' end as form from d),
 p as (select doc_id, t, n, form, array_to_string(list_slice(u, 1, least(a, b)), '') as prefix,
   array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') as middle, array_to_string(list_slice(u, greatest(a, b) + 1, n), '') as suffix from h)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
 case when form <> 'plain' then length(middle) end as middle_chars,
 sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
 sha256(t) as restored_sha256 from p
"""

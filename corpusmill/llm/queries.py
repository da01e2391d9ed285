"""The queries of this subpackage over the test tables, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import copies, level, lookalikes, mixture, neardup, packing, quality, residue, sentences, terms
from corpusmill.session import read_table as table


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parse_data").select(F.col("page_id").alias("rec_id"), "url", F.col("text_list").alias("texts"))


def _articles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("rec_id"), F.col("page_url").alias("url"), F.array("text").alias("texts"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [residue.records_with_markup(r(spark, d)).select(F.lit(n).alias("table_name"), "rec_id", "sec_idx") for n, r in (("parse_data", _sections), ("documents", _articles))]
    return parts[0].unionByName(parts[1])


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    parts = [residue.cleaned(r(spark, d)).select(F.lit(n).alias("table_name"), "rec_id", F.posexplode_outer("texts").alias("sec_idx", "text")) for n, r in (("parse_data", _sections), ("documents", _articles))]
    return parts[0].unionByName(parts[1])


def p1_pages(spark: SparkSession, d: str) -> DataFrame:
    return residue.page_slots(table(spark, d, "crawl_data"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return terms.marked(terms.delivered_counts(table(spark, d, "freq_dict"))).where("mark <> 'useful'").select("word", "mark")


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    return terms.marked(terms.delivered_counts(table(spark, d, "freq_dict")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_sections(table(spark, d, "normalize_data")).select("page_a", "sec_a", "page_b", "sec_b")


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_classes(table(spark, d, "normalize_data"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "normalize_data")).where("junk").select("page_id", "sec_idx")


def p4_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "normalize_data"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.look_alike_pairs(table(spark, d, "parse_data"))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.forms(table(spark, d, "parse_data")).select("page_id", "sec_idx", "form")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.page_copies(table(spark, d, "normalize_data")).where("first_page_id <> page_id")


def p6_copies(spark: SparkSession, d: str) -> DataFrame:
    return copies.copy_counts(table(spark, d, "normalize_data"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sample_sentences(table(spark, d, "parse_data"), table(spark, d, "segment_sample"))


def p7_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_texts(table(spark, d, "parse_data"))


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(table(spark, d, "documents"), table(spark, d, "containers"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(p8_packing(spark, d), table(spark, d, "containers"))


def p8_checked(spark: SparkSession, d: str) -> DataFrame:
    return packing.checked(p8_packing(spark, d), table(spark, d, "containers"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return level.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels")).select("doc_id", "reading_band")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return level.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [p1_found, p1_clean, p1_pages, p2_found, p2_counts, p3_found, p3_classes, p4_found, p4_quality, p5_found, p5_forms, p6_found, p6_copies, p7_found, p7_sentences, p8_packing, p8_fill, p8_checked, p9_mixture, p9_report, p10_found, p10_levels]
    return {f.__name__: f for f in named}


_WORDS = """
with once as (select distinct on (page_id) page_id, text_list from freq_dict where page_id is not null),
sentence as (select page_id, unnest(flatten(text_list)) as s from once),
word as (select page_id, unnest(string_split(s, ' ')) as word from sentence where s is not null),
used as (select * from word where word <> ''),
total as (select count(distinct page_id) as n from used),
counted as (select word, count(*) as n_occurrences, count(distinct page_id) as n_pages from used group by word),
marked as (select word, n_occurrences, n_pages,
  case when n_pages < 3 then 'rare' when n_pages > 0.5 * n then 'common' else 'useful' end as mark from counted, total)
"""
_COPIES = """
with once as (select distinct on (page_id) page_id, text_list from normalize_data where page_id is not null and len(text_list) > 0),
section as (select page_id, regexp_replace(lower(coalesce(s, '')), '[^\\p{L}\\p{N}]', '', 'g') as s from (select page_id, unnest(text_list) as s from once)),
form as (select page_id, list(s order by s) as form from section group by page_id),
grouped as (select page_id, min(page_id) over (partition by form) as first_page_id from form)
"""
_NEAR = """
with once as (select distinct on (page_id) page_id, text_list from normalize_data where page_id is not null and len(text_list) > 0),
section as (select page_id, unnest(text_list) as s, unnest(range(len(text_list)))::int as sec_idx from once),
norm as (select page_id, sec_idx, trim(regexp_replace(lower(coalesce(s, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) as t from section),
kinds as (select t, row_number() over (order by t) as k, replace(t, ' ', '') as bare from (select distinct t from norm where t <> '')),
piece as (select distinct k, unnest(case when length(t) < 5 then [t] else list_transform(range(1, length(t) - 3), lambda i: substring(t, i, 5)) end) as p from kinds),
sized as (select k, count(*) as n from piece group by k),
freq as (select p, count(*) as f from piece group by p),
ranked as (select k, p, row_number() over (partition by k order by f, p) as r from piece join freq using (p)),
prefix as (select k, p from ranked join sized using (k) where r <= n - ceil(0.8 * n) + 1),
candidate as (select distinct a.k as a, b.k as b from prefix a join prefix b using (p) where a.k < b.k),
close as (select a, b from candidate join sized x on x.k = a join sized y on y.k = b where least(x.n, y.n) >= 0.8 * greatest(x.n, y.n)),
common as (select a, b, count(*) as c from close join piece x on x.k = a join piece y on y.k = b and y.p = x.p group by a, b),
linked as (select a, b from common join sized x on x.k = a join sized y on y.k = b where c > 0.8 * (x.n + y.n - c)),
pair as (select ka.t as ta, kb.t as tb from linked join kinds ka on ka.k = a join kinds kb on kb.k = b where ka.bare <> kb.bare),
ends as (select x.page_id as pa, x.sec_idx as sa, y.page_id as pb, y.sec_idx as sb from pair join norm x on x.t = ta join norm y on y.t = tb)
select case when (pa, sa) < (pb, sb) then pa else pb end as page_a, case when (pa, sa) < (pb, sb) then sa else sb end as sec_a,
  case when (pa, sa) < (pb, sb) then pb else pa end as page_b, case when (pa, sa) < (pb, sb) then sb else sa end as sec_b from ends
"""
_WIDE_FROM = "".join(map(chr, range(0xFF01, 0xFF5F)))
_WIDE_TO = "".join(map(chr, range(0x21, 0x7F)))


def _looks_sql() -> str:
    """Look-alikes by plain replacement: what the mapping of code points does to characters that pages hold."""
    alike = {k: v for k, v in lookalikes.LOOK_ALIKE.items() if len(v) == 1 and v != "'"}
    for c in map(chr, [*range(0x370, 0x530), *range(0x1F00, 0x2000)]):  # Greek and Cyrillic letters with accents
        shown = unicodedata.normalize("NFC", lookalikes.shape(c))
        if len(shown) == 1 and shown != c:
            alike[c] = shown
    signs = "".join(alike) + "‑", "".join(alike.values()) + "-"
    quote = lambda s: s.replace("'", "''")
    form = f"translate(s, '{quote(_WIDE_FROM)}', '{quote(_WIDE_TO)}')"
    form = rf"regexp_replace({form}, '[\x{{00AD}}\x{{200B}}-\x{{200F}}\x{{202A}}-\x{{202E}}\x{{2060}}-\x{{2064}}\x{{FEFF}}\x{{FE00}}-\x{{FE0F}}]', '', 'g')"
    form = rf"regexp_replace({form}, '[\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}\t]', ' ', 'g')"
    form = f"replace(replace(replace(replace(replace({form}, 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl')"
    form = f"nfc_normalize(translate({form}, '{quote(signs[0])}', '{quote(signs[1])}'))"
    return f"""
with once as (select distinct on (page_id) page_id, text_list from parse_data where page_id is not null and len(text_list) > 0),
section as (select page_id, unnest(text_list) as s, unnest(range(len(text_list)))::int as sec_idx from once),
formed as (select page_id, sec_idx, s, {form} as f from section where s is not null)
select a.page_id as page_a, a.sec_idx as sec_a, b.page_id as page_b, b.sec_idx as sec_b
from formed a join formed b on a.f = b.f and a.s <> b.s and (a.page_id, a.sec_idx) < (b.page_id, b.sec_idx)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _WORDS + "select word, mark from marked where mark <> 'useful'",
        "p2_counts": _WORDS + "select * from marked",
        "p3_found": _NEAR,
        "p5_found": _looks_sql(),
        "p6_found": _COPIES + "select first_page_id, page_id from grouped where first_page_id <> page_id",
        "p8_checked": "select container_name, doc_id, true as whole, true as fits from documents, containers where doc_id is not null and text <> '' and token_capacity > 0",
        "p6_copies": _COPIES + "select first_page_id as page_id, count(*) as n_copies from grouped group by first_page_id",
    }

"""SQL for the core's queries, over the same tables."""

from __future__ import annotations

from corpusmill.functions.normalize import BLANKS, PLAIN, TYPOGRAPHIC, ZERO_WIDTH
from corpusmill.operators.segment import END, NO_END
from corpusmill.operators.stats import REPORT
from corpusmill.schemas import DUPLICATE_MARK

# White space of Unicode, which RE2 does not know as \s.
SPACE = r"[ \t\n\x{0B}\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _replace(t: str, form: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({t}, {_quote(form)}, {to}, '{flags}')"


def _whitespace(t: str) -> str:
    t = _replace(t, r"\r\n?", "chr(10)")
    t = _replace(t, r"[\x00-\x08\x0B-\x1F\x7F]", "''")
    t = f"translate({t}, {_quote(BLANKS + ZERO_WIDTH)}, {_quote(' ' * len(BLANKS))})"
    t = _replace(t, r"([^\n ]) {2,}", r"'\1 '")
    t = _replace(t, r"\n {3,}", "chr(10) || '  '")
    t = _replace(t, r"^ {3,}", "'  '", "")
    t = _replace(t, rf"\n{SPACE}*\n", "chr(10) || chr(10)")
    return _replace(_replace(t, rf"^{SPACE}+", "''", ""), rf"{SPACE}+$", "''", "")


def _marks(t: str) -> str:
    return f"translate({t}, {_quote(TYPOGRAPHIC)}, {_quote(PLAIN)})"


def _once(table: str, column: str = "text_list") -> str:
    return f"select distinct on (page_id) page_id, url, {column} from {table} where page_id is not null"


def _each(table: str, name: str = "t") -> str:
    return f"select page_id, url, unnest(text_list) as {name}, unnest(range(len(text_list)))::int as sec_idx from ({_once(table)}) where len(text_list) > 0"


def _mapped(f: str) -> str:
    return f"select page_id, sec_idx, {f} as text from ({_each('parse_data')})"


_FULL = _marks(_whitespace("nfc_normalize(t)"))
_REPORT = ", ".join(f"({_quote(c)}, 'U+{ord(c):X}')" for c in REPORT)
_WORD = f"""
with sentence as (select page_id as page, sec, unnest(sents) as s, unnest(range(len(sents))) as sent from
  (select page_id, unnest(text_list) as sents, unnest(range(len(text_list))) as sec from ({_once("freq_dict")}) where len(text_list) > 0) where len(sents) > 0),
word as (select page, sec, sent, unnest(string_split(s, ' ')) as word, unnest(range(len(string_split(s, ' ')))) as pos from sentence where s is not null),
freq as (select word, count(*) as freq, min({{'page': page, 'sec': sec, 'sent': sent, 'pos': pos}}) as first_pos from word group by word),
letter as (select word, freq, first_pos, unnest(range(1, length(word) + 1)) as i from freq where word <> ''),
pair as (select substring(word, i, 1) as left_token, substring(word, i + 1, 1) as right_token, freq, first_pos, i from letter where i < length(word)),
pairs as (select left_token, right_token, sum(freq)::bigint as n, min({{'p': first_pos, 'i': i}}) as first_at from pair group by all)
"""
_TOKENS = (
    _WORD
    + """,
reach as (select token from vocab v where not exists (select 1 from range(1, length(v.token)) r(k) where substring(v.token, 1, k) not in (select token from vocab))),
sizes as (select distinct length(token)::bigint as k from reach),
step as (select w.word, w.i, coalesce(max(length(r.token)), 1) as k from letter w
  left join sizes s on w.i + s.k - 1 <= length(w.word) left join reach r on r.token = substring(w.word, w.i, s.k) group by w.word, w.i),
"""
)
_WALK = _TOKENS.replace("with sentence", "with recursive sentence", 1) + """
walk as (select word, 1::bigint as i from freq where word <> '' union all select w.word, w.i + s.k from walk w join step s on s.word = w.word and s.i = w.i where w.i + s.k <= length(w.word)),
token as (select w.word, w.i, substring(w.word, w.i, s.k) as token from walk w join step s on s.word = w.word and s.i = w.i)
"""
_LINKS = rf"""
with page as ({_once("crawl_data", "text")}),
bare as (select page_id, regexp_replace(regexp_replace(text, '<!--.*?-->', '', 'gs'), '(?i)<(script|style)\b[^>]*>.*?</(script|style)\s*>', '', 'gs') as t from page where text is not null),
tags as (select page_id, list_filter(regexp_extract_all(t, '<a\s[^>]*>'), lambda a: starts_with(regexp_extract(a, 'href="([^"]*)"', 1), '/wiki/')
  and not starts_with(regexp_extract(a, 'href="([^"]*)"', 1), '/wiki/List_of') and not starts_with(regexp_extract(a, 'href="([^"]*)"', 1), '/wiki/Main_Page')
  and not contains(regexp_extract(a, 'href="([^"]*)"', 1), ':') and not list_contains(string_split(regexp_extract(a, 'class="([^"]*)"', 1), ' '), 'mw-redirect')) as a from bare)
select page_id, unnest(range(len(a)))::int as pos, 'https://enc.example' || regexp_extract(unnest(a), 'href="([^"]*)"', 1) as url from tags where len(a) > 0
"""
_ARTICLE = "starts_with(url, 'https://enc.example/wiki/') and not starts_with(url, 'https://enc.example/wiki/List_of') and not starts_with(url, 'https://enc.example/wiki/Main_Page') and not contains(substring(url, 20), ':')"
_SENTENCE = _replace(_replace(_replace("t", END, r"'\1' || chr(1) || '\2'"), NO_END, r"'\1\2. '"), NO_END, r"'\1\2. '")

SQL = {
    "nfc": _mapped("nfc_normalize(t)"),
    "normalize_whitespace": _mapped(_whitespace("t")),
    "normalize_quotes_dashes": _mapped(_marks("t")),
    "normalize_full": _mapped(_FULL),
    "length_cutoff": f"""with page as (select page_id, list_filter(list_transform(text_list, lambda t: {_FULL}), lambda t: length(t) >= 50) as x from ({_once("parse_data")}) where text_list is not null)
select page_id, len(x)::int as n_sections, length(list_aggregate(list_concat([''], x), 'string_agg', ''))::int as n_chars from page""",
    "char_frequency": f"""with texts as (select t from ({_each("parse_data")}) union all select t from ({_each("normalize_data")})), chars as (select * from (values {_REPORT}) c(ch, code))
select ch, code, coalesce(sum(length(t) - length(replace(t, ch, ''))), 0)::bigint as n from chars, texts group by ch, code""",
    "length_stats": f"""with p as (select len(text_list) as k from ({_once("normalize_data")}) where text_list is not null), t as (select length(t) as l from ({_each("normalize_data")}))
select round((select avg(k) from p), 6) as avg_pars_per_article, round((select stddev_pop(k) from p), 6) as std_pars_per_article, round((select avg(l) from t), 6) as avg_chars_per_par, round((select stddev_pop(l) from t), 6) as std_chars_per_par""",
    "length_histogram": f"select length(t)::int as len_text, count(*) as n from ({_each('normalize_data')}) where t is not null group by 1",
    "find_texts": f"select url, string_agg(sec_idx::varchar, ',' order by sec_idx) as idxs from ({_each('normalize_data')}) where contains(t, 'railway') group by url",
    "count_texts": f"select count(*) filter (length(t) > 0) as longer_than_0, count(*) filter (length(t) > 50) as longer_than_50 from ({_each('normalize_data')})",
    "word_frequency": _WORD + "select word, freq from freq",
    "word_first_position": _WORD + "select word, first_pos.page as page, first_pos.sec::bigint as sec, first_pos.sent::bigint as sent, first_pos.pos::bigint as pos from freq",
    "initial_vocab": _WORD + "select distinct substring(word, i, 1) as token from letter union select ' '",
    "initial_pair_counts": _WORD + 'select left_token, right_token, n from pairs',
    "top_pair": _WORD + 'select left_token, right_token, n from pairs order by n desc, first_at limit 1',
    "token_counts": _WALK + ", counted as (select token, freq from token join freq using (word)) select token, sum(freq)::bigint as n from counted group by token",
    "token_ids": _WALK
    + """, ids as (select token, row_number() over (order by token) - 1 as id from vocab),
coded as (select word, string_agg(coalesce(id, -1)::varchar, ' ' order by i) as ids from token left join ids using (token) group by word)
select word, coalesce(ids, '') as ids from freq left join coded using (word)""",
    "tokenize_pages": _WALK
    + f""", per as (select word, count(*) as k from token group by word),
spaces as (select page, sec, sent, count(*) - 1 as gaps, sum(coalesce(k, 0)) as k from word left join per using (word) group by all),
total as (select page, sum(gaps + k)::bigint as n from spaces group by page)
select page_id, coalesce(n, 0) as n_tokens from ({_once("freq_dict")}) left join total on page = page_id where text_list is not null""",
    "ngram_counts": f"select page_id, sec_idx, len(list_distinct(list_transform(range(1, length(t) - 3), lambda i: substring(t, i, 5))))::int as n from ({_each('normalize_data')}) where length(t) >= 5",
    "exact_duplicates": f"select md5(t) as text_key, count(*) as n from ({_each('normalize_data')}) where t is not null group by t having count(*) > 1",
    "segment_sentences": f"select page_id, sec_idx, unnest(range(len(x)))::int as sent_idx, unnest(x) as sentence from (select page_id, sec_idx, string_split({_SENTENCE}, chr(1)) as x from ({_each('normalize_data')}) where t <> '{DUPLICATE_MARK}')",
    "omit_duplicates": f"select page_id, len(list_filter(text_list, lambda t: length(t) >= 200))::int as n_sections from ({_once('normalize_data')}) where text_list is not null",
    "extract_links": _LINKS,
    "frontier_dedup": f"select url, min(seq) as seq from frontier where {_ARTICLE} and url not in (select url from crawl_data where url is not null) group by url",
}

"""The same results in DuckDB SQL over the plain tables.

The SQL is written independently of the operators: windows over exploded lines, a
recursive walk for the merge, a global sort for samples and positions.
"""

from __future__ import annotations

from ..functions import patterns as P
from .shapes import CLASS_NAMES, PROMPT_NAME

NL = "chr(10)"
WS = "'" + P.WHITESPACE + "'"
WORDS = f"'{P.WORD}'"
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _strip(x: str) -> str:
    return f"trim({x}, {WS})"


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def _lines(x: str) -> str:
    """splitlines() for text with plain newlines."""
    return f"(length({x}) - length(replace({x}, {NL}, '')) + case when {x} = '' or ends_with({x}, {NL}) then 0 else 1 end)"


def _markup(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(regexp_replace({x}, '{P.HTML_TAG}', '', 'g'), "
        f"'{P.MARKDOWN_IMAGE}', '', 'g'), '{P.MARKDOWN_LINK}', '\\1', 'g')"
    )


def _dropped(line: str) -> str:
    bare = _strip(line)
    return f"""({bare} <> '' and (
        {_count(line, P.BOX_RUN)} > length({bare}) * 0.3::double
        or regexp_matches({bare}, '{P.SEPARATOR_LINE}')
        or contains(lower({bare}), 'back to top')
        or contains({bare}, 'img.shields.io')
        or (contains(lower({bare}), 'badge') and contains({bare}, 'http'))))"""


def _flags(x: str) -> dict[str, str]:
    bare = _strip(x)
    drop = "'" + P.SEPARATOR_CHARS + P.WHITESPACE + "'"
    return {
        "too_short": f"length({bare}) < 50",
        "box_heavy": f"coalesce({_count(x, P.BOX_RUN)} > 0 and {_count(x, P.BOX_RUN)}::double / nullif(length({bare}), 0) > 0.3::double, false)",
        "table_row": f"starts_with({bare}, '|') and ends_with({bare}, '|') and not contains({bare}, {NL})",
        "separator_only": f"length(translate({bare}, {drop}, '')) < 20",
        "mostly_urls": f"length(array_to_string(regexp_extract_all({bare}, '{P.URL}'), '')) > length({bare}) * 0.6::double",
    }


def _noise(x: str) -> str:
    return "(" + " or ".join(f"({flag})" for flag in _flags(x).values()) + ")"


def _uuid(*parts: str) -> str:
    h = f"md5(concat_ws(chr(1), {', '.join(parts)}))"
    return f"concat_ws('-', substr({h},1,8), substr({h},9,4), substr({h},13,4), substr({h},17,4), substr({h},21,12))"


FILE_TIME = "(timestamp '2025-01-01' + to_minutes(doc_id))"
FILE_NAME = f"(source || '_README_' || strftime({FILE_TIME}, '%Y%m%d_%H%M%S') || '.md')"

MARKDOWN = f"""
md as (select doc_id, source, {FILE_NAME} file_name,
  array_to_string(list_transform(string_split(text, {NL}), lambda l, n: case
    when (n-1) % 12 = 0  then '# '   || substr(l, 1, 40) || ' <a id=x>' || {NL} || l
    when (n-1) % 12 = 3  then '## '  || substr(l, 1, 40) || {NL} || l
    when (n-1) % 12 = 5  then '### ' || substr(l, 1, 40) || {NL} || l
    when (n-1) % 12 in (7, 9) then '```'
    when (n-1) % 12 = 10 then '│ ─ │ ─ │'
    when (n-1) % 12 = 11 then '[docs](http://x.example/a) ' || l
    else l end), {NL}) as text
  from documents)"""


def _numbered(name: str, source: str, text: str) -> str:
    """(doc_id, i, l, fence, code): lines with fence state."""
    return f"""
{name}_raw as (select doc_id, unnest(string_split({text}, {NL})) l,
    generate_subscripts(string_split({text}, {NL}), 1) - 1 i from {source}),
{name} as (select doc_id, i, l, starts_with({_strip('l')}, '```') fence,
    sum(case when starts_with({_strip('l')}, '```') then 1 else 0 end)
      over (partition by doc_id order by i rows unbounded preceding) % 2 = 1 code
  from {name}_raw)"""


CLEAN_LINES = (
    MARKDOWN
    + ","
    + _numbered("ln", "md", _markup("text"))
    + f""",
cl as (select doc_id, i, (fence or code or not {_dropped('l')}) kept,
    case when fence or code then rtrim(l, {WS})
         when {_dropped('l')} then ''
         else regexp_replace({_strip('l')}, '[ \\t]+', ' ', 'g') end line
  from ln)"""
)

CLEAN = (
    CLEAN_LINES
    + f""",
ct as (select doc_id, {_strip(f"regexp_replace(string_agg(line, {NL} order by i), '{chr(92)}n{{3,}}', {NL} || {NL}, 'g')")} text
  from cl where kept group by doc_id),
cleaned as (select md.doc_id, source, file_name, coalesce(ct.text, '') text from md left join ct using (doc_id))"""
)

UNPRINTABLE = "[\\p{Cc}\\p{Cf}\\p{Co}\\p{Zl}\\p{Zp}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}]"

# Lines with the fence that is open after them, header parts of paragraphs, and parts joined.
SECTION_STEPS = (
    f""",
sl as (select doc_id, unnest(string_split(text, {NL})) l, generate_subscripts(string_split(text, {NL}), 1) - 1 i from cleaned),
bare as (select doc_id, i, regexp_replace({_strip('l')}, '{UNPRINTABLE}', '', 'g') l from sl),
fence as (select *, row_number() over (partition by doc_id order by i) c from bare
  where starts_with(l, '```') or starts_with(l, '~~~')),
state(doc_id, c, i, f) as (
  select doc_id, 0::bigint, -1::bigint, '' from cleaned
  union all
  select n.doc_id, n.c, n.i, case
    when s.f <> '' then case when starts_with(n.l, s.f) then '' else s.f end
    when starts_with(n.l, '~~~') then '~~~'
    when {_count('n.l', '```')} = 1 then '```' else '' end
  from state s join fence n on n.doc_id = s.doc_id and n.c = s.c + 1),
lv as (select b.doc_id, b.i, b.l, s.f <> '' code,
    case when s.f <> '' then 0 else length(regexp_extract(b.l, '^(#{{1,3}})(?: |$)', 1)) end lvl
  from bare b asof join state s on b.doc_id = s.doc_id and b.i >= s.i),
grp as (select *, case when lvl > 0 then {_strip('substr(l, lvl + 1)')} end title,
    sum(case when lvl > 0 then 1 else 0 end) over w g,
    sum(case when lvl = 1 then 1 else 0 end) over w g1,
    sum(case when lvl in (1, 2) then 1 else 0 end) over w g2,
    sum(case when l = '' and not code then 1 else 0 end) over w par
  from lv window w as (partition by doc_id order by i rows unbounded preceding)),
named as (select *,
    max(case when lvl = 1 then title end) over (partition by doc_id, g1) h1,
    max(case when lvl = 2 then title end) over (partition by doc_id, g2) h2,
    max(case when lvl = 3 then title end) over (partition by doc_id, g) h3
  from grp),
para as (select doc_id, g, par, any_value(h1) h1, any_value(h2) h2, any_value(h3) h3,
    string_agg(l, {NL} order by i) t, last(l order by i) last_line
  from named where l <> '' or code group by doc_id, g, par),
part as (select doc_id, g, any_value(h1) h1, any_value(h2) h2, any_value(h3) h3,
    string_agg(t, '  ' || {NL} order by par) t, last(last_line order by par) last_line
  from para group by doc_id, g),
near as (select *, lag(g) over w is not null and (
      lag(h1) over w is not distinct from h1 and lag(h2) over w is not distinct from h2 and lag(h3) over w is not distinct from h3
      or starts_with(lag(last_line) over w, '#')
        and (lag(h1) over w is not null)::int + (lag(h2) over w is not null)::int + (lag(h3) over w is not null)::int
          < (h1 is not null)::int + (h2 is not null)::int + (h3 is not null)::int) joins
  from part window w as (partition by doc_id order by g)),
runs as (select *, (sum(case when joins then 0 else 1 end) over (partition by doc_id order by g) - 1)::int section_id from near),
sections as (select doc_id, section_id, last(coalesce(h1, '') order by g) h1, last(coalesce(h2, '') order by g) h2,
    last(coalesce(h3, '') order by g) h3, string_agg(t, '  ' || {NL} order by g) as text
  from runs group by doc_id, section_id)"""
)

SECTIONS = CLEAN + SECTION_STEPS

ROUGH_MARKDOWN = f"""
cleaned as (select doc_id, array_to_string(list_transform(string_split(text, {NL}), lambda l, n: case (n - 1 + doc_id) % 16
    when 0 then '# ' || substr(l, 1, 30) when 1 then '## ' || substr(l, 1, 20) when 3 then '#' when 4 then '~~~ text'
    when 5 then '# in code' when 6 then '```' when 7 then '  ~~~' when 8 then '' when 9 then '### ' || substr(l, 1, 10)
    when 10 then '````' when 11 then '' when 12 then '## in code' when 13 then '```' when 14 then '``` in line ```'
    when 15 then '#### deep' else l end), {NL}) as text
  from documents)"""


def _merged(source: str) -> str:
    """`merged` from source(doc_id, idx, h1, h2, h3, text): the small-chunk walk."""
    return f"""
fold(doc_id, idx, first_idx, len, h1, h2) as (
  select doc_id, idx, idx, length(text), h1, h2 from {source} where idx = 0
  union all
  select s.doc_id, s.idx,
    case when {{joins}} then f.first_idx else s.idx end,
    case when {{joins}} then f.len + 2 + length(s.text) else length(s.text) end, s.h1, s.h2
  from fold f join {source} s on s.doc_id = f.doc_id and s.idx = f.idx + 1),
merged as (select doc_id, first_idx, any_value(s.h1) filter (s.idx = first_idx) h1,
    any_value(s.h2) filter (s.idx = first_idx) h2, any_value(s.h3) filter (s.idx = first_idx) h3,
    string_agg(s.text, {NL} || {NL} order by s.idx) text
  from {source} s join fold using (doc_id, idx) group by doc_id, first_idx)""".replace(
        "{joins}", "s.h1 = f.h1 and s.h2 = f.h2 and f.len < 200 and f.len + length(s.text) < 800"
    )


WINDOW_PIECES = f"""
pc as (select doc_id, section_id, h1, h2, h3, text, unnest(generate_series(0, greatest(length(text) - 101, 0), 700)) p from quiet),
cut as (select doc_id, section_id, p, h1, h2, h3,
    case when length(text) > 800 then substr(text, p + 1, 800) else text end piece from pc)"""

CUT = "chr(64976)"


def _level(name: str, source: str, keys: str, order: str, separator: str) -> str:
    """Parts of each text of `source`, cut before each separator, and how many long ones stand before."""
    parts = f"string_split(replace({{text}}, {separator}, {CUT} || {separator}), {CUT})"
    parts = f"list_filter({parts}, lambda part: part <> '')"
    return f"""
{name}_all as (select {keys}, unnest({parts.replace("{text}", "text")}) text,
    generate_subscripts({parts.replace("{text}", "text")}, 1) {order} from {source}),
{name} as (select *, length(text) >= 800 too_long,
    sum((length(text) >= 800)::int) over (partition by {keys} order by {order}) run from {name}_all)"""


# Separators from coarse to fine give parts; runs of short neighbours are walked piece by piece, by
# their running lengths s (s[1] = 0): a piece begins with part a and ends before part b.
RECURSIVE_PIECES = (
    "over as (select doc_id, section_id, text from quiet where length(text) > 800),"
    + _level("p1", "over", "doc_id, section_id", "o1", f"{NL} || {NL}")
    + ","
    + _level("p2", "(select * from p1 where too_long)", "doc_id, section_id, o1", "o2", NL)
    + ","
    + _level("p3", "(select * from p2 where too_long)", "doc_id, section_id, o1, o2", "o3", "' '")
    + f""",
atom as (
  select doc_id, section_id, 1 lvl, o1, 0 o2, 0 o3, run, text from p1 where not too_long
  union all select doc_id, section_id, 2, o1, o2, 0, run, text from p2 where not too_long
  union all select doc_id, section_id, 3, o1, o2, o3, run, text from p3 where not too_long),
sums as (select *, (sum(length(text)) over w)::bigint upto from atom
  window w as (partition by doc_id, section_id, lvl, case when lvl > 1 then o1 end, case when lvl > 2 then o2 end, run
               order by o1, o2, o3)),
run as (select row_number() over () run_id, doc_id, section_id, min((o1, o2, o3)) place,
    list(text order by o1, o2, o3) parts, list_concat([0::bigint], list(upto order by o1, o2, o3)) s
  from sums group by doc_id, section_id, lvl, case when lvl > 1 then o1 end, case when lvl > 2 then o2 end, run),
walk(run_id, a, b) as (
  select run_id, 0::bigint, len(list_filter(s, lambda x: x <= 800)) - 1 from run
  union all
  select run_id, a, len(list_filter(s, lambda x: x - s[a + 1] <= 800)) - 1
  from (select run_id, s, greatest(a, len(s) - len(list_filter(s,
            lambda x: s[b + 1] - x <= least(100, 800 - (s[b + 2] - s[b + 1]))))) a
        from walk join run using (run_id) where b < len(parts))),
piece as (
  select doc_id, section_id, place, a p, {_strip("array_to_string(parts[a + 1:b], '')")} piece from walk join run using (run_id)
  union all
  select doc_id, section_id, (o1, o2, o3), p, {_strip("substr(text, p + 1, 800)")}
  from (select *, unnest(generate_series(0, greatest(length(text) - 101, 0), 700)) p from p3 where too_long)),
cut as (
  select doc_id, section_id, row_number() over (partition by doc_id, section_id order by place, p) p, h1, h2, h3, piece
  from piece join quiet using (doc_id, section_id) where piece <> ''
  union all
  select doc_id, section_id, 0, h1, h2, h3, text from quiet where length(text) <= 800)"""
)


def _chunks(cut: str) -> str:
    """`chunks` of the markdown documents, by a way to cut long sections."""
    return (
        SECTIONS
        + f""",
quiet as (select * from sections where not {_noise('text')}),"""
        + cut
        + f""",
pieces as (select doc_id, section_id, p, {_strip(f"regexp_replace(h1, '{P.HTML_TAG}', '', 'g')")} h1, h2, h3, piece from cut),
small as (select doc_id, row_number() over (partition by doc_id order by section_id, p) - 1 idx, h1, h2, h3,
    case when h1 <> '' then '# ' || h1 || {NL} else '' end || case when h2 <> '' then '## ' || h2 || {NL} else '' end ||
    case when h3 <> '' then '### ' || h3 || {NL} else '' end || piece as text
  from pieces where not {_noise('piece')}),"""
        + _merged("small")
        + f""",
kept as (select *, row_number() over (partition by doc_id order by first_idx) - 1 chunk_index
  from merged where not {_noise('text')}),
chunks as (select k.text, md.source source_repo, md.file_name source_file, k.chunk_index::int chunk_index,
    {_uuid('k.doc_id')} doc_id, {_uuid('k.doc_id', 'k.chunk_index', 'k.text')} chunk_id,
    k.h1 section_h1, k.h2 section_h2, k.h3 section_h3
  from kept k join md using (doc_id))"""
    )


CHUNKS = _chunks(WINDOW_PIECES)


def _vectors(source: str, key: str, text: str, dim: int = 384, name: str = "") -> str:
    """`{name}dense`(key, bucket, w): hashed word counts scaled to length 1, as float."""
    return f"""
{name}tk as (select {key}, ('0x' || substr(md5(tok), 1, 8))::bigint % {dim} bucket
  from (select {key}, unnest(regexp_extract_all({text}, {WORDS})) tok from {source})),
{name}tc as (select {key}, bucket, count(*) n from {name}tk group by all),
{name}dense as (select {key}, bucket, (n / sqrt(sum(n * n) over (partition by {key})::double))::float w from {name}tc)"""


def _checksum(dense: str, key: str) -> str:
    return f"(select {key}, string_agg(bucket || ':' || round(w::double * 1000000)::bigint, ',' order by bucket) vector from {dense} group by {key})"


def _hash_order(key: str) -> str:
    return f"md5('42:' || {key}), {key}"


def _split(table: str, key: str, names: tuple[str, str] = ("train", "val")) -> str:
    return f"""(select *, case when row_number() over (order by {_hash_order(key)}) <= floor(count(*) over () * 0.8::double)
      then '{names[0]}' else '{names[1]}' end split from {table})"""


def _split_in_order(table: str, key: str) -> str:
    return f"""(select *, case when row_number() over (order by {key}) <= floor(count(*) over () * 0.8::double)
      then 'train' else 'test' end split from {table})"""


IMAGE = "format('image_{:06d}.jpg', doc_id)"

SUPPLIER_FILES = """
sup as (select s_suppkey k, s_name, s_nationkey, v from supplier, (values (1), (2)) versions(v)
  where case when v = 2 then s_suppkey % 10 <> 0 else s_suppkey % 10 <> 1 end),
files as (select v, case when k % 4 = 0 then 'n' || s_nationkey else '' end folder,
    's' || k || case when k % 10 = 3 then '.txt' else '.md' end file,
    case when k % 10 = 5 then 'the same' || chr(10)
      else s_name || case when k % 10 = 2 and v = 2 then ' (changed)' else '' end || chr(10) || 'é of nation ' || s_nationkey
    end as text from sup),
named as (select *, case when folder = '' then file else folder || '/' || file end logical_path from files)"""

ORDER_VERSIONS = """
cents as (select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 100)::bigint p from orders),
v1 as (select o_orderkey logical_path, md5(concat_ws('|', o_custkey, o_orderstatus, p)) md5, p price_cents
  from cents where o_orderkey % 10 <> 0),
v2r as (select *, p + case when o_orderkey % 10 = 2 then 100 else 0 end q from cents where o_orderkey % 10 <> 1),
v2 as (select o_orderkey logical_path, md5(concat_ws('|', o_custkey, o_orderstatus, q)) md5, q price_cents from v2r)"""

DIFF = """
diff as (select coalesce(v1.logical_path, v2.logical_path) logical_path,
  case when v1.md5 is null then 'added' when v2.md5 is null then 'removed'
       when v1.md5 <> v2.md5 then 'changed' else 'same' end status
  from v1 full join v2 on v1.logical_path = v2.logical_path)"""

PROMPT_TEXT = f"'Describe the image.' || {NL} || 'Name what stands out.'"


def _topk(vec: str, k: int) -> str:
    return f"""select a.vec_id query_id, b.vec_id neighbour_id,
    round(list_cosine_similarity({vec.format('a')}, {vec.format('b')}), 6) score,
    row_number() over (partition by a.vec_id order by round(list_cosine_similarity({vec.format('a')}, {vec.format('b')}), 6) desc, b.vec_id) rank
  from embeddings a join embeddings b on a.vec_id <> b.vec_id qualify rank <= {k}"""


FULL_VECTOR = "{}.embedding::double[]"
HALF_VECTOR = "{}.embedding[1:32]::double[]"


def oracle_sql() -> dict[str, str]:
    lens = f"""select split, length(text) char_length, {_count('text', P.WORD)} word_count from {_split('documents', 'doc_id')}"""
    sql = {
        "text_stats_by_split": f"""
with s as (unpivot ({lens}) on char_length, word_count into name metric value v)
select split, metric, count(*) n, round(avg(v), 6) mean, round(stddev_samp(v), 6) std, min(v) min, max(v) max,
  round(median(v), 6) median from s group by all""",
        "union_tagged_sources": """
select c_name name, c_nationkey nationkey, c_acctbal acctbal, 0 source_type from customer
union all select s_name, s_nationkey, s_acctbal, 1 from supplier""",
        "feature_stats": f"""
with s as (unpivot (select {', '.join(FEATURES)} from lineitem) on {', '.join(FEATURES)} into name feature value v)
select feature, count(*) n, round(avg(v), 7) mean, round(stddev_samp(v), 7) std, round(min(v), 7) min,
  round(max(v), 7) max, round(median(v), 7) median from s group by feature""",
        "target_stats": """
select 'l_linenumber' target, count(*) n, round(avg(l_linenumber), 6) mean, round(stddev_samp(l_linenumber), 6) std,
  min(l_linenumber)::bigint min, max(l_linenumber)::bigint max, round(median(l_linenumber), 6) median from lineitem""",
        "schema_profile": """
select c.place, c.name, c.dtype, case c.name when 'p_size' then a.s0 when 'p_retailprice' then a.r0 end range_min,
  case c.name when 'p_size' then a.s1 when 'p_retailprice' then a.r1 end range_max, a.n num_samples, 6 num_columns
from (values (0,'p_partkey','bigint'),(1,'p_name','string'),(2,'p_brand','string'),(3,'p_type','string'),
  (4,'p_size','int'),(5,'p_retailprice','double')) c(place, name, dtype),
  (select min(p_size)::double s0, max(p_size)::double s1, min(p_retailprice) r0, max(p_retailprice) r1, count(*) n from part) a""",
        "standardize_features": f"""
with s as (select {', '.join(f'avg({f}) m_{f}, stddev_samp({f}) s_{f}' for f in FEATURES)} from lineitem)
select l_orderkey, l_linenumber, l_partkey, {', '.join(f'round(({f} - m_{f}) / s_{f}, 4) + 0.0 {f}' for f in FEATURES)} from lineitem, s""",
        "value_counts_by_key": "select lang, count(*) n from documents group by lang order by lang",
        "value_counts_by_freq": "select source, count(*) n from documents group by source order by n desc, source",
        "label_decode_counts": f"""
select ({list(CLASS_NAMES)!r})[label + 1] class_name, count(*) n from embeddings group by label""",
        "dense_histogram": f"""
select class_id::int class_id, ({list(CLASS_NAMES)!r})[class_id + 1] class_name, count(label) n
from range(12) r(class_id) left join embeddings on label = class_id group by class_id""",
        "normalize_schema": "select text, lang as label from documents",
        "corpus_stats": f"""
select count(*) total_files, sum(strlen(text))::bigint total_size_bytes, round(sum(strlen(text)) / count(*), 2) average_size_bytes,
  sum(length(text))::bigint total_characters, round(sum(length(text)) / count(*), 2) average_characters,
  sum({_lines('text')})::bigint total_lines, round(sum({_lines('text')}) / count(*), 2) average_lines from documents""",
        "distinct_sources": "select count(distinct source) total_repositories, string_agg(distinct source, ',' order by source) repository_names from documents",
        "distinct_labels_union": "select string_agg(distinct lang, ',' order by lang) classes from documents",
        "metadata_json": f"""
with d as (select *, {_count('text', P.WORD)} words from {_split('documents', 'doc_id')}),
lc as (select split, string_agg(lang || '=' || n, ',' order by lang) label_distribution
  from (select split, lang, count(*) n from d group by all) group by split)
select split, count(*) num_samples, any_value(label_distribution) label_distribution,
  max(length(text)) char_length_max, min(words) word_count_min, round(avg(length(text)), 6) char_length_mean
from d join lc using (split) group by split""",
        "table_metadata": """
with t as (select c_nationkey k, c_acctbal b, 0 s from customer union all select s_nationkey, s_acctbal, 1 from supplier)
select count(*) num_samples, 2 num_features, count(*) filter (s = 0) customers, count(*) filter (s = 1) suppliers,
  nullif(count(*) filter (k = 7), 0) nation_7, min(k) target_min, max(k) target_max, round(median(b), 6) median from t""",
        "tensor_metadata": f"""
with e as (select * from {_split('embeddings', 'vec_id')}),
p as (select split, (floor(unnest(embedding)::double * 127) + 128) / 255.0::double v from e),
s as (select split, avg(v) m, stddev_pop(v) d, median(v) q from p group by split)
select split, 8 as "rows", count(*) num_samples, count(*) filter (label = 3) three, 0 eleven, round(any_value(m), 8) mean,
  round(any_value(d), 8) std, round(any_value(q), 8) median from e join s using (split) group by split""",
        "caption_metadata": f"""
with p as (select * from {_split_in_order('documents', 'doc_id')} join labels using (doc_id)),
r as (select *, row_number() over (partition by split order by doc_id) rn from p)
select split, 3 prompt_version, count(*) num_samples, round(avg({_count('text', P.WORD)}), 2) caption_length_mean,
  max({_count('text', P.WORD)}) caption_length_max, round(avg(case when rn <= 100 then 256 + doc_id % 512 end), 2) image_width_mean
from r group by split""",
        "corpus_metadata": f"""
with {MARKDOWN}
select 'documents-v1.0.0' source_data_version, 800 chunk_size, count(*) total_files, count(distinct source) total_repositories,
  sum(strlen(text))::bigint total_size_bytes, round(sum({_lines('text')}) / count(*), 2) average_lines from md""",
        "array_scale_stats": f"""
with s as (select split, unnest(embedding)::double / 255 v from {_split('embeddings', 'vec_id')})
select split, count(*) n, round(avg(v), 10) mean, round(stddev_pop(v), 10) std, round(min(v), 10) min,
  round(max(v), 10) max, round(median(v), 10) median from s group by split""",
        "tensor_shape_profile": """
select count(*) num_samples, min(len(embedding))::int min_size, max(len(embedding))::int max_size,
  min(len(embedding)) = max(len(embedding)) uniform from embeddings""",
        "tensor_from_bytes": """
select vec_id, array_to_string(list_transform(embedding, lambda x: floor(x::double * 127)::int + 128), ',') pixels,
  8 as "rows", label from embeddings""",
        "scan_parquet": "select * from part",
        "scan_csv_roundtrip": "select * from documents",
        "scan_json_roundtrip": f"""
select split, {IMAGE} image, '<image>' || {NL} || {PROMPT_TEXT} question, text answer from {_split_in_order('documents', 'doc_id')}""",
        "split_write_readback": f"""
select split, count(*) n, sum(doc_id)::bigint ids, sum(length(text))::bigint chars from {_split('documents', 'doc_id')} group by split""",
        "scan_text_wholefile": f"""
select source, sum(length(text) + 1)::bigint chars, sum(strlen(text) + 1)::bigint bytes,
  sum({_lines(f"(text || {NL})")})::bigint as lines from documents group by source""",
        "scan_permissive_rejects": """
select event_id % 3 = 0 rejected, count(*) n, sum(case when event_id % 3 <> 0 then event_id end)::bigint ids from events group by 1""",
        "eval_questions_scan": """
select text question, 'item ' || item_id expected_answer, array_to_string(string_split(text, ' ')[1:3], ' ') key_concepts from benchmark""",
        "sample_exact_floor": f"""
select doc_id, lang from documents order by {_hash_order('doc_id')} limit (select floor(count(*) * 0.6::double)::bigint from documents)""",
        "sample_exact_round": f"""
select * from labels order by {_hash_order('doc_id')} limit (select round_even(count(*) * 0.5::double, 0)::bigint from labels)""",
        "sample_tensor_rows": f"""
select vec_id, label, round(list_sum(embedding::double[]), 6) total from embeddings order by {_hash_order('vec_id')}
limit (select floor(count(*) * 0.6::double)::bigint from embeddings)""",
        "split_shuffled": f"select doc_id, split from {_split('documents', 'doc_id')}",
        "split_by_position": f"select doc_id, path, split from {_split_in_order(f'(select doc_id, {chr(39)}raw/{chr(39)} || {FILE_NAME} path from documents)', 'path')}",
        "global_row_index": f"""
with d as (select doc_id, 'raw/' || {FILE_NAME} path from documents),
p as (select *, row_number() over (order by path) - 1 position from d)
select doc_id, path, position, format('image_{{:06d}}.jpg', position) image from p""",
        "first_n": f"select doc_id, 'raw/' || {FILE_NAME} path from documents order by path limit 500",
        "split_counts": f"""
select count(*) filter (split = 'train') train_samples, count(*) filter (split = 'test') test_samples,
  0.8::double train_split, 2 num_features from {_split_in_order('documents', 'doc_id')}""",
        "strip_markup": f"select page_id, {_markup('html')} text from pages",
        "code_fence_state": f"with {MARKDOWN}, {_numbered('ln', 'md', 'text')} select doc_id, i::int line_no, code in_code, fence is_fence from ln",
        "clean_lines": f"with {CLEAN_LINES} select doc_id, i::int line_no, kept, line from cl",
        "clean_text": f"with {CLEAN} select doc_id, text from cleaned",
        "noise_flags": f"""
with {MARKDOWN}, {_numbered('ln', 'md', 'text')}
select doc_id, i::int line_no, {', '.join(f'{flag} {name}' for name, flag in _flags('l').items())}, {_noise('l')} is_noise from ln""",
        "markdown_sections": f"with recursive {SECTIONS} select doc_id, section_id, h1, h2, h3, text from sections",
        "header_splitter": f"""
with recursive {ROUGH_MARKDOWN} {SECTION_STEPS} select doc_id, section_id, h1, h2, h3, text from sections""",
        "split_by_size": """
with p as (select doc_id, text, unnest(generate_series(0, greatest(length(text) - 101, 0), 700)) p from documents)
select doc_id, (p // 700)::int piece_no, case when length(text) > 800 then substr(text, p + 1, 800) else text end piece from p""",
        "chunk_reindex": f"""
with recursive {SECTIONS} select doc_id, section_id, (row_number() over (partition by doc_id order by section_id) - 1)::int chunk_index
from sections where not {_noise('text')}""",
        "merge_small_chunks": f"""
with recursive {SECTIONS},
s0 as (select *, row_number() over (partition by doc_id order by section_id) - 1 idx from sections), {_merged('s0')}
select doc_id, (row_number() over (partition by doc_id order by first_idx) - 1)::int chunk_index, h1, text from merged""",
        "chunk_documents": f"with recursive {CHUNKS} select * from chunks",
        "chunk_documents_recursive": f"with recursive {_chunks(RECURSIVE_PIECES)} select * from chunks",
        "chat_format": f"""
select {IMAGE} image, split, 'human' from_0, '<image>' || {NL} || {PROMPT_TEXT} value_0, 'gpt' from_1, text value_1,
  'prompts:/{PROMPT_NAME}/3' prompt_uri, 3 prompt_version from {_split_in_order('documents', 'doc_id')}""",
        "caption_stats": f"""
select split, count(*) num_samples, round(avg({_count('text', P.WORD)}), 2) caption_length_mean,
  min({_count('text', P.WORD)}) caption_length_min, max({_count('text', P.WORD)}) caption_length_max
from {_split_in_order('documents', 'doc_id')} group by split""",
        "caption_image_join": f"""
with p as (select *, row_number() over (order by doc_id) - 1 position from {_split_in_order('documents', 'doc_id')})
select {IMAGE} image, split, format('{{}}_radiology_{{:06d}}.jpg', split, position) new_image,
  md5(concat_ws('|', doc_id, quality, toxic)) content_md5 from p join labels using (doc_id)""",
        "existing_image_semi": f"""
select {IMAGE} image, doc_id in (select doc_id from labels) "exists" from documents""",
        "image_files": f"""
with a as (select s_suppkey k, split from {_split_in_order('supplier', 's_suppkey')})
select split, count(*) filter (k % 9 <> 0) num_images, round(avg(16 + k % 112) filter (k % 9 <> 0), 2) width_mean,
  round(avg(16 + k * 7 % 112) filter (k % 9 <> 0), 2) height_mean, (max(16 + k % 112) filter (k % 9 <> 0))::int width_max,
  count(*) filter (k % 9 = 0) num_unread
from a where k % 5 <> 0 group by split""",
        "entity_files": f"""
with {SUPPLIER_FILES}
select file, folder, text, strlen(text)::int bytes, {_lines('text')}::int lines from named where v = 1 and ends_with(file, '.md')""",
        "file_manifest": f"""
with {SUPPLIER_FILES}
select 'files' dataset, 'v' || v as version, logical_path, strlen(text)::bigint length, md5(text) md5 from named""",
        "read_files_at": f"""
with {SUPPLIER_FILES}, c as (select count(distinct text) n from named)
select 'v' || v as version, logical_path, text, n stored, n contents from named, c where ends_with(file, '.md')""",
        "batched_sink": f"select {_uuid('doc_id')} id, source, md5(text) content_md5, 1 times from documents",
        "lineage_upstream": """
with recursive edge as (
  select 'orders' dataset, 'v' || o_orderkey as version, 'customer' source_dataset, 'v' || o_custkey source_data_version from orders
  union all select 'customer', 'v' || c_custkey, 'nation', 'v' || c_nationkey from customer
  union all select 'nation', 'v' || n_nationkey, 'region', 'v' || n_regionkey from nation),
up as (
  select *, 1 depth from edge
  union
  select up.dataset, up.version, e.source_dataset, e.source_data_version, depth + 1
  from up join edge e on e.dataset = up.source_dataset and e.version = up.source_data_version)
select dataset, source_dataset, source_data_version, depth::int depth, count(*) built from up group by all""",
        "image_dims_avg": f"""
with p as (select *, row_number() over (partition by split order by doc_id) rn from {_split_in_order('documents', 'doc_id')}),
s as (select doc_id, 256 + doc_id % 512 w, 256 + (doc_id * 7) % 512 h from labels)
select split, count(w) num_images, coalesce(round(avg(w), 2), 0) image_width_mean, coalesce(round(avg(h), 2), 0) image_height_mean
from p left join s using (doc_id) where rn <= 100 group by split""",
        "embed_hashing": f"""
with {_vectors('documents', 'doc_id', 'text')}
select doc_id, 384 dim, coalesce(vector, '') vector from documents left join {_checksum('dense', 'doc_id')} using (doc_id)""",
        "vector_table_write": f"""
with recursive {CHUNKS}, {_vectors('chunks', 'chunk_id', 'text')}
select chunk_id id, text as content, source_repo, chunk_index, section_h2, 'documents-v1.0.0' data_version, vector, true has_created_at
from chunks join {_checksum('dense', 'chunk_id')} using (chunk_id)""",
        "vector_topk_cosine": _topk(FULL_VECTOR, 5),
        "question_search": f"""
with {_vectors('documents', 'doc_id', 'text')}, {_vectors('benchmark', 'item_id', 'text', name='q')},
dn as (select doc_id, sqrt(sum(w::double * w::double)) l from dense group by doc_id),
qn as (select item_id, sqrt(sum(w::double * w::double)) l from qdense group by item_id),
dots as (select item_id, doc_id, sum(q.w::double * d.w::double) dot from qdense q join dense d using (bucket) group by all)
select item_id query_id, doc_id neighbour_id, round(dot / (qn.l * dn.l), 6) score,
  row_number() over (partition by item_id order by round(dot / (qn.l * dn.l), 6) desc, doc_id) rank
from dots join dn using (doc_id) join qn using (item_id) qualify rank <= 5""",
        "retrieval_recall_by_version": f"""
with f as ({_topk(FULL_VECTOR, 10)}), h as ({_topk(HALF_VECTOR, 10)}),
r as (select 'v1-32' as version, query_id, neighbour_id from h union all select 'v2-64', query_id, neighbour_id from f)
select version, count(*) retrieved, count(f.rank) relevant, round(count(f.rank) / count(*), 6) recall
from r left join f using (query_id, neighbour_id) group by version""",
        "snapshot_manifest": f"""
with {ORDER_VERSIONS}
select 'orders' dataset, 'v1' as version, logical_path, md5 from v1 union all select 'orders', 'v2', logical_path, md5 from v2""",
        "snapshot_diff": f"with {ORDER_VERSIONS}, {DIFF} select * from diff",
        "snapshot_changed": f"""
with {ORDER_VERSIONS}, {DIFF}
select count(*) filter (status = 'added') added, count(*) filter (status = 'removed') removed,
  count(*) filter (status = 'changed') changed, count(*) filter (status = 'same') same, bool_or(status <> 'same') is_changed from diff""",
        "manifest_asof_version": f"with {ORDER_VERSIONS} select logical_path, 'v1' as version, md5, price_cents from v1",
        "dataset_fingerprint": f"""
with {ORDER_VERSIONS}, b as (select 'v1' as version, * from v1 union all select 'v2', * from v2)
select version, count(*) num_rows, sum(('0x' || substr(md5(concat_ws('|', logical_path, md5)), 1, 15))::hugeint)::varchar hash_sum
from b group by version""",
        "lineage_filter": f"""
select {_uuid(_uuid('doc_id'), "'documents-v1.1.0'")} id, source source_repo, 'documents-v1.1.0' data_version,
  'hashing-16' embedding_model, md5(text) content_md5, 'documents-v1.1.0' source_data_version from documents""",
        "decode_payload": "select doc_id, text from documents where text <> ''",
        "readme_file_name": f"select doc_id, {FILE_NAME} file_name from documents",
        "repo_name_from_path": f"""
select doc_id, {FILE_NAME} file_name, source repo, source || strftime({FILE_TIME}, '_%Y%m%d_%H%M%S') repo_with_time from documents""",
        "latest_per_source": f"""
select source, doc_id, 'raw/' || {FILE_NAME} path, text from documents
qualify row_number() over (partition by source order by {FILE_TIME} desc, doc_id desc) = 1""",
        "incremental_ingest": f"""
with recursive {CHUNKS} select chunk_id id, source_file, chunk_index, section_h1, text from chunks
where doc_id not in (select {_uuid('doc_id')} from documents where doc_id % 10 = 9)""",
    }
    return sql

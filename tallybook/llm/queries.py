"""The operators as named queries over the given tables, and their DuckDB counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    ann,
    bwt,
    lang,
    licenses,
    mixing,
    negatives,
    packing,
    quality,
    rlz,
    tgm,
    tokens,
    trie,
    urls,
)
from tallybook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


# Host and path rules of the contract.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# Sites whose pages make up the list of blocked URLs.
JUNK_SITES = r"^(www\.|m\.|blog\.)?(adult-x|casino-win|cheap-pills|free-bets|spam-farm)\."


@query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = urls.host_and_path(F.col("url"))
    listed = pages.filter(host.rlike(JUNK_SITES)).select("url")
    return urls.judge_urls(pages, URL_RULES, listed)


ORACLES["op6_url_filters"] = r"""
with split as (
  select page_id,
         case when url like '%://%' then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), parts as (
  select page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from split
), named as (
  select *, case when host = '' then '' else
         regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)+$', '') end as canonical
  from parts
), listed as (
  select distinct canonical from named
  where canonical <> '' and regexp_matches(host, '^(www\.|m\.|blog\.)?(adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.')
), rules(h, p, v) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitted as (
  select n.*, (select arg_max(r.h || r.p || ' ' || r.v, length(r.h || r.p)) from rules r
               where (n.host = r.h or ends_with(n.host, '.' || r.h)) and starts_with(n.path, r.p)) as best
  from named n
)
select page_id, host, path, split_part(best, ' ', 1) as rule,
       coalesce(split_part(best, ' ', 2), case when canonical in (select canonical from listed) then 'block' else 'allow' end) as verdict
from fitted
"""


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_histogram(tokens.encoded_lengths(table(spark, sf_dir, "documents")))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), starts as (
  select doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by h) as n from starts) where n > 1
), gone as (
  select distinct doc_id, i + k as i from twice, (select unnest(range(0, 35)) as k)
), each as (
  select doc_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as word from w
), kept as (
  select e.doc_id, count(*) as n, string_agg(e.word, ' ' order by e.i) as t
  from each e anti join gone g on e.doc_id = g.doc_id and e.i = g.i group by e.doc_id
)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(k.n, 0))::bigint as n_removed,
       sha256(coalesce(k.t, '')) as kept_sha256
from w left join kept k on w.doc_id = k.doc_id
"""


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt.drop_shared(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op8_suffix_dedup"] = r"""
with t as (
  select doc_id, hex(encode(coalesce(text, ''))) as x from documents
), starts as (
  select doc_id, i, md5(x[2 * i + 1 : 2 * i + 100]) as h
  from (select doc_id, x, unnest(range(0, len(x) // 2 - 49)) as i from t)
), later as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as least from starts)
  where least < doc_id
), runs as (
  select doc_id, min(i) as a, max(i) + 50 as b from (
    select doc_id, i, sum(case when i <= before + 50 then 0 else 1 end) over (partition by doc_id order by i) as run
    from (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from later)
  ) group by doc_id, run
), gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from runs
  union all select doc_id, max(b), null from runs group by doc_id
), kept as (
  select g.doc_id, string_agg(case when g.b is null then t.x[2 * g.a + 1 :] when g.b > g.a
         then t.x[2 * g.a + 1 : 2 * g.b] else '' end, '' order by g.a) as x
  from gaps g join t on t.doc_id = g.doc_id group by g.doc_id
), counts as (
  select doc_id, sum(b - a) as gone, count(*) as n from runs group by doc_id
)
select t.doc_id, (len(t.x) // 2)::bigint as n_bytes, coalesce(c.gone, 0)::bigint as n_removed,
       coalesce(c.n, 0)::bigint as n_spans, sha256(unhex(coalesce(k.x, t.x))) as kept_sha256
from t left join counts c on c.doc_id = t.doc_id left join kept k on k.doc_id = t.doc_id
"""


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tgm.jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op5_jaccard_join"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, g from (
    select doc_id, md5(array_to_string(ws[i : i + 2], ' ')) as g
    from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)
    union all
    select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and 2
  )
), sizes as (
  select doc_id, count(*) as n from s group by doc_id
), links as (
  select p.a, p.b from (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by all
  ) p join sizes x on x.doc_id = p.a join sizes y on y.doc_id = p.b
  where 100 * common >= 90 * (x.n + y.n - common)
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on l.a = r.b
)
select r.a as doc_id, coalesce(any_value(z.n), 0)::bigint as n_shingles, min(r.b) as component_id
from reach r left join sizes z on z.doc_id = r.a group by r.a
"""


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality.judge(docs, quality.fit(docs, trusted))


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lang.predict(docs, lang.fit(docs))
    return found.withColumn("held_out", lang.held_out(F.col("doc_id")))


@query
def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def _wording(markup: str) -> str:
    """A template as a regular expression over words that each follow a space."""

    def part(found: re.Match) -> str:
        mark, plain = found[1], found[2]
        if mark is None:
            return "".join(f" {w}" for w in re.findall("[0-9a-z]+", plain.lower()))
        if mark == "beginOptional":
            return "(?:"
        if mark == "endOptional":
            return ")?"
        least_most = re.search(r"words=(\d+)\.\.(\d+)", mark)
        if least_most:
            return f"(?: [^ ]+){{{least_most[1]},{least_most[2]}}}"
        ways = re.search('match="(.*)"', mark, re.S)[1].split("|")
        return "(?:" + "|".join("".join(f" {w}" for w in re.findall("[0-9a-z]+", x.lower())) for x in ways) + ")"

    return re.sub(r"<<(.*?)>>|((?:(?!<<).)+)", part, markup, flags=re.S)


def _license_sql() -> str:
    rules = [(label, _wording(p), True) for p, label in licenses.PHRASES.items()]
    rules += [(label, _wording(t), False) for label, several in licenses.TEMPLATES.items() for t in several]
    least = {}
    for markup in [*licenses.PHRASES, *(t for several in licenses.TEMPLATES.values() for t in several)]:
        least[_wording(markup)] = licenses.fewest_words(licenses.parse(markup))
    values = ",\n".join(f"('{label}', '{rule}( |$)', {str(base).lower()}, {least[rule]})" for label, rule, base in rules)
    any_phrase = "|".join(rule for _, rule, base in rules if base)
    phrases = " union all ".join(
        f"select doc_id, i - 1 as i, '{label}' as label from places where ws[i : i + {len(p.split()) - 1}] = {p.split()}"
        for p, label in licenses.PHRASES.items()
    )
    return rf"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), rules(label, rule, base, m) as (
  values {values}
), told as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels, max(m / (m + 1)) as score
  from w, rules where regexp_matches(' ' || array_to_string(ws, ' '), rule) group by doc_id
), places as (
  select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w
  where regexp_matches(' ' || array_to_string(ws, ' '), '{any_phrase}')
), found as (
  {phrases}
), base as (
  select doc_id, count(*) as n, min(i) as a, max(i) as b, string_agg(distinct label, ',' order by label) as labels
  from found group by doc_id
)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_base, a::bigint as first_word, b::bigint as last_word,
       coalesce(base.labels, '') as base_labels, coalesce(told.labels, '') as labels, coalesce(score, 0)::double as score
from w left join base using (doc_id) left join told using (doc_id)
"""


ORACLES["op11_license_scans"] = _license_sql()


@query
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), borrow_heads=True)


ORACLES["op12_conversation_prefix_trie"] = r"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) - 1 as place,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), crc as (
  select conv_id, conv_id - conv_id % 20 as base, (xor(list_reduce(
           [4294967295::ubigint] || list_transform(range(1, len(conv_id::varchar) + 1), lambda i: ord(substr(conv_id::varchar, i, 1))::ubigint),
           lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda k: k::ubigint),
                                 lambda x, k: xor(x >> 1, (x & 1) * 3988292384::ubigint))), 4294967295::ubigint) % 4)::int as h
  from (select distinct conv_id from turns)
), built as (
  select c.conv_id, t.place, t.role, t.text from crc c join turns t on t.conv_id = c.base and t.place < h
  union all
  select c.conv_id, t.place + 10, t.role, t.text from crc c join turns t on t.conv_id = c.conv_id and t.place >= h
), whole as (
  select c.conv_id, coalesce(list(md5(role || chr(31) || text) order by place) filter (place is not null), []) as path,
         coalesce(list(len(regexp_extract_all(text, '[^ 	-
]+')) order by place) filter (place is not null), []) as words
  from crc c left join built b on b.conv_id = c.conv_id group by c.conv_id
), member as (
  select conv_id, d, array_to_string(path[1:d], '') as node, words[d] as n_words, len(path) = d as ends
  from (select conv_id, path, words, unnest(range(0, len(path) + 1)) as d from whole)
), node as (
  select node, d, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(n_words), 0) as n_words,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from member group by node, d
), kids as (
  select c.node[1 : 32 * (c.d - 1)] as node, count(*) as n from node c where d > 0 group by 1
), tree as (
  select a, sum((n_convs - 1) * n_words) as saved, count(*) filter (leaf) as leaves from (
    select unnest(list_transform(range(0, x.d + 1), lambda k: x.node[1 : 32 * k])) as a, x.n_convs, x.n_words, k.n is null as leaf
    from node x left join kids k on k.node = x.node
  ) group by a
)
select x.conv_id, x.d::bigint as depth, p.conv_id as parent_conv_id, x.n_convs::bigint as n_convs,
       coalesce(k.n, 0)::bigint as n_children, t.leaves::bigint as n_leaves, t.saved::bigint as saved_tokens, x.ends_sha256
from node x join tree t on t.a = x.node left join kids k on k.node = x.node
left join node p on x.d > 0 and p.node = x.node[1 : 32 * (x.d - 1)]
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score
  from rows a join rows b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, (row_number() over w)::int as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 3
"""

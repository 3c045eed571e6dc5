"""The registered queries of the training-data operators and their SQL.

Each query applies its operator, with production parameters, to its whole table and derives
digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    aliases,
    bpe,
    centroids,
    chat,
    decontaminate,
    hpylm,
    language,
    licenses,
    negatives,
    rules,
    simhash,
    substring,
    tokens,
)
from .common import Scratch, crc_mod, read


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on driver and executors."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _hex(column: str) -> F.Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_tokens(spark: SparkSession, data_dir: str) -> DataFrame:
    path = Scratch(spark, "tokens").path("files")
    tokens.write_tokens(read(spark, data_dir, "documents"), path,
                        tokenizer_file("word_bpe_49k.json"), end_id=1)
    rows = tokens.checksums(tokens.read_tokens(spark, path))
    return rows.join(tokens.starts(spark, path), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op2_decontaminate(spark: SparkSession, data_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, data_dir, "documents"), read(spark, data_dir, "benchmark"))


def op3_simhash(spark: SparkSession, data_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, data_dir, "documents"), width=3, max_distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_substring(spark: SparkSession, data_dir: str) -> DataFrame:
    cut = substring.remove_repeats(read(spark, data_dir, "documents"), min_words=35)
    return cut.select("doc_id", "n_words", "n_removed", _hex("kept").alias("kept_sha256"))


def op5_chat(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = read(spark, data_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = Scratch(spark, "chat").table("formatted", chat.format_conversations(rows.unionByName(own)))
    whole = chat.formatted(F.col("segments"))
    turns = F.array_join(F.transform(chat.parse(whole), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("segments"))
    return out.select(
        "conv_id", "n_turns", F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length(whole).cast("long").alias("formatted_chars"))


def op6_hpylm(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = read(spark, data_dir, "documents")
    return hpylm.score(docs, held_out=crc_mod(F.col("doc_id"), 7) == 2)


def op7_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    judged = rules.judge(read(spark, data_dir, "documents"), read(spark, data_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def op8_language(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = read(spark, data_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    counts = language.learn(docs.where(~held_out))
    return language.predict(docs, counts, keep={"held_out": held_out}).select(
        "doc_id", "held_out", "lang_pred", "score", "languages")


def encoded_digests(coded: DataFrame) -> DataFrame:
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        _hex("decoded").alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, data_dir: str) -> DataFrame:
    return encoded_digests(bpe.encode(read(spark, data_dir, "documents"), tokenizer_file("byte_bpe_50k.json")))


def op10_licenses(spark: SparkSession, data_dir: str) -> DataFrame:
    return licenses.scan(read(spark, data_dir, "documents"))


# Host, path, verdict of the URL rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op11_aliases(spark: SparkSession, data_dir: str) -> DataFrame:
    told = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return aliases.decide(read(spark, data_dir, "pages"), told)


def op12_negatives(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = read(spark, data_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.mine(rows, anchors=F.col("vec_id") % 100 == 0)


def op13_centroids(spark: SparkSession, data_dir: str) -> DataFrame:
    return centroids.with_totals(*centroids.cluster(read(spark, data_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tokens": op1_tokens,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash": op3_simhash,
    "op4_substring": op4_substring,
    "op5_chat": op5_chat,
    "op6_hpylm": op6_hpylm,
    "op7_rules": op7_rules,
    "op8_language": op8_language,
    "op9_bpe": op9_bpe,
    "op10_licenses": op10_licenses,
    "op11_aliases": op11_aliases,
    "op12_negatives": op12_negatives,
    "op13_centroids": op13_centroids,
}

def _centroid_rounds(rounds: int, k: int = 16) -> str:
    """The rounds of the clustering as one CTE after another, over ``q(rid, vec_id, v)`` and ``c0(c, v)``."""
    near = """
a{r} as (select rid, c, d from (select q.rid, c.c, d, row_number() over (partition by q.rid order by d, c.c) as nth
  from q, c{r} c, lateral (select list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d) x)
  where nth = 1)"""
    move = """,
s{r} as (select c, i, sum(x)::hugeint as s, count(*)::hugeint as n
  from (select a.c, generate_subscripts(q.v, 1) as i, unnest(q.v) as x from a{r} a join q on q.rid = a.rid) group by c, i),
c{n} as (select c{r}.c, coalesce(m.v, c{r}.v) as v from c{r} left join (
  select c, list((((s - ((s % n) + n) % n)) // n)::bigint order by i) as v from s{r} group by c) m on m.c = c{r}.c),"""
    return "".join(near.format(r=r) + (move.format(r=r, n=r + 1) if r < rounds else "") for r in range(rounds + 1))


ORACLE: dict[str, str] = {
    "op13_centroids": """
with q as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as (select row_number() over (order by h, v) - 1 as c, v
       from (select sha256('1:' || vec_id) as h, v from q where vec_id is not null order by h, v limit 16)),"""
    + _centroid_rounds(3) + """,
t as (select c, sum(d)::bigint as cluster_inertia from a3 group by c)
select q.vec_id, a3.c::int as cluster, a3.d as distance, t.cluster_inertia,
  (select sum(d)::bigint from a3) as inertia, sha256(array_to_string(c3.v, ',')) as centroid_sha256
from a3 join q using (rid) join t on t.c = a3.c join c3 on c3.c = a3.c
""",
    "op12_negatives": """
with r as (
  select row_number() over () as rid, vec_id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select a.rid, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
p as (
  select rid, anchor_id, vec_id, score, row_number() over (partition by rid order by score desc, vec_id) as place
  from s where same),
n as (
  select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score,
    s.score as negative_score, row_number() over (partition by p.rid, p.place order by s.score desc, s.vec_id) as rank
  from p join s on s.rid = p.rid and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
  where p.place <= 5)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 10
""",
    "op11_aliases": r"""
with recursive u as (
  select row_number() over () as rid, page_id, url, html, instr(url, '://') as cut from pages),
x as (
  select rid, page_id, html, coalesce(case when cut > 0 then substr(url, cut + 3) end, '') as rest from u),
y as (
  select rid, page_id, html, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as tail from x),
pg as (select *, case when host <> '' then host || tail end as address from y),
tag as (
  select rid, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?(?:-->|$)', '', 'g'), '(?i)<(?:link|meta)\s[^<>]*')) as t
  from pg where address is not null),
att as (
  select rid, lower(t[2:5]) as kind, list_transform(['rel', 'href', 'http-equiv', 'content'], lambda k: replace(
    regexp_extract(t, '(?is)\s' || k || '\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1)
    || regexp_extract(t, '(?is)\s' || k || '\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2)
    || regexp_extract(t, '(?is)\s' || k || '\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3), '&amp;', '&')) as a
  from tag),
named as (
  select rid, trim(case when kind = 'link' and list_contains(string_split_regex(lower(a[1]), '\s+'), 'canonical') then a[2]
    when kind = 'meta' and lower(a[3]) = 'refresh'
      then regexp_extract(a[4], '(?is)^[^;,]*[;,]\s*url\s*=\s*["'']?([^"'']*)', 1) end) as n from att),
full_url as (
  select pg.address as a, case when regexp_matches(n, '^[A-Za-z][A-Za-z0-9+.-]*://') then substr(n, instr(n, '://') + 3)
    when starts_with(n, '//') then substr(n, 3)
    when regexp_matches(n, '^[A-Za-z][A-Za-z0-9+.-]*:') or starts_with(n, '#') then null
    when starts_with(n, '/') then host || n
    when starts_with(n, '?') then host || path || n
    else host || case when path = '' then '/' else regexp_extract(path, '(?s)^(.*/)', 1) end || n end as r
  from named join pg using (rid) where n <> ''),
edge as (
  select distinct a, b from (
    select a, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || regexp_extract(r, '^[^/?#]*([^#]*)', 1) as b
    from full_url where regexp_extract(r, '^[^/?#]*') <> '') where a <> b),
rules(rhost, rpath, verdict) as (values """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + """),
step as (select a, b from edge union select b, a from edge),
walk as (select a as address, a as other from step union select walk.address, step.b from walk join step on step.a = walk.other),
place as (
  select address, host, path from pg where address is not null
  union select b, regexp_extract(b, '^[^/?#]*'), regexp_extract(b, '^[^/?#]*([^?#]*)', 1) from edge),
fit as (
  select host, path, arg_min(rhost || rpath, o) as rule, arg_min(verdict, o) as own
  from (select p.host, p.path, rhost, rpath, verdict, (-length(rhost || rpath), verdict, rhost || rpath) as o
        from (select distinct host, path from place) p join rules
          on (p.host = rhost or ends_with(p.host, '.' || rhost)) and starts_with(p.path, rpath))
  group by host, path),
told as (
  select walk.address, min(fit.own) as alias from walk join place on place.address = walk.other
    join fit on fit.host = place.host and fit.path = place.path group by walk.address)
select page_id, pg.host, pg.path, fit.rule, coalesce(fit.own, told.alias, 'allow') as verdict,
  case when fit.own is not null then 'rule' when told.alias is not null then 'alias' else 'default' end as reason
from pg left join fit on fit.host = pg.host and fit.path = pg.path left join told on told.address = pg.address
""",
    "op5_chat": """
with own(conv_id, turn, role) as (values (-7, 0, 'user'), (-7, 1, 'assistant')),
t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select conv_id, turn, role, '\\### Assistant: </turn> ok' from own),
w as (
  select *, case when contains(text, '\\') or contains(text, '</turn>') or contains(text, '### ')
    then replace(replace(replace(text, '\\', '\\\\'), '</turn>', '<\\/turn>'), '### ', '#\\## ')
    else text end as body from t)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length('### ' || role || ': ' || body || '</turn>' || chr(10)))::bigint as formatted_chars
from w group by conv_id
""",
    "op4_substring": """
with w as (
  select doc_id, string_split_regex(trim(coalesce(text, ''), e' \\t\\n\\x0b\\x0c\\r'), '[\\x20\\x09-\\x0D]+') ws
  from documents),
word as (
  select doc_id, unnest(range(1, len(ws) + 1)) i, unnest(ws) t
  from w where ws <> ['']),
win as (
  select doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) k
  from (select doc_id, ws, unnest(range(1, len(ws) - 33)) s from w)),
twice as (select k from win group by k having count(*) > 1),
gone as (
  select distinct doc_id, unnest(range(s, s + 35)) i from win where k in (select k from twice)),
kept as (
  select word.doc_id, count(*) n, count(gone.i) r,
         string_agg(case when gone.i is null then t end, ' ' order by word.i) x
  from word left join gone on gone.doc_id = word.doc_id and gone.i = word.i group by word.doc_id)
select doc_id, coalesce(n, 0)::bigint as n_words, coalesce(r, 0)::bigint as n_removed,
       sha256(coalesce(x, '')) as kept_sha256
from documents left join kept using (doc_id)
""",
}

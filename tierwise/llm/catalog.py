"""Registered queries of this subpackage, each over whole tables, with their SQL where it can say them."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.lineage import shared_dir
from tierwise.llm import (
    chat,
    decontamination,
    fingerprints,
    hard_negatives,
    language_id,
    masked_lm,
    mixing,
    near_dedup,
    prefix_trie,
    secret_scan,
    substrings,
    url_filters,
    warc,
)
from tierwise.llm.frames import table

EPOCH = 1_704_067_200  # 2024-01-01 UTC
DAY = 86_400


def op1_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def source_weight(source: str | None) -> int:
    """Target weights of the query: 1 to 9, fixed by the name."""
    return 1 + int(hashlib.md5((source or "").encode()).hexdigest()[:4], 16) % 9


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    weights = {r[0]: source_weight(r[0]) for r in docs.select("source").distinct().collect()}
    return mixing.mix_sources(docs, weights)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = masked_lm.word_counts(docs)
    return masked_lm.score_words(docs, masked_lm.fit(docs, counts=counts), counts)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _digits(digest: Column, first: int, n: int) -> Column:
    return F.conv(F.substring(digest, first, n), 16, 10).cast("long")


def url_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time in 2024, fixed by the page number."""
    minute = _digits(F.md5(F.col("page_id").cast("string")), 1, 6) % 525_600
    return pages.select("page_id", "url", F.timestamp_seconds(EPOCH + 60 * minute).alias("fetched_at"))


def url_list(pages: DataFrame) -> DataFrame:
    """A dated list over hosts of the pages: a quarter is listed, some removed and listed again."""
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    z = F.md5("host")
    hosts = hosts.where(_digits(z, 1, 2) % 4 == 0)
    is_domain = (_digits(z, 3, 2) % 2 == 1) & (F.size(F.split("host", r"\.")) >= 3)
    first = _digits(z, 5, 4) % 300
    gone = F.when(_digits(z, 11, 2) % 2 == 0, first + 20 + _digits(z, 13, 2) % 60)
    again = F.when(_digits(z, 15, 2) % 2 == 0, gone + 90)
    event = lambda action, day: F.struct(F.lit(action).alias("action"), day.alias("day"))
    events = hosts.select(
        F.when(is_domain, F.regexp_replace("host", r"^[^.]+\.", "")).otherwise(F.col("host")).alias("pattern"),
        F.when(is_domain, url_filters.DOMAIN).otherwise(url_filters.HOST).alias("kind"),
        F.element_at(F.array(*map(F.lit, ("ads", "adult", "malware", "spam"))), (_digits(z, 9, 2) % 4 + 1).cast("int")).alias("category"),
        F.inline(F.array(event("add", first), event("remove", gone), event("add", again))),
    )
    return events.where("day is not null").select(
        "pattern", "kind", "category", "action", F.timestamp_seconds(EPOCH + DAY * F.col("day")).alias("dated")
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filters.filter_urls(url_captures(pages), url_list(pages))
    return found.select("page_id", "host", "n_active", "categories", "blocked")


OP6_SQL = r"""
with p as (
  select page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') as host,
    60 * (('0x' || substr(md5(page_id::varchar), 1, 6))::bigint % 525600) as ts
  from pages),
h as (select distinct host, md5(host) as z from p where host is not null),
l as (
  select host, (('0x' || substr(z, 3, 2))::bigint % 2 = 1) and len(string_split(host, '.')) >= 3 as is_domain,
    ['ads', 'adult', 'malware', 'spam'][('0x' || substr(z, 9, 2))::bigint % 4 + 1] as category,
    ('0x' || substr(z, 5, 4))::bigint % 300 as d1,
    case when ('0x' || substr(z, 11, 2))::bigint % 2 = 0 then d1 + 20 + ('0x' || substr(z, 13, 2))::bigint % 60 end as d2,
    case when ('0x' || substr(z, 15, 2))::bigint % 2 = 0 then d2 + 90 end as d3
  from h where ('0x' || substr(z, 1, 2))::bigint % 4 = 0),
e as (
  select distinct case when is_domain then regexp_replace(host, '^[^.]+\.', '') else host end as pattern,
    case when is_domain then 'domain' else 'host' end as kind, category, x.action, 86400 * x.day as dated
  from (select *, unnest([{'action': 'add', 'day': d1}, {'action': 'remove', 'day': d2}, {'action': 'add', 'day': d3}]) as x from l)
  where x.day is not null),
v as (
  select *, lead(dated) over (partition by pattern, kind, category order by dated, action) as until from e),
m as (
  select p.host, p.ts, v.category from (select distinct host, ts from p) p join v
    on (v.kind = 'host' and p.host = v.pattern) or (v.kind = 'domain' and (p.host = v.pattern or suffix(p.host, '.' || v.pattern)))
  where v.action = 'add' and v.dated <= p.ts and (v.until is null or p.ts < v.until)),
a as (select host, ts, count(*) as n, string_agg(distinct category, ',' order by category) as categories from m group by host, ts)
select p.page_id, p.host, coalesce(a.n, 0) as n_active, coalesce(a.categories, '') as categories, coalesce(a.n, 0) > 0 as blocked
from p left join a on p.host = a.host and p.ts = a.ts
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))


def branches(turns: DataFrame) -> DataFrame:
    """Pairs from conversations: each is chosen over itself with its last reply taken from the next
    conversation (conv_id + 1; empty if there is none) and cut there.  Without a reply both are equal."""
    last = (
        turns.where("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("_l"))
        .select("conv_id", F.col("_l.turn").alias("_turn"), F.col("_l.text").alias("_text"))
    )
    other = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("_text").alias("_other"))
    reply = last.join(other, "conv_id", "left")
    chosen = turns.select(F.col("conv_id").alias("pair_id"), F.lit(chat.CHOSEN).alias("side"), "turn", "role", "text")
    before = (
        turns.join(last.select("conv_id", "_turn"), "conv_id", "left")
        .where("_turn is null or turn < _turn")
        .select(F.col("conv_id").alias("pair_id"), F.lit(chat.REJECTED).alias("side"), "turn", "role", "text")
    )
    swapped = reply.select(
        F.col("conv_id").alias("pair_id"),
        F.lit(chat.REJECTED).alias("side"),
        F.col("_turn").alias("turn"),
        F.lit("assistant").alias("role"),
        F.coalesce("_other", F.lit("")).alias("text"),
    )
    return chosen.unionByName(before).unionByName(swapped)


def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.preference_pairs(branches(table(spark, sf_dir, "conversations")))
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return found.withColumns({c: written(c) for c in ("chosen_spans", "rejected_spans")})


OP8_SQL = r"""
with l as (
  select conv_id, max({'turn': turn, 'text': coalesce(text, '')}) as l from conversations where role = 'assistant' group by conv_id),
t as (
  select conv_id, 'c' as side, turn, role, text from conversations
  union all
  select c.conv_id, 'r', c.turn, c.role, c.text from conversations c left join l using (conv_id) where l.l is null or c.turn < l.l.turn
  union all
  select l.conv_id, 'r', l.l.turn, 'assistant', coalesce(n.l.text, '') from l left join l n on n.conv_id = l.conv_id + 1),
x as (
  select conv_id, side, turn, replace(coalesce(role, ''), '<|', '<\|') as role, replace(coalesce(text, ''), '<|', '<\|') as text from t),
p as (
  select conv_id as pair_id,
    coalesce(list({'role': role, 'text': text} order by turn, role, text) filter (where side = 'c'), []) as a,
    coalesce(list({'role': role, 'text': text} order by turn, role, text) filter (where side = 'r'), []) as b
  from x group by conv_id),
n as (
  select *, coalesce(list_min(list_filter(list_transform(range(1, greatest(len(a), len(b)) + 1),
    lambda i: case when coalesce(a[i] = b[i], false) then null else i end), lambda i: i is not null)) - 1, len(a)) as n from p),
r as (
  select *, list_transform(a[1:n], lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as pt,
    a[n + 1:] as ca, b[n + 1:] as cb,
    list_transform(ca, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as ra,
    list_transform(cb, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as rb
  from n)
select pair_id, n as n_prompt_turns, array_to_string(pt, '') as prompt, array_to_string(ra, '') as chosen,
  array_to_string(rb, '') as rejected,
  coalesce(array_to_string(list_filter(list_transform(range(1, len(ca) + 1), lambda i: case when ca[i].role = 'assistant' then
    (coalesce(list_sum(list_transform(ra[1:i - 1], lambda s: length(s))), 0) + 13 + length(ca[i].role))::bigint::varchar || '-' ||
    (list_sum(list_transform(ra[1:i], lambda s: length(s))))::bigint::varchar end), lambda s: s is not null), ','), '') as chosen_spans,
  coalesce(array_to_string(list_filter(list_transform(range(1, len(cb) + 1), lambda i: case when cb[i].role = 'assistant' then
    (coalesce(list_sum(list_transform(rb[1:i - 1], lambda s: length(s))), 0) + 13 + length(cb[i].role))::bigint::varchar || '-' ||
    (list_sum(list_transform(rb[1:i], lambda s: length(s))))::bigint::varchar end), lambda s: s is not null), ','), '') as rejected_spans
from r
"""


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    rows = docs.select("doc_id", "text", language_id.held_out(F.col("doc_id")).alias("held_out"))
    return language_id.predict(rows, model, keep=["doc_id", "held_out"])


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).drop("target_uri")


def quantised_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` in whole numbers, of rows with a label and finite components;
    every seventh label is moved on by one."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    known = embeddings.where("label is not null and embedding is not null").where(F.forall("embedding", finite))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0))
    return known.select("vec_id", moved.alias("label"), whole.alias("vector"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised_vectors(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = r"""
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as rank,
  s.other_id as negative_id, p.positive_score, s.score as negative_score
from p join s on p.anchor_id = s.anchor_id and not s.same and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
qualify rank <= 5
"""

def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(turns))


#: Bitwise crc32 of the decimal id, as DuckDB has none.
OP12_SQL = r"""
with recursive t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
o as (
  select conv_id, list({'d': substr(sha256(length(role)::varchar || ':' || role || text), 1, 32), 'n': length(text)}
    order by turn nulls first, substr(sha256(length(role)::varchar || ':' || role || text), 1, 32)) as s
  from t group by conv_id),
k as (
  select conv_id, encode(conv_id::varchar) as b, 0 as i, 0 as bit, 4294967295::bigint as crc from o
  union all
  select conv_id, b, case when bit = 7 then i + 1 else i end, (bit + 1) % 8,
    case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end
  from (
    select *, case when bit = 0 then xor(crc, ascii(substr(conv_id::varchar, i + 1, 1))::bigint) else crc end as x
    from k where i < octet_length(b))),
h as (select conv_id, xor(crc, 4294967295) % 6 as h from k where i = octet_length(b)),
c as (
  select o.conv_id, coalesce(p.s[1:h.h], []) || o.s[h.h + 1:] as s
  from o join h using (conv_id) left join o p on p.conv_id = o.conv_id - o.conv_id % 100),
m as (
  select conv_id, len(s) as size, d, list_transform(s[1:d], lambda x: x.d) as p, case when d > 0 then s[d].n else 0 end as n
  from (select conv_id, s, unnest(range(0, len(s) + 1)) as d from c)),
v as (
  select p, d, any_value(n) as n, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = d), '')) as ends_sha256
  from m group by p, d),
ch as (select p[1:d - 1] as p, d - 1 as d, count(*) as n_children from v where d > 0 group by all),
w as (select v.*, coalesce(ch.n_children, 0) as n_children from v left join ch on v.p = ch.p and v.d = ch.d),
u as (
  select p[1:a] as p, a as d, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum((n_convs - 1) * n) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from w) group by all)
select w.conv_id, w.d as depth, q.conv_id as parent_conv_id, w.n_convs, w.n_children, u.n_leaves::bigint as n_leaves,
  u.saved_tokens::bigint as saved_tokens, w.ends_sha256
from w join u on w.p = u.p and w.d = u.d left join w q on q.p = w.p[1:w.d - 1] and q.d = w.d - 1
"""

def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = secret_scan.scan(docs, secret_scan.fit(docs))
    base = F.filter("findings", lambda s: s["kind"] != secret_scan.KINDS[-1])
    kinds = F.transform("findings", lambda s: s["kind"])
    counted = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.KINDS[:-1]
    ]
    return found.select(
        "doc_id",
        *counted,
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("findings")).alias("spans"),
    )


OP2_SQL = r"""
with recursive d as (
  select doc_id, source, row_number() over (partition by source order by md5(concat_ws('|', doc_id, '0')), doc_id) - 1 as block
  from documents),
w as (select source, count(*) as n, 1 + ('0x' || substr(md5(coalesce(source, '')), 1, 4))::bigint % 9 as w from documents group by source),
q as (
  select source, n, w // (select list_reduce(list(w), lambda a, b: gcd(a, b)) from w) as q,
    row_number() over (order by source nulls first) as i from w),
c as (select unnest(range(0, (select max((n + q - 1) // q) from q))) as c),
b as (
  select c.c, list(greatest(0, least(q.q, q.n - c.c * q.q)) order by q.i) as blocks,
    sum(greatest(0, least(q.q, q.n - c.c * q.q)))::bigint as len
  from c, q group by c.c),
e as (
  select c, 0::bigint as t, list_transform(blocks, lambda x: 0::bigint) as taken, null::bigint as f, null::bigint as k from b
  union all
  select c, t + 1, list_transform(taken, lambda x, j: x + case when j = pick then 1 else 0 end), pick, taken[pick]
  from (
    select e.c, e.t, e.taken, b.len, list_min(list_filter(list_transform(range(1, len(b.blocks) + 1), lambda j:
      case when e.taken[j] < b.blocks[j] and (e.taken[j] * b.len) // b.blocks[j] <= e.t
      then {'due': ((e.taken[j] + 1) * b.len + b.blocks[j] - 1) // b.blocks[j], 'j': j} end), lambda x: x is not null)).j as pick
    from e join b on e.c = b.c where e.t < b.len)),
o as (select c, coalesce(sum(len) over (order by c rows between unbounded preceding and 1 preceding), 0)::bigint as o from b)
select d.doc_id, d.source, d.block, o.o + e.t - 1 as slot, o.o + e.t - 1 as position
from d join q on d.source is not distinct from q.source
join e on e.c = d.block // q.q and e.f = q.i and e.k = d.block % q.q
join o on o.c = e.c
"""

OP5_SQL = r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') as w from documents),
x as (select doc_id, w, unnest(range(1, len(w) - 11)) as p from w),
s as (select doc_id, p, array_to_string(w[p:p + 12], ' ') as s from x),
f as (select s, min(doc_id) as first from s group by s),
g as (select distinct doc_id, p + k as p from s join f using (s), range(0, 13) r(k) where first < doc_id),
a as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from w),
k as (
  select a.doc_id, count(g.p) as n_removed, string_agg(a.word, ' ' order by a.p) filter (where g.p is null) as kept
  from a left join g on a.doc_id = g.doc_id and a.p = g.p group by a.doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(k.n_removed, 0) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from w left join k on w.doc_id = k.doc_id
"""

OP7_SQL = r"""
with d as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents),
ds as (select doc_id, len(w) as n, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) as s from d where len(w) >= 5),
i as (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark),
s as (select item_id, len(w) as n, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) as s from i where len(w) >= 5),
iu as (select item_id, unnest(s) as g from s),
ic as (select item_id, g, count(*) as c from iu group by item_id, g),
du as (select doc_id, n, unnest(s) as g, unnest(range(0, len(s))) as p from ds),
st as (
  select distinct du.doc_id, ic.item_id, least(du.p, greatest(du.n - s.n, 0)) as start
  from du join ic using (g) join s using (item_id)),
wu as (
  select st.doc_id, st.item_id, st.start, len(s.s) as m, len(ds.s[st.start + 1:st.start + s.n - 4]) as k,
    unnest(ds.s[st.start + 1:st.start + s.n - 4]) as g
  from st join ds using (doc_id) join s using (item_id)),
wc as (select doc_id, item_id, start, m, k, g, count(*) as c from wu group by all),
sim as (
  select wc.doc_id, wc.item_id, wc.start, sum(least(wc.c, ic.c)) / (any_value(wc.m) + any_value(wc.k) - sum(least(wc.c, ic.c))) as similarity
  from wc join ic on wc.item_id = ic.item_id and wc.g = ic.g group by wc.doc_id, wc.item_id, wc.start)
select doc_id, item_id, start, n as n_words, similarity
from sim join (select item_id, n from s) using (item_id) where similarity >= 0.8
qualify row_number() over (partition by doc_id, item_id order by similarity desc, start) = 1
"""

OP10_SQL = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
r as (
  select page_id, octet_length(encode(html)) as payload_bytes, sha1(html) as h, max(page_id) over (partition by html) as holder from p)
select page_id, payload_bytes::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 4), lambda i: translate(
    lpad(to_base(('0x' || substr(h, (10 * i + 1)::integer, 10))::bigint, 32), 8, '0'),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') as payload_digest,
  case when page_id = holder then 'response' else 'revisit' end as record_type,
  case when page_id <> holder then holder end as refers_to
from r
"""

QUERIES = {
    "op1_edit_fingerprints": (op1_edit_fingerprints, None),
    "op2_mix_sources": (op2_mix_sources, OP2_SQL),
    "op3_near_duplicates": (op3_near_duplicates, None),
    "op4_masked_lm": (op4_masked_lm, None),
    "op5_substring_dedup": (op5_substring_dedup, OP5_SQL),
    "op6_url_filters": (op6_url_filters, OP6_SQL),
    "op7_decontamination": (op7_decontamination, OP7_SQL),
    "op8_preference_pairs": (op8_preference_pairs, OP8_SQL),
    "op9_language_id": (op9_language_id, None),
    "op10_warc_archive": (op10_warc_archive, OP10_SQL),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_secret_scan": (op13_secret_scan, None),
}

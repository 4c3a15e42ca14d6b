"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from servicelens.llm.mixing import MixParams
from servicelens.llm.sharding import ShardParams, lookup_table, shard_names


def mixing_sql(p: MixParams) -> str:
    """The exponent in closed form (repetition target), budgets and permutations as in the contract of ``mixed``."""

    def h(*parts: str) -> str:
        return "('0x' || substr(md5(" + " || '/' || ".join(parts) + "), 1, 13))::BIGINT"

    seed = f"'{p.seed}'"
    return f"""
with d as (
  select doc_id, source, coalesce('s' || source, '-') as skey, doc_id::varchar as dkey,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens
  from documents),
t as (select skey, count(*) as n_docs, sum(tokens)::bigint as tokens from d group by skey),
e as (select case when min(tokens) = max(tokens) then 0.0
                  else greatest(0.0, 1 - ln({p.max_repetition}) / ln(max(tokens)::double / min(tokens))) end as a from t where tokens > 0),
m as (select max(tokens / pow(tokens::double, a)) as most from t, e where tokens > 0),
b as (select skey, tokens, greatest(1, least({p.blocks}, ceil(n_docs / {p.block_docs}::double)))::bigint as n_blocks,
             floor(most * pow(tokens::double, a) + 0.5)::bigint as budget from t, e, m),
k as (select skey, n_blocks, budget // tokens as full_, budget % tokens as rest from b),
x as (select d.*, n_blocks, full_, rest, {h(seed, 'dkey')} % n_blocks as block, {h(seed, 'full_::varchar', 'dkey')} as h from d join k using (skey)),
g as (select skey, block, full_, rest, sum(tokens)::bigint as tokens from x where rest > 0 group by all),
r as (select *, sum(tokens) over (partition by skey order by {h(seed, "'block'", 'full_::varchar', 'block::varchar', 'skey')}, block rows unbounded preceding) as upto from g),
i as (select x.skey, x.block, x.dkey, x.tokens, r.rest - r.upto + r.tokens as left_,
             sum(x.tokens) over (partition by x.skey, x.block order by x.h rows unbounded preceding) as upto2
      from x join r using (skey, block) where r.upto > r.rest and r.upto - r.tokens < r.rest),
p as (select x.skey, x.dkey from x join r using (skey, block) where r.upto <= r.rest
      union all select skey, dkey from i where upto2 - tokens < left_),
o as (select x.doc_id, x.source, x.skey, x.dkey, x.block, unnest(range(full_ + case when p.dkey is null then 0 else 1 end)) as epoch
      from x left join p on p.skey = x.skey and p.dkey = x.dkey)
select doc_id, source, epoch::int as epoch,
       printf('%013X', {h(seed, "'block'", 'epoch::varchar', 'block::varchar', 'skey')}) || '/' || printf('%013X', {h(seed, 'epoch::varchar', 'dkey')}) as position
from o
"""


CHAT_SQL = """
with t as (select distinct conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') as role, coalesce(text, '') as text from conversations),
p as (select distinct conv_id, role as perspective from t where role <> 'system'),
s as (select conv_id, perspective, turn // 512 as part, turn, role, text,
        case when role = perspective then '<|im_start|>assistant' when role = 'system' then '<|im_start|>system'
             else '<|im_start|>user name=' || role end || chr(10) as head,
        replace(text, '<|', '< |') || '<|im_end|>' as body
      from t join p using (conv_id)),
o as (select *, coalesce(sum(length(head) + length(body) + 1) over (partition by conv_id, perspective, part order by turn, role, text
        rows between unbounded preceding and 1 preceding), 0)::bigint + length(head) as start_ from s)
select conv_id, perspective, part, count(*) as n_turns, sum(length(head) + length(body) + 1)::bigint as n_chars,
       md5(string_agg(head || body || chr(10), '' order by turn, role, text)) as text_md5,
       coalesce(string_agg(start_ || '-' || (start_ + length(body)), ',' order by turn, role, text) filter (where role = perspective), '') as spans
from o group by conv_id, perspective, part
"""


def sharding_sql(p: ShardParams) -> str:
    owners = ",".join(map(str, lookup_table(shard_names(p.shards), p.slots)))
    return f"""
with d as (select doc_id, ('0x' || substr(md5(doc_id::varchar), 1, 13))::bigint % {p.slots} as slot from documents)
select doc_id, ([{owners}])[slot + 1]::int as shard from d
"""


TOP_K_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
           where embedding is not null and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint as score
      from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""


DIVERGENCE_SQL = r"""
with d as (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as total from w group by all having count(distinct doc) >= 3),
v as (select lang, count(*) as v, sum(total) as ln from kept group by lang),
c as (select lang, source, term, count(*) as n from w join kept using (lang, term) group by all),
g as (select lang, source, coalesce(max(s.gn), 0)::hugeint as gn from (select distinct lang, source from d)
      left join (select lang, source, sum(n) as gn from c group by all) s using (lang, source) group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.gn + v.v))::hugeint as p,
        (1 + (1000000000::hugeint * (k.total + 1)) // (v.ln + v.v))::hugeint as q
      from g join kept k using (lang) join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pv as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
       from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pr as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pv.value, 0)::bigint as value
       from g a join g b on a.lang = b.lang and a.source <> b.source
       left join pv on pv.lang = a.lang and pv.source = a.source and pv.item = b.source),
tr as (select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // q)::bigint as value from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (from pr union all from tr))
select lang, source, part, item, value, rank::int as rank from r where part = 'pair' or rank <= 200
"""


COLLOCATION_SQL = r"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
s as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from d)),
i as (select lang, w, unnest(range(1, len(w) + 1)) as i from s),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (select *, unnest([1, 2, 3, 4]) as k from i) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, count(*) as f from g group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, k, phrase, string_split(phrase, ' ') as w, f as a from f where k >= 2 and f >= 30),
o as (select lang, k, w, a, unnest([[2, 1], [2, 2], [2, 3], [3, 1], [3, 2]]) as x from c where k > 2),
m as (select lang, array_to_string(w[x[2]:x[2] + x[1] - 1], ' ') as phrase, max(a) as longer from o where x[1] < k and x[2] + x[1] - 1 <= k group by all),
u as (select c.*, unnest(range(1, c.k)) as cut from c left join m using (lang, phrase) where m.longer is null or 100::hugeint * m.longer < 80::hugeint * c.a),
h as (select u.lang, u.phrase, u.a, u.cut, l.f as l, r.f as r, ((2000000::hugeint * u.a) // (l.f + r.f))::bigint as score
      from u join f l on l.lang = u.lang and l.phrase = array_to_string(u.w[1:u.cut], ' ')
             join f r on r.lang = u.lang and r.phrase = array_to_string(u.w[u.cut + 1:u.k], ' ')),
b as (select * from h qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
k as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b)
select lang, rank, phrase, a, l, r, n, score from k join n using (lang) where rank <= 2000
"""

"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from dayledger.llm.url_filter import Settings


def _url_filter() -> str:
    settings = Settings()
    ranks = []
    for kind, seed, src, dst in (("t", "allowed", "src", "dst"), ("d", "blocked", "dst", "src")):
        ranks.append(f"{kind}_out as (select {src} as s, sum(n) as total from links group by 1)")
        ranks.append(f"{kind}_share as (select l.{src} as s, l.{dst} as d, l.n / o.total as share from links l join {kind}_out o on l.{src} = o.s)")
        ranks.append(f"{kind}0 as (select host, {seed}::double as r from nodes)")
        for i in range(1, settings.rounds + 1):
            ranks.append(
                f"{kind}{i} as (select n.host, case when o.s is null then n.{seed} else {1 - settings.damping} * n.{seed} end + {settings.damping} * coalesce(f.flow, 0) as r"
                f" from nodes n left join {kind}_out o on o.s = n.host"
                f" left join (select x.d, sum(p.r * x.share) as flow from {kind}{i - 1} p join {kind}_share x on x.s = p.host group by 1) f on f.d = n.host)"
            )
    last = settings.rounds
    return rf"""
with cut as (
  select page_id, html, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
split as (
  select page_id, html, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from cut),
rules(verdict, h, p) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit as (
  select s.page_id, r.verdict, r.h || r.p as rule, row_number() over (partition by s.page_id order by length(r.h || r.p) desc) as place
  from split s join rules r on (s.host = r.h or s.host like '%.' || r.h) and starts_with(s.path, r.p)),
judged as (select s.*, f.rule, f.verdict as said from split s left join fit f on f.page_id = s.page_id and f.place = 1),
found as (
  select host as src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*(https?://[^\s"''<>]+)', 1)) as link from split),
ends as (
  select src, translate(regexp_extract(substr(link, instr(link, '://') + 3), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as dst from found),
links as (select src, dst, count(*) as n from ends where src <> '' and dst <> '' and src <> dst group by 1, 2),
own as (
  select host, count(*) as pages, count(*) filter (said = 'allow') as allowed, count(*) filter (said = 'block') as blocked
  from judged where host <> '' group by 1),
linked as (select src as host from links union select dst from links),
nodes as (
  select coalesce(o.host, l.host) as host, coalesce(pages, 0) as pages, coalesce(allowed, 0) as allowed, coalesce(blocked, 0) as blocked
  from own o full join linked l on l.host = o.host),
{", ".join(ranks)},
bad as (
  select n.host from nodes n join t{last} t on t.host = n.host join d{last} d on d.host = n.host
  where d.r > t.r and d.r >= {settings.threshold} * greatest(n.pages, 1))
select page_id, host, path, rule, coalesce(said, case when host in (select host from bad) then 'block' else 'allow' end) as verdict from judged
"""


ORACLE: dict[str, str] = {
    "op1_url_filter": _url_filter(),
    "op6_exact_top_k": """
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from rows q join rows c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored)
select query_id, place::int as rank, vec_id, score from ranked where place <= 20
""",
    "op7_warc": """
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (select page_id, strlen(payload) as size, upper(sha1(payload)) as hex, min(page_id) over (partition by sha1(payload)) as first from p)
select page_id, size::bigint as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), 'string_agg', '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from d
""",
}

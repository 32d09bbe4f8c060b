"""DuckDB SQL for the training-data queries that SQL can express."""

SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {}

SQL["op1_warc"] = """
with p as (select page_id, strlen(coalesce(html, ''))::bigint payload_bytes, sha1(coalesce(html, '')) hex,
                  unhex(sha1(coalesce(html, '')))::bit::varchar bits, max(page_id) over (partition by coalesce(html, '')) newest
           from pages)
select page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(1, 6), lambda j: substr(bits, (i * 5 + j)::int, 1)::int * (1 << (5 - j)::int)))::int, 1)), '')
           payload_digest,
       case when page_id = newest then 'response' else 'revisit' end record_type,
       case when page_id <> newest then newest end refers_to
from p
"""

SQL["op2_minhash_neardup"] = rf"""
with recursive d as (select doc_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') w from documents),
sets as (select doc_id, list_distinct(case when len(w) >= 3
             then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
             when len(w) > 0 then [array_to_string(w, ' ')] else [] end) s from d),
el as (select doc_id, len(s) n, unnest(s) x from sets),
pair as (select a.doc_id a, b.doc_id b, a.n + b.n - count(*) u, count(*) c
         from el a join el b on a.x = b.x and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, a.n, b.n),
link as (select a, b from pair where 100 * c >= 85 * u),
reach(doc_id, x) as (select doc_id, doc_id from d union select r.doc_id, l.b from reach r join link l on l.a = r.x)
select doc_id, len(s)::bigint n_shingles, min(x) component_id, doc_id = min(x) kept
from sets join reach using (doc_id) group by doc_id, s
"""

SQL["op5_extendible_sharding"] = f"""
with d as (select doc_id, strlen(coalesce(text, ''))::bigint n_bytes,
                  right(('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint::bit::varchar, 60) bits from documents),
p as (select doc_id, n_bytes, depth::int depth, substr(bits, 1, depth) shard
      from (select *, unnest(range(0, 61)) depth from d)),
s as (select shard, depth, sum(n_bytes)::bigint shard_bytes, count(*) shard_rows from p group by all)
select doc_id, any_value(n_bytes) n_bytes, arg_min(shard, depth) shard, min(depth) depth,
       arg_min(shard_bytes, depth) shard_bytes, arg_min(shard_rows, depth) shard_rows
from p join s using (shard, depth) where shard_bytes <= {16 << 20} or shard_rows = 1 group by doc_id
"""

SQL["op8_suffix_decontamination"] = rf"""
with d as (select doc_id, regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select row_number() over () nr, coalesce(item_id::varchar, '') item_id,
             regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
sizes as (select distinct least(13, len(w)) k from b where len(w) > 0),
win as (select item_id, nr, j, least(13, len(w)) k, array_to_string(w[j:j + 12], ' ') s
        from (select item_id, nr, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) j from b where len(w) > 0)),
place as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') s
          from (select doc_id, k, w, unnest(range(1, len(w) - k + 2)) i from d, sizes)),
found as (select doc_id, item_id, nr, j, k, i from place join win using (k, s)),
runs as (select doc_id, k + count(*) - 1 len from (
           select *, i - row_number() over (partition by doc_id, nr, i - j order by i) as run from found) group by doc_id, nr, i - j, k, run),
longest as (select doc_id, max(len)::bigint longest from runs group by 1),
hits as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + k)) p from found) group by 1),
items as (select doc_id, count(*) n, string_agg(item_id, ',' order by item_id) t
          from (select distinct doc_id, item_id from found) group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(hits.n, 0)::bigint n_hit, coalesce(items.n, 0)::bigint n_items,
       sha256(coalesce(t, '')) items_sha256, coalesce(hits.n, 0) > 0 and 20 * coalesce(hits.n, 0) >= len(w) contaminated,
       coalesce(longest, 0) longest
from d left join hits using (doc_id) left join items using (doc_id) left join longest using (doc_id)
"""

SQL["op10_substring_dedup"] = rf"""
with d as (select doc_id, {SPACE_WORDS} w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 12], ' ') s
        from (select doc_id, w, unnest(range(1, len(w) - 11)) i from d)),
least as (select s, min(doc_id) m from win group by s),
gone as (select distinct doc_id, unnest(range(i, i + 13)) p from win join least using (s) where doc_id > m),
word as (select doc_id, unnest(w) x, unnest(range(1, len(w) + 1)) p from d),
kept as (select word.doc_id, count(gone.p) n, string_agg(x, ' ' order by word.p) filter (where gone.p is null) t
         from word left join gone on word.doc_id = gone.doc_id and word.p = gone.p group by all)
select d.doc_id, len(w)::bigint n_words, coalesce(n, 0)::bigint n_removed, sha256(coalesce(t, '')) kept_sha256
from d left join kept using (doc_id)
"""


def _lloyd(k: int, rounds: int, size: int, scale: int, seed: str) -> str:
    """Every round as tables of its own: nearest centroid, then new centroids."""
    apart = f"list_sum(list_transform(range(1, {size + 1}), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::bigint"
    nearest = "n{0} as materialized (select id, any_value(vec_id) vec_id, any_value(x.v) v, min({{'d': " + apart + ", 'j': j}}) m from x, c{0} c group by id)"
    mean = f"""c{{1}} as materialized (
        select c.j, coalesce(s.v, c.v) v from c{{0}} c left join (
            select j, list(floor_div order by i) v from (
                select m.j j, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) floor_div
                from n{{0}}, (select unnest(range(1, {size + 1})) i) group by m.j, i) group by j) s using (j))"""
    return f"""
with x as materialized (
  select row_number() over () id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) v
  from embeddings where len(embedding) = {size} and len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = {size}),
c0 as materialized (
  select row_number() over (order by sha256('{seed}:' || coalesce(vec_id::varchar, '')), v) - 1 j, v from x qualify j < {k}),
{", ".join(nearest.format(r) + ", " + mean.format(r, r + 1) for r in range(rounds))}, {nearest.format(rounds)}
select n.vec_id, n.m.j::int cluster, n.m.d::bigint distance, sum(n.m.d) over (partition by n.m.j)::bigint cluster_inertia,
       sum(n.m.d) over ()::bigint inertia, sha256(array_to_string(c.v, ',')) centroid_sha256
from n{rounds} n join c{rounds} c on c.j = n.m.j
"""


SQL["op11_centroid_clustering"] = _lloyd(8, 10, 64, 1024, "3")

SQL["op12_source_mixing"] = rf"""
with d as (select doc_id, coalesce('=' || source, '>') key, len({SPACE_WORDS})::bigint size,
                  md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) hash from documents),
s as (select key, sum(size)::bigint source_size, [3, 1, 2][((row_number() over (order by key)) - 1) % 3 + 1] w from d group by key),
level as (select *, sum(source_size) over () n, sum(w) over () weight,
                 coalesce(sum(2 * source_size) over lower, 0) full_size, coalesce(sum(w) over lower, 0) full_weight
          from s window lower as (order by 2 * source_size / w, key rows between unbounded preceding and 1 preceding)),
capped as (select *, 2 * source_size * 100 * (weight - full_weight) < w * (150 * n - 100 * full_size) above from level),
goal as (select key, source_size, case when above then (2 * source_size)::double else
                (150 * n - 100 * coalesce(sum(2 * source_size) filter (above) over (), 0))::bigint::double * w
                / (100 * sum(w) filter (not above) over ())::double end target from capped),
rate as (select *, case when source_size = 0 then 0 else floor(least(target / source_size, 2.0::double) * {1 << 26}) end::bigint e,
                ('0x' || substr(md5('mix:' || key), 1, 6))::bigint * 4 o from goal),
nr as (select doc_id, size, source_size, target, e, o, row_number() over (
           partition by key order by lpad(len(bin(size))::varchar, 2, '0') || rpad(substr(bin(size), 1, 5), 5, '0'), hash, size) k
       from d join rate using (key))
select doc_id, size, source_size, target, size * ((k * e + o) // {1 << 26} - ((k - 1) * e + o) // {1 << 26}) taken from nr
"""

"""The same in SQL where SQL can express it; the other queries are tested by brute force."""

ORACLE_SQL: dict[str, str] = {}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = "regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL["op4_decontamination"] = f"""
with item as (
  select item_id, {_ITEM_WORDS} as w from benchmark where text is not null
), win as (
  select distinct item_id, array_to_string(w[s:s + 9], ' ') as phrase, least(len(w), 10) as size
  from item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(s) where len(w) > 0
), sizes as (select distinct size from win),
doc as (
  select doc_id, {_ITEM_WORDS.replace("text", "coalesce(text, '')")} as w from documents
), hit as (
  select d.doc_id, d.s, d.size, win.item_id
  from (select doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') as phrase
        from doc, sizes, unnest(range(1, len(w) - size + 2)) as t(s)) d
  join win on win.phrase = d.phrase and win.size = d.size
), n as (
  select doc_id, count(distinct p) as n_hit from hit, unnest(range(s, s + size)) as t(p) group by doc_id
), i as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from hit) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join n using (doc_id) left join i using (doc_id)
"""

# CRC-32 from its table, which a rule makes, over the bytes of a feature.
_CRC_TABLE = """
crc_step(i, k, c) as (
  select i, 0, i::ubigint from range(256) as t(i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from crc_step where k < 8
), crc_table as (select list(c order by i) as crc from crc_step where k = 8)"""
_CRC_BUCKET = """xor(list_reduce(
    list_prepend(4294967295::ubigint, list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda x: ('0x' || x)::ubigint)),
    lambda c, b: xor(c >> 8, crc[((xor(c, b) & 255) + 1)::bigint])), 4294967295::ubigint) % 10000"""
_RUN = "array_to_string(w[i:i + k - 1], ' ') as feature"
_RUNS = "unnest(range(1, len(w) + 1)) as t(i), unnest([1, 2, 3]) as u(k) where i + k - 1 <= len(w)"

ORACLE_SQL["op11_resampling"] = f"""
with recursive {_CRC_TABLE},
doc as (select row_number() over () as row, doc_id, {_ITEM_WORDS.replace("text", "coalesce(text, '')")} as w from documents),
item as (select {_ITEM_WORDS} as w from benchmark where text is not null),
doc_feature as (select row, {_RUN} from doc, {_RUNS}),
item_feature as (select {_RUN} from item, {_RUNS}),
feature as (select distinct feature from (select feature from doc_feature union all select feature from item_feature)),
named as (select feature, {_CRC_BUCKET} as bucket from feature, crc_table),
s as (select bucket, count(*) as s from doc_feature join named using (feature) group by bucket),
t as (select bucket, count(*) as t from item_feature join named using (feature) group by bucket),
total as (select coalesce((select sum(s) from s), 0)::double as ss, coalesce((select sum(t) from t), 0)::double as tt),
gain as (
  select b as bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (ss + 10000) / ((coalesce(s, 0)::double + 1) * (tt + 10000))))::bigint as gain
  from range(10000) as r(b) left join s on s.bucket = b left join t on t.bucket = b, total
),
weight as (
  select row, sum(gain)::bigint as weight, count(*) as n_features
  from doc_feature join named using (feature) join gain using (bucket) group by row
),
scored as (
  select row, doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double))))::bigint as score
  from doc left join weight using (row)
),
drawn as (
  select row, row_number() over (order by score desc, doc_id nulls last, n_features, row) as rank, count(*) over () as n
  from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when rank <= 5 * n // 100 then rank end as rank
from scored left join drawn using (row)
"""

ORACLE_SQL["op12_mixing"] = r"""
with doc as (
  select row_number() over () as row, doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents
), src as (
  select source, sum(size)::bigint as source_size, row_number() over (order by encode(source) nulls last) as place from doc group by source
), weighted as (
  select *, [3.0::double, 1.0, 2.0][(place - 1) % 3 + 1] as weight, 2 * source_size as cap,
    sum(source_size) over () as whole, sum([3.0::double, 1.0, 2.0][(place - 1) % 3 + 1]) over () as weights
  from src
), levels as (
  select *, source_size / weight as ratio,
    (1.5::double * whole - (sum(cap) over by_ratio - cap)) / (weights - (sum(weight) over by_ratio - weight)) as level
  from weighted window by_ratio as (order by source_size / weight, place rows unbounded preceding)
), chosen as (
  select first(level order by ratio, place) as level from levels where level * weight <= cap
), target as (
  select source, source_size, place, least(cap::double, weight * c.level) as target from weighted, chosen c
), laid as (
  select d.*, t.source_size, t.place, t.target, floor(t.target)::bigint as asked,
    (sum(size) over (partition by d.source order by md5('42:' || coalesce(doc_id::varchar, '')), doc_id nulls first, size, row
      rows unbounded preceding) - size)::bigint as begins
  from doc d join target t on d.source is not distinct from t.source
), occurrence as (
  select *, greatest(0, least(size, asked - begins)) as once, greatest(0, least(size, asked - begins - source_size)) as again from laid
), part as (
  select *, case when once > 0 then begins when again > 0 then begins + source_size end / target as y,
    case when once > 0 or again > 0 then 1 else 0 end as met
  from occurrence
)
select doc_id, size, source_size, target, (once + again)::bigint as taken,
  case when met = 0 then null
    when place % 3 = 1 then case when y * 3.0 > 0 then 0.0 + 2 * (y * 3.0) / (sqrt(16.0::double + 2 * -2.0 * (y * 3.0)) + 4.0) else 0.0 end
    when place % 3 = 2 then case
      when y * 1.0 < 0.25 then case when y > 0 then 2 * y / (sqrt(0.25::double) + 0.5) else 0.0 end
      else case when y - 0.25 > 0 then 0.5 + 2 * (y - 0.25) / (sqrt(0.25::double + 2 * 4.0 * (y - 0.25)) + 0.5) else 0.5 end end
    else case when y * 2.0 > 0 then 2 * (y * 2.0) / (sqrt(4.0::double) + 2.0) else 0.0 end end::double as position
from part
"""


def _vector_codes(parts: int = 8, rounds: int = 6) -> str:
    """Every round as two CTEs: each part's nearest entry, then the entries' means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""found{r} as materialized (
  select row, part, min_by(entry, (distance, entry)) as entry, min(distance) as distance from (
    select p.row, p.part, b.entry, list_sum([(p.x[i] - b.x[i]) * (p.x[i] - b.x[i]) for i in range(1, len(p.x) + 1)])::bigint as distance
    from part p join book{r} b using (part)) group by row, part)""")
        if r < rounds:
            steps.append(f"""mean{r} as (
  select part, entry, list(m order by i) as x from (
    select f.part, f.entry, i, floor(sum(p.x[i])::double / count(*))::bigint as m
    from found{r} f join part p using (row, part), unnest(range(1, len(p.x) + 1)) as t(i) group by f.part, f.entry, i)
  group by part, entry
), book{r + 1} as materialized (select part, entry, coalesce(m.x, b.x) as x from book{r} b left join mean{r} m using (part, entry))""")
    return f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as row, vec_id, label,
    [floor(4096 * x::double)::bigint for x in embedding] as v
  from embeddings where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len(embedding) > 0
), sized as (
  select * from kept where len(v) = (select len(v) from kept where row = 1)
), part as materialized (
  select row, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] as x
  from sized, unnest(range({parts})) as t(part)
), ranked as (select row, row_number() over (order by row) - 1 as entry from sized
), book0 as materialized (select part, entry, x from part join ranked using (row) where entry < 16
), {", ".join(steps)}, coded as (
  select row, string_agg(format('{{:02x}}', entry), '' order by part) as code, sum(distance)::bigint as error from found{rounds} group by row
), books as (
  select sha256(coalesce(string_agg(array_to_string(x, ','), ',' order by part, entry), '')) as codebooks_sha256 from book{rounds}
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join sized using (row), books
"""


ORACLE_SQL["op13_vector_codes"] = _vector_codes()

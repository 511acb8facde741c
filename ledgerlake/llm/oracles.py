"""DuckDB SQL for the rows of the queries on exact copies, conversation tries and manifests."""

from __future__ import annotations

#: Of each byte the CRC-32 step, for crc32().
CRC = """
crc_table as (select list(c order by i) as tab from (select i, list_reduce(list_concat([i], range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c from range(256) as r(i))),"""


def crc32(number: str) -> str:
    """SQL for the unsigned CRC-32 of a number's decimal digits; needs CRC's table `crc_table` in its from clause."""
    byte = f"list_transform(range(1, length({number}::varchar) + 1), lambda p: ascii(substr({number}::varchar, p, 1))::bigint)"
    return f"xor(list_reduce(list_concat([4294967295], {byte}), lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295)"


OP11 = f"""
with {CRC}
     t as (select conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') as body, length(coalesce(text, '')) as size from conversations where conv_id is not null),
     o as (select conv_id, list(struct_pack(id := substr(sha256(body), 1, 32), size := size) order by turn nulls first, substr(sha256(body), 1, 32)) as turns from t group by conv_id),
     h as (select conv_id, turns, {crc32('conv_id')} % 6 as h from o, crc_table),
     r as (select h.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(h.turns, h + 1, len(h.turns))) as turns from h left join o b on b.conv_id = h.conv_id - h.conv_id % 100),
     p as (select conv_id, d as depth, len(turns) as total, case when d = 0 then 0 else turns[d].size end as size,
                  sha256(array_to_string(list_transform(list_slice(turns, 1, d), lambda x: x.id), '')) as node
           from r, unnest(range(len(turns) + 1)) as u(d)),
     up as (select c.conv_id, c.depth, c.node, f.node as parent from p c left join p f on f.conv_id = c.conv_id and f.depth = c.depth - 1),
     n as (select depth, node, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size, any_value(parent) as parent,
                  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (total = depth), '')) as ends_sha256
           from p join up using (conv_id, depth, node) group by depth, node),
     k as (select depth - 1 as depth, parent as node, count(*) as n_children from n where depth > 0 group by all),
     m as (select n.*, coalesce(n_children, 0) as n_children from n left join k using (depth, node)),
     s as (select a.depth, a.node, sum(case when m.n_children = 0 then 1 else 0 end) as n_leaves, sum((m.n_convs - 1) * m.size) as saved_tokens
           from m join p a on a.conv_id = m.conv_id and a.depth <= m.depth group by all)
select m.conv_id, m.depth, f.conv_id as parent_conv_id, m.n_convs, m.n_children, s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, m.ends_sha256
from m join s using (depth, node) left join m f on f.depth = m.depth - 1 and f.node = m.parent"""

OP12 = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
     g as (select t, min(doc_id) as keep_id, count(*) as group_size from n group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from n join g using (t)"""


def field(column: str) -> str:
    """SQL for a column as part of a leaf."""
    return f"coalesce(strlen({column}::varchar) || ':' || {column}::varchar, '-')"


FIELDS = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
TAMPERED = f"case when {crc32('doc_id')} % 2 = 0 then replace(text, chr(10), '') else text end"
OP13 = f"""
with recursive {CRC}
     d as (select doc_id, coalesce('=' || source, '') as tree, sha256({FIELDS} || {field('text')}) as leaf,
                  sha256({FIELDS} || {field(TAMPERED)}) as found
           from documents, crc_table),
     o as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx from d),
     low as (select tree, 0 as level, idx, leaf as h from o
             union all
             select tree, level + 1, idx, h from (select tree, level, idx // 3 as idx, sha256(string_agg(h, '' order by idx)) as h, count(*) over (partition by tree, level) as n, max(many) as many
                from (select *, count(*) over (partition by tree, level) as many from low) group by tree, level, idx // 3) where many > 1),
     height as (select tree, max(level) as top from low group by tree),
     sub as (select low.tree, h, top, row_number() over (order by low.tree) - 1 as idx from low join height on low.tree = height.tree and level = top),
     high as (select 0 as level, idx, h from sub
              union all
              select level + 1, idx, h from (select level, idx // 3 as idx, sha256(string_agg(h, '' order by idx)) as h, max(many) as many
                from (select *, count(*) over (partition by level) as many from high) group by level, idx // 3) where many > 1),
     peak as (select level, h from high order by level desc limit 1),
     steps as (select doc_id, leaf, o.tree, step, idx // (3 ** step)::bigint as at, true as inner_ from o join height using (tree), unnest(range(height.top)) as u(step)
               union all
               select doc_id, leaf, o.tree, step + sub.top, sub.idx // (3 ** step)::bigint, false from o join sub using (tree), peak, unnest(range(peak.level)) as u(step)),
     near as (select s.doc_id, s.leaf, s.step, coalesce(string_agg(n.h, '' order by n.idx) filter (n.idx < s.at), '') as before, coalesce(string_agg(n.h, '' order by n.idx) filter (n.idx > s.at), '') as after
              from steps s join sub on sub.tree = s.tree join (select true as inner_, tree, level, idx, h from low union all select false, '', level, idx, h from high) n
                on n.inner_ = s.inner_ and n.tree = case when s.inner_ then s.tree else '' end and n.level = case when s.inner_ then s.step else s.step - sub.top end and n.idx // 3 = s.at // 3
              group by s.doc_id, s.leaf, s.step),
     fold as (select doc_id, leaf, 0 as step, found as h from o
              union all
              select f.doc_id, f.leaf, f.step + 1, sha256(before || f.h || after) from fold f join near n on n.doc_id is not distinct from f.doc_id and n.leaf = f.leaf and n.step = f.step),
     proofs as (select doc_id, leaf, string_agg(before || after, '' order by step) as proof from near group by doc_id, leaf),
     folded as (select doc_id, leaf, arg_max(h, step) as folded_root from fold group by doc_id, leaf)
select o.doc_id, o.leaf, sub.h as subroot, peak.h as root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = peak.h as verified
from o join sub using (tree) join peak on true left join proofs p on p.doc_id is not distinct from o.doc_id and p.leaf = o.leaf join folded f on f.doc_id is not distinct from o.doc_id and f.leaf = o.leaf"""

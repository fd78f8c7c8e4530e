"""The stemming rules as SQL, one step per table, for a table ``vocabulary(word)``."""

from __future__ import annotations

from threadlens.functions.stem import (
    FIRST_REGION,
    FIRST_REGION_AGAIN,
    IRREGULAR,
    SECOND_REGION,
)
from threadlens.functions.words import STOP_WORDS

REGION = "^[^aeiouy]*[aeiouy]+[^aeiouy]"


def _cases(table: dict[str, str], key: str) -> str:
    rows = " ".join(f"when '{a}' then '{b}'" for a, b in table.items())
    return f"case {key} {rows} end"


def _step(name: str, before: str, endings: list[str], rule: str) -> str:
    pattern = "|".join(endings)
    return f"""{name} as (
  select word, p1, p2, case when x = '' then w else {rule} end as w from (
    select *, left(w, length(w) - length(x)) as b from (
      select *, regexp_extract(w, '({pattern})$', 1) as x from {before})))"""


_SHORT = "regexp_matches(b, '[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$')"

_PLURAL = """case when x = 'sses' then b || 'ss'
  when x in ('ied', 'ies') then b || case when length(b) > 1 then 'i' else 'ie' end
  when x = 's' and regexp_matches(b, '[aeiouy].') then b else w end"""

_PAST = f"""case when x in ('eed', 'eedly') then case when length(b) >= p1 then b || 'ee' else w end
  when not regexp_matches(b, '[aeiouy]') then w
  when regexp_matches(b, '(at|bl|iz)$') then b || 'e'
  when regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') then left(b, length(b) - 1)
  when length(b) <= p1 and {_SHORT} then b || 'e' else b end"""

_FIRST = f"""case when length(b) >= p1 and (x <> 'ogi' or b like '%l')
  and (x <> 'li' or regexp_matches(b, '[cdeghkmnrt]$')) then b || {_cases(FIRST_REGION, "x")} else w end"""

_AGAIN = f"""case when length(b) >= p1 and (x <> 'ative' or length(b) >= p2)
  then b || {_cases(FIRST_REGION_AGAIN, "x")} else w end"""

_SECOND = """case when length(b) >= p2 and (x <> 'ion' or regexp_matches(b, '[st]$')) then b else w end"""

_LAST = f"""case when x = 'l' then case when length(b) >= p2 and b like '%l' then b else w end
  when length(b) >= p2 or (length(b) >= p1 and not {_SHORT}) then b else w end"""

STEMS = f"""marked as (
  select word, regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') as w
  from vocabulary),
first_start as (
  select *, case when starts_with(w, 'gener') or starts_with(w, 'arsen') then 5
    when starts_with(w, 'commun') then 6
    else coalesce(nullif(length(regexp_extract(w, '{REGION}')), 0), length(w)) end as p1 from marked),
second_start as (
  select *, p1 + coalesce(nullif(length(regexp_extract(substr(w, p1 + 1), '{REGION}')), 0),
    length(w) - p1) as p2 from first_start),
{_step("s1", "second_start", ["sses", "ied", "ies", "us", "ss", "s"], _PLURAL)},
{_step("s2", "s1", ["eedly", "ingly", "edly", "eed", "ing", "ed"], _PAST)},
{_step("s3", "s2", ["y", "Y"], "case when regexp_matches(b, '.[^aeiouy]$') then b || 'i' else w end")},
{_step("s4", "s3", list(FIRST_REGION), _FIRST)},
{_step("s5", "s4", list(FIRST_REGION_AGAIN), _AGAIN)},
{_step("s6", "s5", SECOND_REGION, _SECOND)},
{_step("s7", "s6", ["e", "l"], _LAST)},
stems as (
  select word, coalesce({_cases(IRREGULAR, "word")},
    case when length(word) <= 2 then word else replace(w, 'Y', 'y') end) as stem from s7)"""

STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)

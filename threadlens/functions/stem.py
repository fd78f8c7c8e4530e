"""English suffix stemming (the published Porter2 rules) as one SQL expression.

A word is carried as a struct of the word and the starts of its two suffix regions;
each rule is a ``transform`` over the array, so the whole chain stays inside the JVM and
inside the row. It is written as SQL text because one call then hands the whole chain to
Spark. Words must be lower case.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words the rules must not touch, with their stems.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes", "inning": "inning",
    "innings": "inning", "outing": "outing", "outings": "outing", "canning": "canning",
    "cannings": "canning", "herring": "herring", "herrings": "herring",
    "earring": "earring", "earrings": "earring", "proceed": "proceed",
    "proceeds": "proceed", "proceeded": "proceed", "proceeding": "proceed",
    "exceed": "exceed", "exceeds": "exceed", "exceeded": "exceed",
    "exceeding": "exceed", "succeed": "succeed", "succeeds": "succeed",
    "succeeded": "succeed", "succeeding": "succeed",
}

# Suffix -> replacement inside the first region.
FIRST_REGION = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}

# Second list for the first region; "ative" must be in the second one.
FIRST_REGION_AGAIN = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}

# Suffixes dropped in the second region; "ion" only after s or t.
SECOND_REGION = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ism", "ate", "iti", "ous", "ive", "ize", "ion",
]

# What follows the first consonant after a vowel.
REGION = "^[^aeiouy]*[aeiouy]+[^aeiouy](.*)"

# The rules in order: endings, and what becomes of a word {w} that has the
# ending {x} after {b}; {p1} and {p2} are the starts of the regions.
SHORT = "{b} rlike '[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$'"
PLURAL = """case when {x} = 'sses' then {b} || 'ss'
  when {x} in ('ied', 'ies') then {b} || if(length({b}) > 1, 'i', 'ie')
  when {x} = 's' and {b} rlike '[aeiouy].' then {b} else {w} end"""
PAST = f"""case when {{x}} in ('eed', 'eedly') then if(length({{b}}) >= {{p1}}, {{b}} || 'ee', {{w}})
  when not {{b}} rlike '[aeiouy]' then {{w}}
  when {{b}} rlike '(at|bl|iz)$' then {{b}} || 'e'
  when {{b}} rlike '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$' then left({{b}}, length({{b}}) - 1)
  when length({{b}}) <= {{p1}} and {SHORT} then {{b}} || 'e' else {{b}} end"""
FINAL_Y = "if({b} rlike '.[^aeiouy]$', {b} || 'i', {w})"
DROP_LAST = f"""case when {{x}} = 'l' then if(length({{b}}) >= {{p2}} and endswith({{b}}, 'l'), {{b}}, {{w}})
  when length({{b}}) >= {{p2}} or (length({{b}}) >= {{p1}} and not {SHORT}) then {{b}} else {{w}} end"""
IN_FIRST = """case when length({b}) >= {p1} and ({x} != 'ogi' or endswith({b}, 'l'))
  and ({x} != 'li' or {b} rlike '[cdeghkmnrt]$') then {b} || %s else {w} end"""
IN_FIRST_AGAIN = """case when length({b}) >= {p1} and ({x} != 'ative' or length({b}) >= {p2})
  then {b} || %s else {w} end"""
IN_SECOND = """case when length({b}) >= {p2} and ({x} != 'ion' or {b} rlike '[st]$') then {b}
  else {w} end"""


def _lookup(table: Mapping[str, str], key: str) -> str:
    pairs = " ".join(f"when '{ending}' then '{new}'" for ending, new in table.items())
    return f"case {key} {pairs} end"


def _ending_of(word: str, endings: Iterable[str]) -> str:
    """The longest listed ending of a word: first by its last letter, then by length."""
    endings = sorted(endings, key=len, reverse=True)
    branches = []
    for last in sorted({ending[-1] for ending in endings}):
        same = [f"when endswith({word}, '{e}') then '{e}'" for e in endings if e[-1] == last]
        branches.append(f"when endswith({word}, '{last}') then case {' '.join(same)} else '' end")
    return f"case {' '.join(branches)} else '' end"


def _rule(states: str, endings: Iterable[str], outcome: str) -> str:
    found = f"transform({states}, s -> struct(s, {_ending_of('s.w', endings)} as x))"
    word = outcome.format(
        w="m.s.w", x="m.x", b="left(m.s.w, length(m.s.w) - length(m.x))", p1="m.s.p1", p2="m.s.p2"
    )
    changed = f"named_struct('w', {word}, 'p1', m.s.p1, 'p2', m.s.p2)"
    return f"transform({found}, m -> if(m.x = '', m.s, {changed}))"


def _start(words: str) -> str:
    """Consonant y marked as Y, and the starts of the regions."""
    marked = (
        f"transform({words}, w -> if(contains(w, 'y'), "
        "regexp_replace(regexp_replace(w, '^y', 'Y'), '([aeiouy])y', '$1Y'), w))"
    )
    first = (
        f"transform({marked}, w -> named_struct('w', w, 'r', case "
        "when startswith(w, 'gener') or startswith(w, 'arsen') then substring(w, 6) "
        f"when startswith(w, 'commun') then substring(w, 7) else regexp_extract(w, '{REGION}', 1) end))"
    )
    second = f"if(length(s.r) > 2, length(regexp_extract(s.r, '{REGION}', 1)), 0)"
    return (
        f"transform({first}, s -> named_struct('w', s.w, 'p1', length(s.w) - length(s.r), "
        f"'p2', length(s.w) - {second}))"
    )


def stems_sql(words: str) -> str:
    """SQL for the stems of an array of words, given as SQL."""
    states = _start(words)
    states = _rule(states, ["sses", "ied", "ies", "us", "ss", "s"], PLURAL)
    states = _rule(states, ["eedly", "ingly", "edly", "eed", "ing", "ed"], PAST)
    states = _rule(states, ["y", "Y"], FINAL_Y)
    states = _rule(states, FIRST_REGION, IN_FIRST % _lookup(FIRST_REGION, "{x}"))
    states = _rule(states, FIRST_REGION_AGAIN, IN_FIRST_AGAIN % _lookup(FIRST_REGION_AGAIN, "{x}"))
    states = _rule(states, SECOND_REGION, IN_SECOND)
    states = _rule(states, ["e", "l"], DROP_LAST)
    listed = ", ".join(f"'{word}'" for word in IRREGULAR)
    return (
        f"zip_with({words}, {states}, (w, s) -> case when w in ({listed}) then {_lookup(IRREGULAR, 'w')} "
        "when length(w) <= 2 then w else translate(s.w, 'Y', 'y') end)"
    )


def stem_tokens(words: str) -> Column:
    """Stem of every word of an array column, in order."""
    return F.expr(stems_sql(words))


def stem_word(word: str) -> Column:
    """Stem of a word column."""
    return F.expr(f"element_at({stems_sql(f'array({word})')}, 1)")

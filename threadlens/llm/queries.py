"""The operators as queries over the test tables, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.llm import (
    chat, decontam, lines, manifest_sql, merkle, mixing, periods, pii, quality, simhash, suffixes, tokens, vectors, warc,
)
from threadlens.llm.common import table

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


@query(
    """
    with p as (
      select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
        sha256(coalesce(html, '')) as payload_digest from pages),
    f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by all)
    select page_id, payload_bytes, p.payload_digest,
      case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
      case when first <> page_id then first end as refers_to
    from p left join f using (payload_digest)
    """
)
def op3_warc(spark, folder):
    """Pages with odd ids through ARC version 1, the others through version 2, converted together."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    odd = F.coalesce(F.col("page_id") % 2 != 0, F.lit(False))
    arcs = [warc.write_arc(pages.filter(odd), 1), warc.write_arc(pages.filter(~odd), 2)]
    records, index = (
        warc.read_arc(spark, arcs[0], blocks).unionByName(warc.read_arc(spark, arcs[1], blocks)) for blocks in (True, False)
    )
    return warc.page_digests(spark, [warc.write_warc(warc.with_revisits(records, index))])


@query()
def op10_tokens(spark, folder):
    import public_tokenizers

    docs = table(spark, folder, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    written = tokens.write_tokens(docs, path, 2, public_tokenizers.PATTERN)
    return tokens.token_digests(spark, written)


@query()
def op7_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op8_quality(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


_WORDS = """regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


@query(
    f"""
    with d as (select doc_id, {_WORDS} as w from documents),
    i as (select item_id, {_WORDS} as w from benchmark),
    cut as (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k
      from i where len(w) > 0),
    windows as (select distinct item_id, n, array_to_string(w[k:k + n - 1], ' ') as win from cut),
    places as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k
      from d, (select distinct n from windows)),
    hits as (select doc_id, k, n, item_id
      from (select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as win from places) join windows using (n, win)),
    words as (select doc_id, count(distinct p) as n_hit
      from (select doc_id, unnest(range(k, k + n)) as p from hits) group by all),
    items as (select doc_id, count(distinct item_id) as n_items,
      string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as listed from hits group by all)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
      coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
      coalesce(n_hit, 0) > 0 as contaminated
    from d left join words using (doc_id) left join items using (doc_id)
    """
)
def op6_decontamination(spark, folder):
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op9_vectors(spark, folder):
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op5_suffixes(spark, folder):
    return suffixes.repeat_digests(table(spark, folder, "documents"))


#: No source is repeated more often by the registered mix.
REPEATS = 2.0


@query(
    f"""
    with recursive d as (
      select doc_id, source, case when source is null then 'n' else 's:' || source end as key,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint % 256 as block,
        len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+')) as tokens from documents),
    blocks as (select key, block, sum(tokens)::bigint as tokens from d group by all),
    totals as (select key, sum(tokens)::bigint as total from blocks group by key having sum(tokens) > 0),
    shares as (select key, total, total / (select sum(total) from totals)::double as share from totals),
    bisect as (
      select 0 as step, 0.0::double as low, 1.0::double as high
      union all
      select step + 1, case when fits then low else mid end, case when fits then mid else high end
      from (select step, low, high, (low + high) / 2 as mid,
          (select max(pow(share, (low + high) / 2 - 1)) / min(pow(share, (low + high) / 2 - 1)) from shares) <= {REPEATS} as fits
        from bisect where step < 45)),
    chosen as (select case when (select max(1 / share) / min(1 / share) from shares) <= {REPEATS} then 0.0 else high end as e
      from bisect order by step desc limit 1),
    budgets as (select key, total,
        round(total * pow(share, e - 1) / (select min(pow(share, e - 1)) from shares))::bigint as budget from shares, chosen),
    dealt as (select b.key, block, tokens, total, budget,
        unnest(case when total is null then [0] else range(0, ((budget - 1) // total + 1)::bigint) end) as pass
      from blocks b left join budgets using (key)),
    ranked as (select *, row_number() over w - 1 as place,
        sum(tokens) over (w rows between unbounded preceding and current row) as until
      from dealt window w as (partition by key, pass order by md5(key || ':' || block || ':' || pass), block)),
    plan as (select key, block, pass, place, budget from ranked
      where total is null or budget - total * pass >= total or 2 * until - tokens <= 2 * (budget - total * pass))
    select doc_id, d.source, tokens::bigint as tokens, pass::bigint as pass, place::bigint as place, budget
    from d join plan using (key, block)
    """
)
def op2_mixing(spark, folder):
    found = mixing.mixed(table(spark, folder, "documents").select("doc_id", "source", "text"), repeats=REPEATS)
    return found.select(
        "doc_id", "source", mixing.word_count(F.coalesce("text", F.lit(""))).cast("bigint").alias("tokens"),
        F.col("mix_pass").alias("pass"), F.col("mix_place").alias("place"), F.col("mix_budget").alias("budget"),
    )


@query()
def op1_lines(spark, folder):
    return lines.line_digests(table(spark, folder, "documents"))


@query()
def op4_pii(spark, folder):
    return pii.personal_data(table(spark, folder, "documents"))


@query(manifest_sql.PROOFS)
def op11_merkle(spark, folder):
    return merkle.proofs(table(spark, folder, "documents"))


#: A conversation that speaks in marks: number, role and text of its turns.
MARKS = r"\### Assistant: </turn> ok"


@query(
    rf"""
    with c as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all values (-7, 0, 'user', '{MARKS}'), (-7, 1, 'assistant', '{MARKS}')),
    f as (select *, replace(replace(replace(text, '\', '\\'), '<turn:', '\<turn:'), '</turn>', '\</turn>') as body from c)
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      sum(length('<turn:' || role || '>' || chr(10) || body || chr(10) || '</turn>' || chr(10)))::bigint as formatted_chars
    from f group by conv_id
    """
)
def op12_chats(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], "conv_id bigint, turn bigint, role string, text string")
    return chat.conversation_digests(rows.unionByName(marks))


@query()
def op13_periods(spark, folder):
    return periods.run_digests(periods.planted(table(spark, folder, "documents")))

"""Cleaning, word counts and TF-IDF over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import query, rounded, table
from threadlens.checks.reshaping import bag_of_words
from threadlens.checks.sentiment import TOPICS, tokens_sql
from threadlens.checks.stem_sql import STEMS, STOP_LIST
from threadlens.functions.text import topic_flags
from threadlens.functions.words import STOP_WORDS, TOPIC_TERMS
from threadlens.operators import corpus, summary
from threadlens.operators.joins import join_by_frequency

WORDS = f"""listed as (select doc_id, lang, {tokens_sql("text")} as words from documents),
raw as (select doc_id, lang, unnest(words) as word, generate_subscripts(words, 1) as pos from listed),
kept as (select * from raw where word not in ({STOP_LIST})),
vocabulary as (select distinct word from kept),
{STEMS},
stemmed as (select doc_id, lang, pos, stem as term from kept join stems using (word))"""


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "lang", "text")


@query(f"""with {WORDS}, joined as (select doc_id, string_agg(term, ' ' order by pos) as t from stemmed group by doc_id)
select d.doc_id, coalesce(t, '') as text from documents d left join joined on d.doc_id = joined.doc_id""")
def clean_tokens(spark, folder):
    return corpus.clean_column(documents(spark, folder).select("doc_id", "text"), "text")


@query(f"""with listed as (
  select doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+|[^\\s\\p{{L}}\\p{{N}}_]+') as words from documents),
raw as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from listed),
kept as (select * from raw where word not in ({STOP_LIST})),
vocabulary as (select distinct word from kept),
{STEMS},
normal as (select doc_id, pos, regexp_replace(stem, '[^\\w\\d\\s]', '', 'g') as t from kept join stems using (word)),
joined as (select doc_id, string_agg(t, ' ' order by pos) as t from normal where t <> '' group by doc_id)
select d.doc_id, coalesce(t, '') as clean_text from documents d left join joined on d.doc_id = joined.doc_id""")
def clean_annotated(spark, folder):
    return corpus.annotated_clean(documents(spark, folder), "doc_id", "text", STOP_WORDS)


@query(f"""with listed as (select {tokens_sql("text")} as words from documents),
raw as (select unnest(words) as word from listed),
vocabulary as (select distinct word from raw),
{STEMS}
select word, stem, count(*) as count from raw join stems using (word) group by word, stem""")
def stem_map(spark, folder):
    return corpus.stem_table(documents(spark, folder), "text")


@query(f"with {WORDS} select term as word, count(*) as count from stemmed group by term")
def word_freq(spark, folder):
    return corpus.sorted_by_count(corpus.word_counts(documents(spark, folder), "text"))


@query(f"""with {WORDS} select term as word, count(*) as count from stemmed group by term
order by count desc, word limit 50""")
def top_words(spark, folder):
    return corpus.top_words(corpus.word_counts(documents(spark, folder), "text"), 50)


@query(f"with {WORDS} select term as word, count(*) as count from stemmed group by term")
def bow_export(spark, folder):
    return bag_of_words(spark, folder)


@query(f"""with {WORDS}, counts as (select lang, term as word, count(*) as count from stemmed group by all),
ranked as (select *, row_number() over (partition by lang order by count desc, word) as rank from counts)
select * from ranked where rank <= 50""")
def top_terms_by_group(spark, folder):
    counts = corpus.word_counts(documents(spark, folder), "text", ["lang"])
    return corpus.top_words_per_group(counts, "lang", 50)


TFIDF = f"""{WORDS},
tf as (select doc_id, term, count(*) as tf from stemmed where length(term) >= 2 group by all),
dfs as (select term, count(*) as df from tf group by term),
raw_weights as (select doc_id, term, tf, df,
  tf * (ln((1 + (select count(*) from documents)) / (1 + df)) + 1) as raw from tf join dfs using (term)),
weights as (select doc_id, term, tf, df,
  raw / sqrt(sum(raw * raw) over (partition by doc_id)) as weight from raw_weights)"""


def coded_weights(spark, folder):
    docs = documents(spark, folder)
    codes, terms = corpus.coded_words(docs, "text", min_length=2)
    return corpus.tfidf_coded(docs, corpus.coded_counts(docs, "doc_id", "text", codes), "doc_id"), terms


@query(f"with {TFIDF} select doc_id, term, tf, df, round(weight, 6) as weight from weights")
def tfidf_sklearn(spark, folder):
    weights, terms = coded_weights(spark, folder)
    return join_by_frequency(weights, terms, "code", "n").select("doc_id", "term", "tf", "df", "weight").withColumns(rounded(6, "weight"))


@query(f"""with {TFIDF} select term, round(sum(weight), 4) as weight from weights group by term
order by sum(weight) desc, term limit 50""")
def tfidf_top(spark, folder):
    return corpus.important_coded(*coded_weights(spark, folder), 50).withColumns(rounded(4, "weight"))


@query("""with edges as (select min(n_chars)::double as low, max(n_chars)::double as high from documents),
binned as (select least(floor((n_chars - low) / ((high - low) / 11)) + 1, 11)::bigint as bin from documents, edges)
select b.bin, round(low + (b.bin - 1) * (high - low) / 11, 4) as bin_start, count(binned.bin) as frequency
from (select unnest(range(1, 12)) as bin) b cross join edges left join binned on b.bin = binned.bin
group by b.bin, low, high""")
def length_hist(spark, folder):
    docs = documents(spark, folder).select(F.length("text").alias("text_length"))
    return summary.histogram(docs, "text_length", 11).withColumns(rounded(4, "bin_start"))


def _flag_sql() -> str:
    parts = []
    for name, terms in (TOPIC_TERMS | TOPICS).items():
        looks = "|".join(terms)
        parts.append(f"regexp_matches(text, '{looks}') as dummy_{name}")
    return ", ".join(parts)


@query(f"select doc_id, {_flag_sql()} from documents")
def topic_flag_columns(spark, folder):
    flags = topic_flags(F.col("text"), TOPIC_TERMS | TOPICS)
    return documents(spark, folder).withColumns(flags).select("doc_id", *flags)

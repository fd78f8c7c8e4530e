"""Reproducible samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.engagement import COMMUNITIES
from threadlens.checks.registry import query, table
from threadlens.operators import sampling
from threadlens.operators.reshape import stack_frames

LANGUAGES = ["de", "en", "es", "fr"]


@query("""with picked as (
  select event_id, event_type, value,
    row_number() over (partition by event_type order by md5(event_id::varchar), event_id) as r
  from events)
select event_id, event_type, value from picked where r <= 500""")
def stratified_sample(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return sampling.sample_per_group(events, "event_type", "event_id", 500, groups=COMMUNITIES)


@query("""with sizes as (select lang, count(*) as n from documents group by lang),
picked as (select doc_id, lang, row_number() over (partition by lang order by md5(doc_id::varchar), doc_id) as r
  from documents)
select doc_id, lang from picked where r <= (select min(n) from sizes)""")
def class_balance(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return sampling.balance_classes(docs, "lang", "doc_id", groups=LANGUAGES)


@query("""with picked as (
  select event_id, event_type,
    row_number() over (partition by event_type order by md5(event_id::varchar), event_id) as r from events)
select event_id, event_type from picked
where r <= case event_type when 'click' then 300 when 'view' then 700 else 1000000000000 end""")
def partial_balance(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    return sampling.limit_some_groups(events, "event_type", "event_id", {"click": 300, "view": 700})


@query("""select event_id, case when ('0x' || substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80
  then 'train' else 'test' end as part from events""")
def hash_split(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    train, test = sampling.hash_split(events, "event_id")
    return stack_frames(
        [train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]
    )


@query("""select event_id, event_type from events
where ('0x' || substr(md5('s' || event_id), 1, 8))::bigint < round(0.01 * 4294967296)""")
def fraction_sample(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    return sampling.hash_fraction(events, "event_id", 0.01, "s")


@query("select event_id, 1::bigint as times from events")
def random_split(spark, folder):
    """Spark's own split depends on the layout; every row must be in one part, once."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    both = stack_frames(list(sampling.random_split(events, 0.8, 24)))
    return both.groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))

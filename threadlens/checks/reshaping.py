"""Indicator tables, wide and long, and files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.checks.registry import big, query, rounded, table
from threadlens.functions.timeparts import month_name
from threadlens.operators import reshape
from threadlens.operators.corpus import word_counts
from threadlens.session import new_path
from threadlens.sources import indicators, tables

YEARS = ["1996", "1997"]


def monthly_values(spark, folder, value):
    """(Year, Month, value): mean order price per month, all as text."""
    orders = table(spark, folder, "orders")
    mean = F.round(F.avg("o_totalprice"), 2).cast("decimal(18,2)").cast("string")
    return orders.groupBy(
        F.date_format("o_orderdate", "yyyy").alias("Year"), month_name(F.col("o_orderdate")).alias("Month")
    ).agg(mean.alias(value))


def _monthly_sql(name: str, expression: str, source: str = "orders", day: str = "o_orderdate") -> str:
    return f"""{name} as (select strftime({day}, '%Y') as "Year", strftime({day}, '%B') as "Month",
  {expression} as v from {source} group by all)"""


PRICES = _monthly_sql("prices", "round(avg(o_totalprice), 2)")
RATES = _monthly_sql("rates", "round(avg(l_quantity), 4)", "lineitem", "l_shipdate")
STOCK = _monthly_sql("stock", "round(sum(l_extendedprice), 2)", "lineitem", "l_shipdate")


def monthly_rates(spark, folder):
    lines = table(spark, folder, "lineitem")
    day = F.col("l_shipdate")
    mean = F.round(F.avg("l_quantity"), 4).cast("decimal(18,4)").cast("string")
    return lines.groupBy(
        F.date_format(day, "yyyy").alias("Year"), month_name(day).alias("Month")
    ).agg(mean.alias("Unemp_Rate"))


def monthly_stock(spark, folder):
    """Dates like ``Nov 96`` and values like ``16,576.66``."""
    lines = table(spark, folder, "lineitem")
    day = F.trunc("l_shipdate", "month")
    return lines.groupBy(day.alias("day")).agg(
        F.format_number(F.round(F.sum("l_extendedprice"), 2), 2).alias("DOW")
    ).select(F.date_format("day", "MMM yy").alias("Date"), "DOW")


def write_with_title(df, path, title):
    """A headerless CSV with title lines above the data, like the published tables."""
    spark = df.sparkSession
    tables.local_table(spark, [(line,) for line in title], "line string").write.text(path)
    df.write.mode("append").csv(path, escape='"')
    return path


@query(f"""with {PRICES} select "Year", "Month", v as price from prices""")
def unpivot_months(spark, folder):
    wide = reshape.rows_to_months(monthly_values(spark, folder, "price"), "price")
    long = reshape.months_to_rows(wide, "price").filter(F.col("price").isNotNull())
    return long.withColumns(rounded(2, "price"))


@query("""with m as (select strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as date,
  count(*)::double as orders, count(distinct o_custkey)::double as customers from orders group by all)
select date, 'orders' as variable, orders as value from m
union all select date, 'customers', customers from m""")
def kpi_long(spark, folder):
    day = F.trunc("o_orderdate", "month").cast("string")
    per_month = table(spark, folder, "orders").groupBy(day.alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"),
        F.count_distinct("o_custkey").cast("double").alias("customers"),
    )
    return reshape.metrics_to_rows(per_month, ["date"], ["orders", "customers"])


@query(f"""with {PRICES}, {RATES}, {STOCK}
select prices."Year", prices."Month", prices.v as "CPI", rates.v as "Unemp_Rate", round(stock.v, 2) as "DOW"
from prices join rates on prices."Year" = rates."Year" and prices."Month" = rates."Month"
join stock on prices."Year" = stock."Year" and prices."Month" = stock."Month"
where stock."Year" in ('1996', '1997')""")
def kpi_three_way(spark, folder):
    lines = table(spark, folder, "lineitem")
    stock = lines.groupBy(
        F.date_format("l_shipdate", "yyyy").alias("Year"), month_name(F.col("l_shipdate")).alias("Month")
    ).agg(F.round(F.sum("l_extendedprice"), 2).alias("DOW"))
    joined = indicators.join_indicators(
        monthly_values(spark, folder, "CPI"), monthly_rates(spark, folder), stock, YEARS
    )
    return joined.withColumns(rounded(2, "CPI", "DOW") | rounded(4, "Unemp_Rate"))


@query(f"""with {PRICES}, {RATES}, {STOCK}
select prices."Year"::bigint as "Year", month(strptime(prices."Month", '%B'))::bigint as "Month",
  prices.v as "CPI", rates.v as "Unemp_Rate", round(stock.v, 2) as "DOW"
from prices join rates on prices."Year" = rates."Year" and prices."Month" = rates."Month"
join stock on prices."Year" = stock."Year" and prices."Month" = stock."Month"
where stock."Year" in ('1996', '1997')""")
def preamble_csv(spark, folder):
    title = ["Mean price,,", "Years:,1995 to 2001,", ",,", "Year,Jan,Feb,Mar"]
    cpi = reshape.rows_to_months(monthly_values(spark, folder, "CPI"), "CPI").withColumns(
        {"HALF1": F.lit(None).cast("string"), "HALF2": F.lit(None).cast("string")}
    )
    rates = reshape.rows_to_months(monthly_rates(spark, folder), "Unemp_Rate")
    at = {name: new_path(spark, name) for name in ("cpi", "rates", "stock")}
    write_with_title(cpi, at["cpi"], title)
    write_with_title(rates, at["rates"], title)
    write_with_title(monthly_stock(spark, folder), at["stock"], ["Monthly index 1995-2001,", ","])
    joined = indicators.join_indicators(
        indicators.read_wide_indicator(spark, at["cpi"], "CPI", ["HALF1", "HALF2"]),
        indicators.read_wide_indicator(spark, at["rates"], "Unemp_Rate"),
        indicators.read_long_indicator(spark, at["stock"], "DOW"),
        YEARS,
    )
    return indicators.typed_indicators(joined).withColumns(big("Year", "Month"))


@query("""select lang as label, regexp_replace(text, '\\s+', ' ', 'g') as text, source as subject,
  'speaker ' || (doc_id % 10) as speaker, 'party ' || (doc_id % 3) as political_party,
  case when doc_id % 5 = 0 then 'test' else 'train' end as split from documents""")
def tsv_load(spark, folder):
    docs = table(spark, folder, "documents")
    spaced = F.regexp_replace("text", r"[\t\n\f\r ]+", " ")
    fields = [
        F.col("doc_id").cast("string"),
        F.col("lang"),
        spaced,
        F.col("source"),
        F.concat(F.lit("speaker "), F.col("doc_id") % 10),
        F.lit("job"),
        F.lit("state"),
        F.concat(F.lit("party "), F.col("doc_id") % 3),
        F.lit("rest"),
    ]
    line = docs.select(F.concat_ws("\t", *fields).alias("line"), (F.col("doc_id") % 5 == 0).alias("test"))
    at = {name: new_path(spark, name) for name in ("train", "test")}
    line.filter("not test").select("line").write.text(at["train"])
    line.filter("test").select("line").write.text(at["test"])
    return tables.read_truth_labels(spark, at)


@query("""select o_orderkey::varchar as o_orderkey, o_orderstatus, o_totalprice as o_totalprice,
  o_orderpriority || ', "quoted"' as o_note from orders""")
def csv_roundtrip(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        F.concat("o_orderpriority", F.lit(', "quoted"')).alias("o_note"),
    )
    path = new_path(spark, "csv")
    tables.write_csv(orders, path)
    schema = "o_orderkey string, o_orderstatus string, o_totalprice double, o_note string"
    return tables.read_back_csv(spark, path, schema)


@query("""select o_orderstatus, count(*) as orders, round(avg(o_totalprice), 2) as mean_price
from orders group by o_orderstatus""")
def summary_csv(spark, folder):
    grouped = table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("o_totalprice"), 2).alias("mean_price")
    )
    path = new_path(spark, "summary")
    indexed = grouped.select(F.lit("0").alias("_c0"), "o_orderstatus", "orders", "mean_price")
    tables.write_summary_csv(indexed, path)
    schema = "_c0 string, o_orderstatus string, orders bigint, mean_price double"
    return tables.read_summary_csv(spark, path, schema, saved_index="_c0")


@query("""select o_orderkey, o_totalprice, year(o_orderdate)::bigint as year from orders
where year(o_orderdate) = 1997""")
def parquet_roundtrip(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("year")
    )
    path = new_path(spark, "parquet")
    tables.write_parquet(orders, path, by=["year"])
    schema = "o_orderkey bigint, o_totalprice double, year bigint"
    return tables.read_parquet(spark, path, schema).filter("year = 1997")


@query("""select o_orderkey, name as status_name from orders
join (values ('F', 'filled'), ('O', 'open'), ('P', 'partial')) as names(code, name) on o_orderstatus = code""")
def local_dim(spark, folder):
    names = tables.local_table(spark, [("F", "filled"), ("O", "open"), ("P", "partial")], "code string, status_name string")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("code"))
    return orders.join(names, "code").drop("code")


def bag_of_words(spark, folder):
    """Word counts of all documents, written as JSON lines and read back."""
    path = new_path(spark, "words")
    tables.write_word_counts_json(word_counts(table(spark, folder, "documents"), "text"), path)
    return spark.read.schema("word string, count bigint").json(path)

"""Checked queries: scans, predicates, joins, limits, pivots, reshaping, stats."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators import reshape, select, stats
from docweave.plans.registry import query
from docweave.plans.sql import CONTENT, CONTENT_IDX, SOURCE
from docweave.sources import tables as tb


@query("source_left_join", f"""
select c.id, c.source_id, s.label as source
from {CONTENT} c left join {SOURCE} s on c.source_id = s.id""")
def q_source_left_join(spark, sf):
    return select.with_source(tb.content(spark, sf), tb.source(spark, sf)).select("id", "source_id", "source")


@query("size_filter", f"""
select id, structure_size from {CONTENT} where structure_size > 1000 and structure_size < 100000""")
def q_size_filter(spark, sf):
    return select.filter_size(tb.content(spark, sf), "structure_size", 1000, 100000).select("id", "structure_size")


@query("unindexed_filter", f"""
select id, cast(last_updated as varchar) as last_updated from {CONTENT_IDX} where index_date is null""")
def q_unindexed_filter(spark, sf):
    df = select.filter_unindexed(tb.content(spark, sf, with_index_date=True), "index_date")
    return df.select("id", F.col("last_updated").cast("string").alias("last_updated"))


@query("unindexed_ledger", f"""
select id from {CONTENT} c where not exists (select 1 from labels l where l.doc_id = c.id)""")
def q_unindexed_ledger(spark, sf):
    return select.unindexed_by_ledger(tb.content(spark, sf), tb.ledger(spark, sf)).select("id")


@query("latest_batch", f"""
select id, cast(last_updated as varchar) as last_updated from {CONTENT}
where structure_size > 1000 and structure_size < 100000
order by last_updated desc nulls first, id limit 30""")
def q_latest_batch(spark, sf):
    df = select.filter_size(tb.content(spark, sf), "structure_size", 1000, 100000)
    return select.latest(df, "last_updated", 30, "id").select(
        "id", F.col("last_updated").cast("string").alias("last_updated"))


@query("latest_events", """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_type from events
order by ts desc nulls first, event_id limit 100""")
def q_latest_events(spark, sf):
    ev = tb.table(spark, sf, "events")
    return select.latest(ev, "ts", 100, "event_id").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type")


@query("any_batch", None)
def q_any_batch(spark, sf):
    return select.any_batch(tb.content(spark, sf).select("id", "title"), 3)


@query("any_batch_rows", "select least(count(*), 3) as n, least(count(*), 3) as in_table from documents")
def q_any_batch_rows(spark, sf):
    """L2 checked: whichever rows came, they are as many as asked for and from the table."""
    content = tb.content(spark, sf).select("id", "title")
    batch = select.any_batch(content, 3)
    found = batch.join(content.withColumnRenamed("title", "__t"), "id", "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count("__t").alias("in_table"))


@query("project_columns", f"""
select id, title, uri from {CONTENT} where structure_size > 100 and structure_size < 100000""")
def q_project_columns(spark, sf):
    df = select.filter_size(tb.content(spark, sf), "structure_size", 100, 100000)
    return select.project_columns(df, ["id", "title", "uri"])


@query("lines_containing", """
select doc_id, cast(i - 1 as integer) as line_no, line from (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
where contains(line, 'the')""")
def q_lines_containing(spark, sf):
    docs = tb.table(spark, sf, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return select.lines_containing(lines, "the", "line").select(
        "doc_id", F.col("line_no").cast("int").alias("line_no"), "line")


@query("run_stamp", f"""
select id, '2024-03-16 21:26:56' as timestamp from {CONTENT}""")
def q_run_stamp(spark, sf):
    df = select.stamp(tb.content(spark, sf).select("id"), "2024-03-16 21:26:56")
    return df.select("id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


@query("row_count", f"""
select count(*) as n from {CONTENT} where structure_size > 1000 and structure_size < 100000""")
def q_row_count(spark, sf):
    df = select.filter_size(tb.content(spark, sf), "structure_size", 1000, 100000)
    return df.agg(F.count(F.lit(1)).alias("n"))


# Pivot with default: one row per customer, one column per order status.
_PIVOT_SQL = """
select o_custkey,
  coalesce(min_by({v}, o_orderkey) filter (where o_orderstatus = 'F'), {d}) as "F",
  coalesce(min_by({v}, o_orderkey) filter (where o_orderstatus = 'O'), {d}) as "O",
  coalesce(min_by({v}, o_orderkey) filter (where o_orderstatus = 'P'), {d}) as "P"
from orders group by o_custkey"""


@query("pivot_default", _PIVOT_SQL.format(v="o_orderpriority", d="'pending'"))
def q_pivot_default(spark, sf):
    return reshape.pivot_default(tb.table(spark, sf, "orders"), "o_custkey", "o_orderstatus",
                                 "o_orderpriority", "pending", ["F", "O", "P"], order="o_orderkey")


@query("pivot_default_numeric", _PIVOT_SQL.format(v="o_totalprice", d="0.0"))
def q_pivot_default_numeric(spark, sf):
    return reshape.pivot_default(tb.table(spark, sf, "orders"), "o_custkey", "o_orderstatus",
                                 "o_totalprice", 0.0, ["F", "O", "P"], order="o_orderkey")


# Two integer arrays per embedding row (no grouping: every row carries its own
# arrays): the vector in hundredths, and its positive entries (shorter,
# sometimes empty).
_ARRAYS_SQL = """
(select vec_id,
   list_transform(embedding, lambda x: cast(floor(x * 100) as bigint)) as varA,
   list_filter(list_transform(embedding, lambda x: cast(floor(x * 100) as bigint)), lambda v: v > 0) as varB
 from embeddings)"""


def _row_arrays(spark, sf):
    e = tb.table(spark, sf, "embeddings")
    a = F.transform("embedding", lambda x: F.floor(x * 100).cast("bigint"))
    return e.select("vec_id", a.alias("varA")).withColumn("varB", F.filter("varA", lambda v: v > 0))


@query("zip_rows", f"""
select vec_id, cast(i - 1 as integer) as i, z[1] as varA, z[2] as varB from (
  select vec_id, unnest(list_zip(varA, varB)) as z, generate_subscripts(list_zip(varA, varB), 1) as i
  from {_ARRAYS_SQL})""")
def q_zip_rows(spark, sf):
    return reshape.zip_rows(_row_arrays(spark, sf), ["vec_id"], ["varA", "varB"])


@query("flat_map_rows", f"""
select vec_id, cast(i - 1 as bigint) as i, varA[i] as a, varA[i] + coalesce(varB[1], 0) as b from (
  select vec_id, varA, varB, generate_subscripts(varA, 1) as i from {_ARRAYS_SQL})""")
def q_flat_map_rows(spark, sf):
    arr = _row_arrays(spark, sf).select(
        "vec_id", "varA",
        F.transform("varA", lambda x: x + F.coalesce(F.get(F.col("varB"), 0), F.lit(0))).alias("varB"))
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("i", T.LongType()),
                           T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return reshape.flat_map(arr, lambda pdf: reshape.pairwise(pdf, "vec_id", "varA", "varB")
                            .rename(columns={"varA": "a", "varB": "b"}), schema)


@query("checksum", """
select doc_id, sha256(text) as sha256, md5(text) as md5, sha1(text) as sha1 from documents""")
def q_checksum(spark, sf):
    docs = tb.table(spark, sf, "documents")
    df = stats.with_checksum(docs, "text", "SHA-256", "sha256")
    df = stats.with_checksum(df, "text", "MD5", "md5")
    df = stats.with_checksum(df, "text", "SHA-1", "sha1")
    return df.select("doc_id", "sha256", "md5", "sha1")


@query("pi_lattice", """
select count(*) as samples,
  4.0 * sum(case when x * x + y * y <= 1.0 then 1 else 0 end) / count(*) as pi
from (select ((k * 1621087444) % 2147483647 + 0.5) / 2147483647 as x,
             ((k * 1223722706) % 2147483647 + 0.5) / 2147483647 as y
      from (select o_orderkey % 2147483647 as k from orders))""")
def q_pi_lattice(spark, sf):
    return stats.pi_from_keys(tb.table(spark, sf, "orders"), "o_orderkey")


@query("partition_spread", None)
def q_partition_spread(spark, sf):
    return stats.partition_sizes(stats.spread(tb.table(spark, sf, "documents").select("doc_id"),
                                              spark.sparkContext.defaultParallelism, "doc_id"))


@query("partition_totals", "select count(*) as n, true as all_named from documents")
def q_partition_totals(spark, sf):
    """F14 checked: the partitions hold every row once, numbered below their count."""
    n = spark.sparkContext.defaultParallelism
    sizes = stats.partition_sizes(stats.spread(tb.table(spark, sf, "documents").select("doc_id"), n, "doc_id"))
    return sizes.agg(F.sum("rows").alias("n"), (F.max("partition") < n).alias("all_named"))


@query("regroup_lines", """
select doc_id, string_agg(line, ' ' order by i) as text from (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
group by doc_id""")
def q_regroup_lines(spark, sf):
    docs = tb.table(spark, sf, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return reshape.regroup(lines, "doc_id", "line", " ", "pos", "text")

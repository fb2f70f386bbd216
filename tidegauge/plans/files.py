"""Scans, slices and sinks. Files a query writes go to a fresh folder and are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import stats
from ..sources import tables as files
from .enrichment import MARKED_DAYS
from .registry import Tables, query


@query("s1_parquet_scan", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-09-02' GROUP BY ALL")
def s1_parquet_scan(t: Tables) -> DataFrame:
    """Filter and columns reach the Parquet reader."""
    return t.lineitem.filter(F.col("l_shipdate") < F.lit("1998-09-02").cast("timestamp_ntz")).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"))


def customer_csv(t: Tables) -> str:
    path = t.scratch("customer")
    t.customer.select("c_custkey", "c_name", "c_nationkey").write.option("header", True).csv(path)
    return path


@query("s2_csv_text_scan", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def s2_csv_text_scan(t: Tables) -> DataFrame:
    return files.read_csv(t.spark, customer_csv(t))


@query("s3_csv_inferred_scan", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey FROM customer")
def s3_csv_inferred_scan(t: Tables) -> DataFrame:
    return files.read_csv(t.spark, customer_csv(t), infer=True)


FLAT = "regexp_replace(text, '[\\r\\n]+', ' ', 'g')"


def flat_documents(t: Tables) -> DataFrame:
    """One line per document: number, tab, text without line breaks."""
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), F.regexp_replace("text", "[\r\n]+", " "))
    return t.documents.select(line.alias("value"))


@query("s4_text_line_scan", f"SELECT doc_id, length({FLAT}) AS n_chars, md5({FLAT}) AS digest FROM documents")
def s4_text_line_scan(t: Tables) -> DataFrame:
    """A folder of gzip text lines, split into number and text."""
    path = t.scratch("lines")
    flat_documents(t).write.option("compression", "gzip").text(path)
    parts = F.split("value", "\t", 2)
    rows = files.read_lines(t.spark, path).select(parts[0].cast("long").alias("doc_id"), parts[1].alias("line"))
    return rows.select("doc_id", F.length("line").cast("long").alias("n_chars"), F.md5("line").alias("digest"))


@query("s5_delimited_scan", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, 1 AS kind FROM lineitem")
def s5_delimited_scan(t: Tables) -> DataFrame:
    path = t.scratch("delimited")
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    t.lineitem.select(*cols).write.option("header", True).option("sep", ";").csv(path)
    return files.read_delimited(t.spark, path, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double", "kind", 1)


@query("s6_rows_to_table", f"SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS day, count(o_orderkey) AS n FROM (SELECT unnest({list(MARKED_DAYS)}) AS d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY d")
def s6_rows_to_table(t: Tables) -> DataFrame:
    """A configuration list as a table, joined to the orders of those days."""
    marks = files.from_rows(t.spark, [(d,) for d in MARKED_DAYS], "day string")
    per_day = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return marks.join(per_day, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("s7_named_slices", "\nUNION ALL ".join(
    f"SELECT '{n}' AS slice, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate >= TIMESTAMP '{a}' AND o_orderdate < TIMESTAMP '{b}'"
    for n, (a, b) in files.SLICES.items()))
def s7_named_slices(t: Tables) -> DataFrame:
    out = None
    for name in files.SLICES:
        row = files.slice_rows(t.orders, "o_orderdate", name).agg(
            F.lit(name).alias("slice"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        out = row if out is None else out.unionByName(row)
    return out


@query("s7_end_date_cut", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) < 1998 OR (year(o_orderdate) = 1998 AND month(o_orderdate) <= 5)")
def s7_end_date_cut(t: Tables) -> DataFrame:
    return files.up_to_month(t.orders, F.year("o_orderdate"), F.month("o_orderdate"), 1998, 5).select("o_orderkey")


@query("s8_year_extract", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1999")
def s8_year_extract(t: Tables) -> DataFrame:
    return files.write_year(t.orders, F.year("o_orderdate"), 1999, t.scratch("orders_1999")).select("o_orderkey", "o_totalprice")


@query("s9_partitioned_sink", "SELECT o_orderkey, o_totalprice, year(o_orderdate) AS year FROM orders")
def s9_partitioned_sink(t: Tables) -> DataFrame:
    path = t.scratch("orders_by_year")
    files.write_table(files.balanced(t.orders.withColumn("year", F.year("o_orderdate").cast("long")), "year"), path, ["year"])
    return files.read_table(t.spark, path).select("o_orderkey", "o_totalprice", F.col("year").cast("long").alias("year"))


@query("s10_write_and_reread", "SELECT count(*) AS n_written, count(*) AS n_read, round(sum(o_totalprice), 2) AS total FROM orders")
def s10_write_and_reread(t: Tables) -> DataFrame:
    stage = files.write_stage(t.orders, t.scratch("stage"))
    written = t.orders.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stage.agg(F.count(F.lit(1)).alias("n_read"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("n_written", written)


@query("s11_text_sink", "SELECT count(*) AS n_lines, 4 AS n_files FROM documents")
def s11_text_sink(t: Tables) -> DataFrame:
    path = t.scratch("documents_text")
    files.write_lines(flat_documents(t), path, 4)
    return files.read_lines(t.spark, path).select(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("f").cast("int").alias("n_files"))


@query("s12_balanced_write", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY l_returnflag")
def s12_balanced_write(t: Tables) -> DataFrame:
    stage = files.write_stage(files.balanced(t.lineitem, "l_returnflag"), t.scratch("balanced"))
    return stage.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


REPORT = "SELECT o_orderstatus, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 6) AS share_pct FROM orders GROUP BY o_orderstatus"


@query("s14_csv_report", REPORT)
def s14_csv_report(t: Tables) -> DataFrame:
    path = t.scratch("report_csv")
    files.export_report(stats.shares(t.orders, ["o_orderstatus"]), path)
    return files.read_csv(t.spark, path, schema="o_orderstatus string, n long, share_pct double")


@query("s14_json_report", REPORT)
def s14_json_report(t: Tables) -> DataFrame:
    path = t.scratch("report_json")
    files.export_report(stats.shares(t.orders, ["o_orderstatus"]), path, "json")
    return t.spark.read.schema("o_orderstatus string, n long, share_pct double").json(path)


@query("s15_run_summary", 'SELECT count(*) AS n_rows, 6 AS n_columns, min(o_orderdate) AS "first", max(o_orderdate) AS "last" FROM orders')
def s15_run_summary(t: Tables) -> DataFrame:
    return stats.run_summary(t.orders, "o_orderdate")

"""Registered file-source and file-sink queries: CSV inputs with inferred types (S1, S2), result
files in each format read back (K1, K2), and the stamped feed (Q11)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.messages import envelope_json, stamp_feed_lines
from kestrel.operators.partitioning import spread_for_cpu
from kestrel.plans.batch_jobs import count_by_group_job, mean_by_entity_job
from kestrel.plans.catalog_tables import ORACLE as TABLE_ORACLE, facts, q_mean_by_entity, segments, suppliers
from kestrel.plans.tables import table, text_table
from kestrel.plans.text_queries import doc_rules
from kestrel.session import shared_path
from kestrel.sinks.files import write_files
from kestrel.sources.files import ordered_lines, read_json_lines

FORMATS = ("json", "csv", "parquet", "orc")


def roundtrip(fmt: str):
    def run(spark: SparkSession, sf_dir: str):
        result = q_mean_by_entity(spark, sf_dir)
        path = shared_path(spark, f"result-{fmt}")
        write_files(result, path, fmt)
        reader = spark.read.format(fmt).schema(result.schema)
        if fmt == "csv":
            reader = reader.option("header", "true")
        return reader.load(path)
    run.__name__ = f"q_file_sink_roundtrip_{fmt}"
    return run


def q_csv_mean_by_entity(spark, sf_dir):
    """Q3 as the job runs it: a directory of CSV files with headers, types inferred."""
    base = shared_path(spark, "csv-dataset")
    # Many CSV files, as a large input would have; the one-row-group test table would give one.
    write_files(spread_for_cpu(facts(spark, sf_dir)), f"{base}/lineitem.csv", "csv")
    write_files(suppliers(spark, sf_dir), f"{base}/supplier.csv", "csv")
    result, _ = mean_by_entity_job(spark, base, facts_name="lineitem.csv", dim_name="supplier.csv",
                                   key="l_suppkey", measure="qty", dim_key="s_suppkey", dim_label="s_name",
                                   name_col="entity_name", count_col="entity_count",
                                   mean_text_col="avg_measure_fmt")
    return result


def q_csv_count_by_group(spark, sf_dir):
    """Q1 as the job runs it: CSV in, ranked counts out as JSON files, read back."""
    base = shared_path(spark, "csv-segments")
    write_files(segments(spark, sf_dir), f"{base}/customers.csv", "csv")
    out = f"{base}/counts"
    count_by_group_job(spark, f"{base}/customers.csv", out, "json", key="segment", count_name="n_customers")
    return spark.read.schema("segment string, n_customers bigint").json(out)


FIXED_STAMP = "2024-01-01T09:00:00.000+09:00"


def odd_feed_line(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, head): feed lines without their last brace, with what a parser would alter: a 48-digit
    number, a long decimal, a repeated member and blanks."""
    line = envelope_json(F.col("doc_id"), F.col("text"), None, doc_rules())
    odd = F.concat(F.lit('{ "n" : 123456789012345678901234567890123456789012345678, "d":0.12345678901234567890,"x":1,"x" : 2.50,'),
                   F.substring(line, 2, 1 << 30))
    return docs.select("doc_id", "lang", F.rtrim(odd, F.lit("}")).alias("head"))


def q_feed_enrichment(spark, sf_dir):
    """JSON lines (with blank keep-alive lines) → stamped, keyed records whose other members are
    as they were, to the character; the stamp is fixed here so the output can be checked."""
    docs = odd_feed_line(text_table(spark, sf_dir, "documents"))
    line = F.concat("head", F.when(F.col("lang") == "de", ', "ts": {"old" : [1,2]} , "z":null}').otherwise(" }"))
    lines = docs.select(F.explode(F.when(F.col("lang") == "fr", F.array(line, F.lit(" ")))
                                  .otherwise(F.array(line))).alias("value"))
    path = shared_path(spark, "raw-feed")
    lines.write.text(path)
    return stamp_feed_lines(read_json_lines(spark, path), F.lit(FIXED_STAMP)).select("key", "value")


def q_arrival_stamps(spark, sf_dir):
    """Every record of the feed gets its arrival time; checked by its laws, since it differs in each run:
    it parses, it has milliseconds and an offset, it lies within this query's run, and all records of a
    query have the same one."""
    docs = text_table(spark, sf_dir, "documents")
    records = stamp_feed_lines(docs.select(envelope_json(F.col("doc_id"), F.col("text")).alias("value")))
    began = F.lit(datetime.now(timezone.utc))
    stamped = records.select("key", F.get_json_object("value", "$.ts").alias("ts"))
    instant = F.try_to_timestamp("ts")
    # the time of the query, taken in the same plan, is the same instant cut to milliseconds
    return stamped.select("key", F.col("ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}(Z|[+-]\d\d:\d\d)$").alias("has_offset"),
                          (instant == F.date_trunc("millisecond", F.current_timestamp())).alias("one_instant"),
                          (instant >= F.date_trunc("millisecond", began)).alias("after_start"))


def q_ordered_file_lines(spark, sf_dir):
    """K2, O1: ranked counts as one ordered file of JSON lines, read back with each line's place."""
    base = shared_path(spark, "ordered")
    write_files(segments(spark, sf_dir), f"{base}/customers.csv", "csv")
    count_by_group_job(spark, f"{base}/customers.csv", f"{base}/counts", "json", key="segment", count_name="n_customers", single_file=True)
    return ordered_lines(spark, f"{base}/counts")


def q_ordered_part_lines(spark, sf_dir):
    """All orders sorted over many files (price downwards, then key), read back with each line's place
    in the whole."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    ranked = orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").select(F.col("o_orderkey").cast("string"))
    path = shared_path(spark, "ordered-parts")
    ranked.write.text(path)
    return ordered_lines(spark, path)


def q_object_store_path(spark, sf_dir):
    """S3: a table under a path with an explicit file-system scheme (here that of the local one)."""
    path = f"{sf_dir.rstrip('/')}/nation.parquet"
    return spark.read.parquet(path if "://" in path else f"file://{path}").select("n_nationkey", "n_name", "n_regionkey")


QUERIES = {f"file_sink_roundtrip_{fmt}": roundtrip(fmt) for fmt in FORMATS}
QUERIES.update({
    "csv_mean_by_entity": q_csv_mean_by_entity,
    "csv_count_by_group": q_csv_count_by_group,
    "feed_enrichment": q_feed_enrichment,
    "arrival_stamps": q_arrival_stamps,
    "ordered_file_lines": q_ordered_file_lines,
    "ordered_part_lines": q_ordered_part_lines,
    "object_store_path": q_object_store_path,
})

ORACLE = {f"file_sink_roundtrip_{fmt}": TABLE_ORACLE["mean_by_entity"] for fmt in FORMATS}
ORACLE.update({
    "csv_mean_by_entity": TABLE_ORACLE["mean_by_entity"],
    "csv_count_by_group": TABLE_ORACLE["count_by_group_ranked"],
    "feed_enrichment": f"""
        SELECT CAST(doc_id AS VARCHAR) AS key,
               '{{ "n" : 123456789012345678901234567890123456789012345678, "d":0.12345678901234567890,"x":1,"x" : 2.50,'
               || '"data":{{"id":"' || doc_id || '","text":' || CAST(to_json(text) AS VARCHAR)
               || '}},"matching_rules":[{{"id":"' || source || '","tag":"' || lang || '"}}]'
               || CASE WHEN lang = 'de' THEN ', "ts": "{FIXED_STAMP}" , "z":null}}' ELSE ' ,"ts":"{FIXED_STAMP}"}}' END AS value
        FROM documents""",
    "arrival_stamps": "SELECT CAST(doc_id AS VARCHAR) AS key, true AS has_offset, true AS one_instant, true AS after_start FROM documents",
    "ordered_file_lines": """
        SELECT row_number() OVER (ORDER BY n DESC, segment) - 1 AS position,
               '{"segment":"' || segment || '","n_customers":' || n || '}' AS line
        FROM (SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY ALL)""",
    "ordered_part_lines": """
        SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position, CAST(o_orderkey AS VARCHAR) AS line
        FROM orders""",
    "object_store_path": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
})

import glob
import os

import pytest
from pyspark.sql import functions as F

from kestrel.operators.ordering import one_sorted_partition, rank_by_count
from kestrel.plans.batch_jobs import count_by_group_job, mean_by_entity_job
from kestrel.sinks.files import write_files
from kestrel.sources.files import read_csv, read_json_lines


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet", "orc"])
def test_sorted_output_reads_back_in_order(spark, scratch, fmt):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id"))
    ranked = rank_by_count(df.groupBy("k").agg(F.count("k").alias("n")), "n", "k")
    path = os.path.join(scratch, fmt)
    write_files(ranked, path, fmt)
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    back = []
    for part in parts:
        reader = spark.read.format(fmt).schema(ranked.schema)
        if fmt == "csv":
            reader = reader.option("header", "true")
        back += [tuple(r) for r in reader.load(part).collect()]
    assert back == [tuple(r) for r in ranked.collect()]


def test_one_sorted_partition_writes_one_file(spark, scratch):
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("k"))
    counts = df.groupBy("k").agg(F.count("k").alias("n"))
    out = one_sorted_partition(counts, F.col("n").desc(), F.col("k"))
    write_files(out, os.path.join(scratch, "one"), "json")
    assert len(glob.glob(os.path.join(scratch, "one", "part-*"))) == 1


def test_csv_jobs_with_inferred_types(spark, scratch):
    with open(os.path.join(scratch, "airports.csv"), "w") as f:
        f.write("IATA,STATE,CITY\nA1,TX,x\nA2,TX,y\nA3,CA,z\nA4,AK,w\nA5,,v\n")
    res = count_by_group_job(spark, os.path.join(scratch, "airports.csv"), os.path.join(scratch, "out"), "json")
    assert [tuple(r) for r in res.collect()] == [("TX", 2), ("AK", 1), ("CA", 1), (None, 0)]
    assert glob.glob(os.path.join(scratch, "out", "part-*"))

    os.makedirs(os.path.join(scratch, "d"))
    with open(os.path.join(scratch, "d", "airlines.csv"), "w") as f:
        f.write("IATA_CODE,AIRLINE\nAA,American Airlines Inc.\nUA,United Air Lines Inc.\n")
    with open(os.path.join(scratch, "d", "flights.csv"), "w") as f:
        f.write("AIRLINE,ARRIVAL_DELAY,OTHER\nAA,5,1\nAA,-3,1\nAA,,1\nUA,10,1\nZZ,1,1\n")
    result, (lines, total) = mean_by_entity_job(spark, os.path.join(scratch, "d"), os.path.join(scratch, "o"),
                                                show_summary=True)
    assert result.columns == ["AIRLINE_NAME", "FLIGHTS_COUNT", "AVG_ARRIVAL_DELAY_BY_MINUTES"]
    assert [tuple(r) for r in result.collect()] == [("American Airlines Inc.", 3, "1.00"), (None, 1, "1.00"),
                                                    ("United Air Lines Inc.", 1, "10.00")]
    assert total.collect()[0]["total_line"] == "Total 5 flights."
    assert lines.count() == 3
    assert os.path.isdir(os.path.join(scratch, "o", "avg_arrival_delay_by_airline"))


def test_csv_with_explicit_schema_reads_once(spark, scratch):
    path = os.path.join(scratch, "x.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    df = read_csv(spark, path, schema="a long, b string")
    assert df.schema.simpleString() == "struct<a:bigint,b:string>" and df.count() == 2


def test_json_lines_skip_blank(spark, scratch):
    path = os.path.join(scratch, "feed.txt")
    with open(path, "w") as f:
        f.write('{"a":1}\n\n   \n{"a":2}\n')
    assert read_json_lines(spark, path).count() == 2


def test_cli_jobs(spark, scratch, capsys):
    from kestrel import cli

    os.makedirs(os.path.join(scratch, "d"))
    with open(os.path.join(scratch, "d", "airlines.csv"), "w") as f:
        f.write("IATA_CODE,AIRLINE\nAA,American Airlines Inc.\nUA,United Air Lines Inc.\n")
    with open(os.path.join(scratch, "d", "flights.csv"), "w") as f:
        f.write("AIRLINE,ARRIVAL_DELAY\nAA,5\nAA,-3\nUA,10\n")
    cli.main(["mean-by-entity", "--input_dir", os.path.join(scratch, "d"), "--output_dir",
              os.path.join(scratch, "o"), "--show_summary"])
    out = capsys.readouterr().out
    assert "Total 3 flights." in out and "mean-by-entity took" in out
    written = glob.glob(os.path.join(scratch, "o", "avg_arrival_delay_by_airline_summary", "part-*"))
    assert sum(len(open(p).readlines()) for p in written) == 2
    assert f"{'United Air Lines Inc.':32} {1:10d} {'10.00':>8}" in out
    cli.main(["--sampling-ratio", "0.5", "mean-by-entity-sql", "--input_dir", os.path.join(scratch, "d")])
    out = capsys.readouterr().out
    assert "AVG_ARRIVAL_DELAY" in out and "American Airlin" in out and "10.0" in out
    with open(os.path.join(scratch, "airports.csv"), "w") as f:
        f.write("IATA,STATE\nA1,TX\nA2,TX\nA3,CA\n")
    cli.main(["count-by-group", "--input_file", os.path.join(scratch, "airports.csv"), "--output_file",
              os.path.join(scratch, "c"), "--single_file", "--output_format", "csv"])
    parts = glob.glob(os.path.join(scratch, "c", "part-*"))
    assert len(parts) == 1 and open(parts[0]).read().splitlines() == ["STATE,COUNT", "TX,2", "CA,1"]


def test_dataset_directory_preview_and_order(spark, scratch):
    from kestrel.operators.ordering import ordered
    from kestrel.sinks.files import preview
    from kestrel.sources.files import read_table, table_path

    assert table_path("/d/", "airlines", "csv") == "/d/airlines.csv"
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    write_files(df, table_path(scratch, "t", "parquet"), "parquet")
    back = read_table(spark, scratch, "t")
    assert [r["k"] for r in ordered(back, "k").collect()] == [1, 2, 3]
    assert preview(ordered(back, F.col("k").desc()), 2).count() == 2


def test_partitioned_jdbc_read_needs_bounds(spark):
    import pytest

    from kestrel.sources.jdbc import read_jdbc

    with pytest.raises(ValueError, match="lower_bound"):
        read_jdbc(spark, "jdbc:none", "T", partition_column="id", num_partitions=8)


def test_sasl_options():
    from kestrel.sinks.kafka import sasl_plain_options

    opts = sasl_plain_options("u", "p")
    assert opts["kafka.security.protocol"] == "SASL_SSL" and opts["kafka.sasl.mechanism"] == "PLAIN"
    tricky = sasl_plain_options('a"b', "c\\d")["kafka.sasl.jaas.config"]
    assert 'username="a\\"b"' in tricky and 'password="c\\\\d"' in tricky
    assert 'username="u"' in opts["kafka.sasl.jaas.config"] and 'password="p"' in opts["kafka.sasl.jaas.config"]


def test_kafka_commands_take_a_sasl_user():
    from kestrel.cli import _sasl_options, parser

    args = parser().parse_args(["publish-feed", "--input", "x", "--topic", "t", "--sasl-username", "u", "--sasl-password", "p"])
    assert _sasl_options(args)["kafka.security.protocol"] == "SASL_SSL"
    args = parser().parse_args(["keyword-stream", "--topic", "t", "--checkpoint-location", "c", "--url", "u", "--table", "T"])
    assert _sasl_options(args) == {}


def test_mean_job_writes_one_ordered_file(spark, scratch):
    spark.range(1000).select((F.col("id") % 50).alias("AIRLINE"), F.col("id").alias("ARRIVAL_DELAY")).write.csv(
        os.path.join(scratch, "flights.csv"), header=True)
    spark.range(50).select(F.col("id").alias("IATA_CODE"), F.concat(F.lit("a"), "id").alias("AIRLINE")).write.csv(
        os.path.join(scratch, "airlines.csv"), header=True)
    result, _ = mean_by_entity_job(spark, scratch, os.path.join(scratch, "o"), "csv", single_file=True)
    parts = glob.glob(os.path.join(scratch, "o", "avg_arrival_delay_by_airline", "part-*"))
    assert len(parts) == 1
    assert [line.split(",")[0] for line in open(parts[0]).read().splitlines()[1:]] == [r[0] for r in result.collect()]


def test_sql_mean_of_large_integers_and_odd_names(spark):
    from kestrel.plans.batch_jobs import mean_by_entity_sql

    facts = spark.createDataFrame([(1, 2**62)] * 3, "`the key` long, `a measure` long")
    dim = spark.createDataFrame([(1, "x")], "id long, `full name` string")
    row = mean_by_entity_sql(spark, facts, dim, "the key", "a measure", "id", "full name").collect()
    assert [tuple(r) for r in row] == [("x", 3, float(2**62))]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("facts_", "dim_"))]

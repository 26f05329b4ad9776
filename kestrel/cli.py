"""Command-line entry for the jobs, for ``spark-submit``:

    spark-submit kestrel/cli.py count-by-group --input_file airports.csv --output_file out [--output_format json]
    spark-submit kestrel/cli.py count-by-group-to-db --input_file airports.csv --url jdbc:... --table NUM_AIRPORTS
    spark-submit kestrel/cli.py mean-by-entity --input_dir data --output_dir out [--show_summary]
    spark-submit kestrel/cli.py mean-by-entity-sql --input_dir data
    spark-submit kestrel/cli.py keyword-stream --bootstrap-servers host:9092 --topic t --checkpoint-location s3a://... \\
        --url jdbc:... --table KEYWORDS
    spark-submit kestrel/cli.py publish-feed --input path --bootstrap-servers host:9092 --topic t

Database user and password come from ``--user`` / ``--password`` or the ``DB_USER`` /
``DB_PASSWORD`` environment variables; ``--driver`` names the JDBC driver class. Each job prints
its wall time. Summaries print a named number of lines as a preview, and the total; with an output
folder all their lines are written there, in order.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _db_properties(args) -> dict:
    props = {"user": args.user or os.environ.get("DB_USER", ""),
             "password": args.password or os.environ.get("DB_PASSWORD", "")}
    if args.driver:
        props["driver"] = args.driver
    return props


def _add_db(p):
    p.add_argument("--url", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--user")
    p.add_argument("--password")
    p.add_argument("--driver")


def _add_sasl(p):
    p.add_argument("--sasl-username", help="user of a SASL_SSL broker (or KAFKA_USERNAME)")
    p.add_argument("--sasl-password", help="its password (or KAFKA_PASSWORD)")


def _sasl_options(args) -> dict:
    """Connection options of a SASL_SSL broker, if a user is given; else none."""
    from kestrel.sinks.kafka import sasl_plain_options

    user = args.sasl_username or os.environ.get("KAFKA_USERNAME")
    if not user:
        return {}
    return sasl_plain_options(user, args.sasl_password or os.environ.get("KAFKA_PASSWORD", ""))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="kestrel")
    ap.add_argument("--sampling-ratio", type=float,
                    help="infer CSV types from this fraction of the rows instead of a full pass")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("count-by-group", help="rows per group, most frequent first, to files")
    p.add_argument("--input_file", required=True)
    p.add_argument("--output_file", required=True)
    p.add_argument("--output_format", default="json")
    p.add_argument("--key", default="STATE")
    p.add_argument("--single_file", action="store_true")
    p.add_argument("--show_summary", action="store_true")

    p = sub.add_parser("count-by-group-to-db", help="rows per group replacing the rows of a table")
    p.add_argument("--input_file", required=True)
    p.add_argument("--key", default="STATE")
    p.add_argument("--num-partitions", type=int, help="at most this many database connections write")
    p.add_argument("--show_summary", action="store_true")
    _add_db(p)

    for name in ("mean-by-entity", "mean-by-entity-sql"):
        p = sub.add_parser(name, help="rows and mean measure per entity with its name")
        p.add_argument("--input_dir", required=True)
        p.add_argument("--output_dir")
        p.add_argument("--output_format", default="json")
        p.add_argument("--single_file", action="store_true", help="one ordered file; for few entities")
        p.add_argument("--show_summary", action="store_true", help="write all summary lines beside the output and print a preview; without an output folder print them all")
        p.add_argument("--preview_rows", type=int, default=20)

    p = sub.add_parser("keyword-stream", help="keyword counts per window from a topic into a table")
    p.add_argument("--bootstrap-servers", default="localhost:9092")
    p.add_argument("--topic", required=True)
    p.add_argument("--window", default="30 seconds")
    p.add_argument("--watermark", default="30 seconds")
    p.add_argument("--num-output-rows", type=int, default=128)
    p.add_argument("--checkpoint-location", required=True)
    p.add_argument("--rejects-path")
    p.add_argument("--max-offsets-per-trigger", type=int, help="bound the records of one micro-batch")
    p.add_argument("--min-partitions", type=int, help="split topic partitions over at least this many tasks")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--no-console", action="store_true", help="skip the text preview query")
    p.add_argument("--lexicon", help="table of (surface, pos, base_form) for the part-of-speech rules")
    p.add_argument("--lexicon-format", default="parquet")
    p.add_argument("--pos-mode", default="subclass", choices=["subclass", "level1"])
    p.add_argument("--hot-words", nargs="*", help="words so frequent that their lexicon lookup is spread over tasks")
    p.add_argument("--sink-partitions", type=int, help="at most this many database connections write a batch")
    _add_sasl(p)
    _add_db(p)

    p = sub.add_parser("keyword-report", help="a report over the keyword table that keyword-stream fills")
    p.add_argument("--report", default="latest", choices=["latest", "span", "top"])
    p.add_argument("--rows", type=int, default=100)
    _add_db(p)

    p = sub.add_parser("publish-feed", help="stamp JSON lines and publish them keyed by id")
    p.add_argument("--input", required=True)
    p.add_argument("--bootstrap-servers", default="localhost:9092")
    p.add_argument("--topic", required=True)
    p.add_argument("--stream-checkpoint", help="follow new files as a stream with this checkpoint")
    p.add_argument("--rejects-path", help="where lines that are not JSON objects go (batch form)")
    _add_sasl(p)
    return ap


def run(args) -> None:
    from kestrel.plans import batch_jobs
    from kestrel.session import ensure_utc, get_session

    spark = get_session(app_name=f"kestrel-{args.job}")
    ensure_utc(spark)
    csv_options = {"samplingRatio": str(args.sampling_ratio)} if args.sampling_ratio else None
    if args.job == "count-by-group":
        result = batch_jobs.count_by_group_job(spark, args.input_file, args.output_file, args.output_format,
                                               key=args.key, single_file=args.single_file,
                                               csv_options=csv_options)
        if args.show_summary:
            result.show()
    elif args.job == "count-by-group-to-db":
        result = batch_jobs.count_by_group_to_db(spark, args.input_file, args.url, args.table,
                                                 _db_properties(args), key=args.key,
                                                 num_partitions=args.num_partitions, csv_options=csv_options)
        if args.show_summary:
            result.show()
    elif args.job == "mean-by-entity":
        result, summary = batch_jobs.mean_by_entity_job(spark, args.input_dir, args.output_dir, args.output_format,
                                                        show_summary=args.show_summary, csv_options=csv_options,
                                                        single_file=args.single_file)
        if summary is not None:
            lines, total = summary
            if args.output_dir:
                where = f"{args.output_dir.rstrip('/')}/avg_arrival_delay_by_airline_summary"
                print(f"First {args.preview_rows} lines of the summary, all of them in {where}:")
                lines.show(args.preview_rows, truncate=False)
            else:  # the whole report, a partition at a time
                for row in lines.toLocalIterator():
                    print(row["line"])
            total.select("total_line").show(truncate=False)
    elif args.job == "mean-by-entity-sql":
        from kestrel.sources.files import read_csv

        base = args.input_dir.rstrip("/")
        dim = read_csv(spark, f"{base}/airlines.csv", **(csv_options or {}))
        facts = read_csv(spark, f"{base}/flights.csv", **(csv_options or {}))
        result = batch_jobs.mean_by_entity_sql(spark, facts, dim, "AIRLINE",
                                               "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE", "FLIGHTS", "AIRLINES",
                                               "AIRLINE_NAME", "FLIGHTS_COUNT", "AVG_ARRIVAL_DELAY")
        if args.output_dir:
            from kestrel.sinks.files import write_files
            write_files(result, f"{args.output_dir.rstrip('/')}/avg_arrival_delay_by_airline", args.output_format)
        result.show()
    elif args.job == "keyword-stream":
        from kestrel.streaming.jobs import run_keyword_job
        from kestrel.streaming.sinks import JdbcBatchSink

        sink = JdbcBatchSink(args.url, args.table, _db_properties(args), num_partitions=args.sink_partitions)
        lexicon = None
        if args.lexicon:
            from kestrel.functions.keywords import LEXICON_SCHEMA

            lexicon = spark.read.format(args.lexicon_format).schema(LEXICON_SCHEMA).load(args.lexicon)
        kafka_options = _sasl_options(args)
        if args.max_offsets_per_trigger:
            kafka_options["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
        if args.min_partitions:
            kafka_options["minPartitions"] = str(args.min_partitions)
        run_keyword_job(spark, args.bootstrap_servers, args.topic, sink, args.checkpoint_location,
                        args.window, args.watermark, args.num_output_rows,
                        starting_offsets=args.starting_offsets, rejects_path=args.rejects_path,
                        console=not args.no_console, lexicon=lexicon, pos_mode=args.pos_mode,
                        hot_surfaces=args.hot_words, **kafka_options)
    elif args.job == "keyword-report":
        from kestrel.plans import reports
        from kestrel.streaming.sinks import JdbcBatchSink

        counts = JdbcBatchSink(args.url, args.table, _db_properties(args)).committed_rows(spark)
        report = {"latest": reports.latest_window_ranking, "span": reports.alltime_span,
                  "top": lambda c: reports.alltime_top(c, args.rows)}[args.report]
        report(counts).show(args.rows, truncate=False)
    elif args.job == "publish-feed":
        from kestrel.plans import feed

        if args.stream_checkpoint:
            feed.publish_feed_stream(spark, args.input, args.bootstrap_servers, args.topic,
                                     args.stream_checkpoint, **_sasl_options(args)).awaitTermination()
        else:
            feed.publish_feed_files(spark, args.input, args.bootstrap_servers, args.topic,
                                    rejects_path=args.rejects_path, **_sasl_options(args))


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    start = time.time()
    run(args)
    print(f"\n{args.job} took {time.time() - start:.1f} s")
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Write the physical plans of the registered queries to PLANS.md, one compact plan per query.

    python tools/plans.py [/root/testdata/sf0.01]

Queries that run a stream or write files inside the call return a read of their output; for
those the plan shown is that read, and the stream plans are described in the README.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# What each plan does at 1,000x the data: shuffles, broadcast sides and their bound, hot keys.
SCALE_NOTES = {
    "count_by_group_ranked": "One shuffle of partial counts (one row per group per task), then a range sort of the groups. A group holding a third of the rows costs one row per task.",
    "mean_by_entity": "Partial count/avg before the shuffle; the join sees one row per entity. The dimension is broadcast only when Spark measures it under the threshold, else sort-merge join on the already hash-partitioned aggregate side. Range sort of the result.",
    "mean_by_entity_sql": "Same as mean_by_entity, with the dimension also aggregated per key (sort aggregate of min(name)), so duplicated keys never multiply fact rows in the join.",
    "count_by_customer_ranked": "As count_by_group_ranked with one group per customer; the unique key at the end of the sort keeps the range partitions even though most counts tie.",
    "mean_by_part_sql": "As mean_by_entity_sql with one group per part; the part dimension is joined after both sides are aggregated.",
    "grand_total": "The sort of the input is dropped by the optimizer; partial sums, one row to the final task.",
    "report_lines": "Per-row format_string on the sorted result; no extra shuffle beyond the range sort.",
    "message_decode": "Map-only: from_json per row, no shuffle.",
    "message_rejects": "Map-only.",
    "message_kept": "Map-only.",
    "keyword_tokens": "Split, token rules and partial count in one stage; one shuffle of partial counts. A hot word is one row per task in the exchange.",
    "keywords_per_document": "Map-only: a higher-order filter per document.",
    "keyword_lexicon": "Surfaces are counted per role first (partial counts, one shuffle), then joined to the lexicon (broadcast only if Spark measures it small), then summed per keyword.",
    "keyword_lexicon_level1": "As keyword_lexicon.",
    "keyword_lexicon_table": "As keyword_lexicon, with the lexicon as a table.",
    "keyword_occurrences_table": "Raw tokens meet the lexicon table: unless Spark broadcasts it by measured size, the words found hot in a first pass are salted (token hash modulo the parallelism) with their lexicon rows copied once per salt; all other words have one salt and one row.",
    "window_counts_batch": "Partial count per (window, key); one shuffle.",
    "keyword_counts_batch": "As keyword_tokens, keyed by (window, keyword).",
    "latest_window_ranking": "On the stored table partitioned by window_day: one listing of day folders, then only the newest day's folder is listed and read; window_end is compared uncast.",
    "latest_window_bag": "As latest_window_ranking, then weights are cut into bounded pieces in three rounds with round-robin repartitions: no hot keyword's repetitions sit in one task.",
    "alltime_span": "One pass of min/max over the first and the last day's folders; no other file is listed or read.",
    "alltime_top100": "Over the stored table: partial sums per keyword, one shuffle, and a per-partition top-100 merged once (TakeOrderedAndProject).",
    "latest_window_from_table": "Builds the table for the call, then as latest_window_ranking.",
    "keyword_counts_stream": "Eight micro-batches in order of time, state per (window, keyword) in RocksDB and bounded by the watermark; output goes to day/batch partitions with dynamic overwrite (replay-safe).",
    "window_counts_stream": "As keyword_counts_stream, keyed by event type.",
    "stream_foreach_batch": "Stateless; each batch lands in its own batch_id folder, overwritten on replay.",
    "stream_passthrough": "Stateless; exactly-once through the file sink's log.",
    "file_sink_roundtrip_json": "The write keeps the range-sorted order across part files; the read is a plain scan.",
    "file_sink_roundtrip_csv": "As file_sink_roundtrip_json.",
    "file_sink_roundtrip_parquet": "As file_sink_roundtrip_json.",
    "file_sink_roundtrip_orc": "As file_sink_roundtrip_json.",
    "csv_mean_by_entity": "Type inference costs one extra pass over the CSV (bounded by samplingRatio on large inputs); then as mean_by_entity.",
    "csv_count_by_group": "As count_by_group_ranked, after an inference pass.",
    "feed_enrichment": "Map-only: one pass over the tokens of each line, linear in its length; the line is spliced, not written anew.",
    "latest_window_ranking_sql": "SQL text over the newest day's folder: one scan for the newest window, one for its rows.",
    "latest_window_text": "As latest_window_bag, each piece as text.",
    "alltime_span_sql": "As alltime_span.",
    "alltime_top100_sql": "As alltime_top100.",
    "keywords_links_japanese": "As keyword_lexicon, per language.",
    "window_counts_late_rows": "As window_counts_stream, in two deliveries over one checkpoint.",
    "keyword_counts_stream_lexicon": "As keyword_counts_stream, with raw tokens joined to the lexicon; the words found hot are salted.",
    "message_bad_times": "Map-only.",
    "keyword_batch_analyzer": "Map-only Arrow batches to the analyzer, then partial counts and one shuffle.",
    "keyword_segments": "Runs counted per language first; each counted run is cut where its count is, in chunks, by broadcast tries of the lexicon's blocks; then one shuffle of the words' counts, no join.",
    "keyword_segments_blocks": "As keyword_segments, with many blocks: each is walked from the places of a chunk that lie in its range only.",
    "keyword_table_build": "As keyword_counts_batch, then a range shuffle by time, written by day.",
    "stream_progress": "A row per micro-batch, written by the listener.",
    "concurrent_queries": "Two streams over one source definition; a union of their tables.",
    "committed_reads": "Scan of all attempts semi-joined to the commits (a row per batch); the join's partition columns prune the folders of other attempts.",
    "arrival_stamps": "Map-only.",
    "ordered_file_lines": "One count per split, a window over the splits' rows (not the lines), and a join on (file, split) that is broadcast by size.",
    "ordered_part_lines": "As ordered_file_lines, over many files.",
    "object_store_path": "Plain scan.",
    "count_by_group_null_key": "As count_by_group_ranked.",
    "mean_by_entity_null_measure": "As mean_by_entity.",
    "mean_by_entity_unmatched": "As mean_by_entity.",
    "mean_by_entity_sql_unmatched": "As mean_by_entity_sql.",
}

KEEP = re.compile(r"(Exchange|Aggregate|Join|Scan|Generate|Sort|TakeOrdered|Subquery|Window|Filter|Union|Expand|"
                  r"Limit|BroadcastExchange|AdaptiveSparkPlan|Project|ReusedExchange|AQEShuffleRead|ShuffleQueryStage|"
                  r"BroadcastQueryStage)")


def compact(plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]  # keep AQE's final plan only
    lines = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        lines.append(line[:220])
    return "\n".join(lines)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from kestrel.session import get_session
    from kestrel.plans import catalog

    spark = get_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plans.py` on `{sf_dir}` (local mode, AQE on). Each query is run first, so the plans are AQE's final ones (`isFinalPlan=true`: coalesced shuffle reads, run-time join choices).",
           "Expression ids and file locations are stripped. Streams and file round-trips show the read of their output.", ""]
    for name, fn in catalog.queries().items():
        df = fn(spark, sf_dir)
        df.collect()  # run it, so the plan shown is AQE's final one
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        out += [f"## {name}", "", SCALE_NOTES.get(name, ""), "", "```", compact(buf.getvalue()), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)

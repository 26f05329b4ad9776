"""kestrel: ranked counts, means per entity, message decoding, keyword extraction and windowed
keyword counts as Spark DataFrame, SQL and Structured Streaming plans.

The main entry points, importable from the package itself:

    from kestrel import count_by_group, mean_by_entity, keyword_counts, latest_window_ranking
"""

__version__ = "0.1.0"

from kestrel.functions.keywords import count_keywords, extract_keywords, keyword_array  # noqa: E402
from kestrel.functions.messages import decode_messages, encode_messages, split_rejects, stamp_feed_lines  # noqa: E402
from kestrel.operators.aggregates import (count_by_group, grand_total, mean_by_entity, rows_at_max, span,  # noqa: E402
                                          top_k)
from kestrel.operators.expand import repeat_by_weight  # noqa: E402
from kestrel.plans.batch_jobs import count_by_group_job, mean_by_entity_job, mean_by_entity_sql  # noqa: E402
from kestrel.plans.reports import alltime_span, alltime_top, latest_window_bag, latest_window_ranking  # noqa: E402
from kestrel.session import cluster_settings, get_session  # noqa: E402
from kestrel.sinks.files import write_files  # noqa: E402
from kestrel.sinks.jdbc import write_jdbc  # noqa: E402
from kestrel.streaming.sinks import FileBatchSink, JdbcBatchSink, WindowTableSink  # noqa: E402
from kestrel.streaming.windows import count_per_window, keyword_counts  # noqa: E402

__all__ = [
    "count_keywords", "extract_keywords", "keyword_array",
    "decode_messages", "encode_messages", "split_rejects", "stamp_feed_lines",
    "count_by_group", "grand_total", "mean_by_entity", "rows_at_max", "span", "top_k",
    "repeat_by_weight",
    "count_by_group_job", "mean_by_entity_job", "mean_by_entity_sql",
    "alltime_span", "alltime_top", "latest_window_bag", "latest_window_ranking",
    "cluster_settings", "get_session",
    "write_files", "write_jdbc",
    "FileBatchSink", "JdbcBatchSink", "WindowTableSink",
    "count_per_window", "keyword_counts",
]

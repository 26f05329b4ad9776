"""Registered text queries: messages, keywords, windowed keyword counts and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.analyzers import batch_tokens
from kestrel.functions.keywords import WORD_PATTERN as TOKEN_PATTERN
from kestrel.functions.keywords import classify, count_keywords, explode_tokens, extract_keywords, keyword_array
from kestrel.functions.segmentation import segmented_keywords
from kestrel.functions.messages import decode_messages, encode_messages, iso_stamp, split_rejects
from kestrel.plans.tables import table, text_table
from kestrel.plans.report_sql import ALLTIME_SPAN, ALLTIME_TOP, LATEST_WINDOW_RANKING, run_report
from kestrel.plans.reports import (KeywordTable, alltime_span, alltime_top, bag_text_pieces, latest_window_bag,
                                   latest_window_ranking)
from kestrel.session import shared_path
from kestrel.sources.files import input_version, path_exists
from kestrel.sources.streams import payload_text
from kestrel.sinks.files import write_files
from kestrel.streaming.windows import as_wall_clock, count_per_window, keyword_counts, with_window_day

EPOCH_2024 = 1704067200  # 2024-01-01 00:00:00 UTC


def doc_time() -> F.Column:
    """Documents carry no time; message time is 2024-01-01 plus ``doc_id`` seconds."""
    return F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id"))


def doc_rules() -> F.Column:
    return F.array(F.struct(F.col("source").alias("id"), F.col("lang").alias("tag")))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Kafka-shaped records: key = id, value = envelope JSON as binary."""
    docs = text_table(spark, sf_dir, "documents")
    records = encode_messages(docs, F.col("doc_id"), F.col("text"), iso_stamp(doc_time()), doc_rules())
    return records.select("key", F.col("value").cast("binary").alias("value"))


# --- messages ---------------------------------------------------------------------------------

def q_message_decode(spark, sf_dir):
    """Documents encoded as binary envelopes, decoded back to id, text, ts, rules."""
    decoded = decode_messages(payload_text(document_messages(spark, sf_dir)))
    return decoded.select("id", "text", F.col("ts").cast("timestamp_ntz").alias("ts"), "matching_rules")


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with faults: German messages name their text ``body`` (no text), Spanish ones are
    cut in half (malformed JSON); the rest are whole."""
    docs = text_table(spark, sf_dir, "documents")

    def envelope(text_field: str) -> F.Column:
        data = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias(text_field))
        return F.to_json(F.struct(data.alias("data"), doc_rules().alias("matching_rules"),
                                  iso_stamp(doc_time()).alias("ts")))

    whole = envelope("text")
    cut = whole.substr(F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    return docs.select(F.when(F.col("lang") == "de", envelope("body"))
                       .when(F.col("lang") == "es", cut)
                       .otherwise(whole).alias("value"))


def q_message_rejects(spark, sf_dir):
    """The rejects of a faulty feed (malformed or without text) with their reason."""
    decoded = decode_messages(damaged_messages(spark, sf_dir), keep=["value"])
    _, rejects = split_rejects(decoded)
    return rejects.select("reason", "id")


def q_message_kept(spark, sf_dir):
    """The messages of a faulty feed that decode with text."""
    decoded = decode_messages(damaged_messages(spark, sf_dir), keep=["value"])
    kept, _ = split_rejects(decoded)
    return kept.select("id", "text", F.col("ts").cast("timestamp_ntz").alias("ts"))


def q_message_bad_times(spark, sf_dir):
    """French messages have a time that is none: where a time is needed they are rejects, which keep
    their id and the raw message."""
    docs = text_table(spark, sf_dir, "documents")
    ts = F.when(F.col("lang") == "fr", F.lit("yesterday")).otherwise(iso_stamp(doc_time()))
    messages = encode_messages(docs, F.col("doc_id"), F.col("text"), ts, doc_rules())
    _, rejects = split_rejects(decode_messages(payload_text(messages.select("value")), keep=["value"]))
    return rejects.select("reason", "id", F.get_json_object("raw", "$.data.text").alias("text"))


# --- keywords ---------------------------------------------------------------------------------

def q_keyword_tokens(spark, sf_dir):
    """Keyword appearances over all documents (no lexicon: every token a noun)."""
    docs = text_table(spark, sf_dir, "documents")
    return count_keywords(docs, "text", [])


def q_keywords_per_document(spark, sf_dir):
    """U1 as one array expression per document: its number of keywords."""
    docs = text_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.size(keyword_array(F.col("text"))).alias("n_keywords"))


# Fixed test lexicon (surface, part of speech, base form): a few Japanese entries for the branch
# rules, and common words of the conversation texts given parts of speech.
TEST_LEXICON = [
    ("犬", "名詞,一般,*,*", "犬"),
    ("こと", "名詞,非自立,一般,*", "こと"),
    ("走っ", "動詞,自立,*,*", "走る"),
    ("し", "動詞,自立,*,*", "する"),
    ("は", "助詞,係助詞,*,*", "は"),
    ("the", "連体詞,*,*,*", "the"),
    ("and", "接続詞,*,*,*", "and"),
    ("of", "助詞,格助詞,*,*", "of"),
    ("is", "動詞,自立,*,*", "be"),
    ("are", "動詞,自立,*,*", "be"),
    ("has", "動詞,非自立,*,*", "have"),
    ("est", "動詞,自立,*,*", "etre"),
    ("ist", "動詞,非自立,*,*", "sein"),
    ("les", "名詞,非自立,一般,*", "les"),
    ("la", "名詞,一般,*,*", "la"),
    ("de", "助詞,格助詞,*,*", "de"),
    ("des", "名詞,非自立,*,*", "des"),
    ("que", "形容詞,自立,*,*", "que"),
    ("qui", "形容詞,非自立,*,*", "qui"),
    ("und", "接続詞,*,*,*", "und"),
    ("en", "名詞,一般,*,*", "en"),
    ("le", "動詞,自立,*,*", "ある"),
]


def q_keyword_lexicon(spark, sf_dir, pos_mode="subclass"):
    """Keyword appearances per role with the in-memory lexicon (broadcast)."""
    conv = text_table(spark, sf_dir, "conversations")
    return count_keywords(conv, "text", ["role"], lexicon=TEST_LEXICON, pos_mode=pos_mode)


def q_keyword_lexicon_level1(spark, sf_dir):
    """As keyword_lexicon with the first-level part-of-speech rule."""
    return q_keyword_lexicon(spark, sf_dir, "level1")


def lexicon_table(spark: SparkSession) -> DataFrame:
    """The test lexicon as a table: a lexicon of unknown size, never broadcast by us."""
    return spark.createDataFrame(TEST_LEXICON, "surface string, pos string, base_form string")


def q_keyword_lexicon_table(spark, sf_dir):
    """Keyword counts per role with a lexicon table: surfaces are counted per role before the join."""
    conv = text_table(spark, sf_dir, "conversations")
    return count_keywords(conv, "text", ["role"], lexicon=lexicon_table(spark))


def q_keyword_occurrences_table(spark, sf_dir):
    """Keyword occurrences joined to a lexicon table by a salted join, counted per conversation."""
    conv = text_table(spark, sf_dir, "conversations")
    occurrences = extract_keywords(conv, "text", ["conv_id"], lexicon=lexicon_table(spark))
    return occurrences.groupBy("conv_id", "keyword").agg(F.count("*").alias("appearances"))


# --- windows and reports ----------------------------------------------------------------------

def q_window_counts_batch(spark, sf_dir):
    """Events per (30-minute window, event type)."""
    events = table(spark, sf_dir, "events")
    counts = count_per_window(events, "ts", "event_type", "30 minutes")
    return as_wall_clock(counts, "window_start", "window_end")


def document_keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword table of Q5 in batch form: every window, 30 s wide."""
    docs = text_table(spark, sf_dir, "documents").select(doc_time().alias("ts"), "text")
    return keyword_counts(docs, "ts", "text", "30 seconds")


def q_keyword_counts_batch(spark, sf_dir):
    """Q5 in batch form: keyword appearances per 30-second window."""
    return as_wall_clock(document_keyword_counts(spark, sf_dir), "window_start", "window_end")


_STORED: dict[tuple[str, str, str], str] = {}
#: a task counts the keywords of about so many characters of texts, in windows of at most so many
TASK_TEXT, WINDOW_TEXT = 6 << 20, 6 << 20


def keywords_in_place(texts: DataFrame, size: int | None = None) -> DataFrame:
    """The counts of Q5 of (window_start, text) rows of ``size`` characters (counted first if not given), counted in
    the tasks that the texts are dealt to by time."""
    if size is None:
        size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_TEXT))
    tokens = explode_tokens(texts.repartitionByRange(tasks, "window_start"), "text", ["window_start"])
    counts = classify(tokens, None).groupBy("window_start", "keyword").agg(F.count("keyword").alias("appearances"))
    return counts.select("window_start", (F.col("window_start") + F.expr("INTERVAL 30 SECONDS")).alias("window_end"), "keyword", "appearances")


def in_order_of_time(counts: DataFrame) -> DataFrame:
    """The rows of each partition by day, window and keyword."""
    return with_window_day(counts).sortWithinPartitions("window_day", "window_start", "keyword")


def build_keyword_table(spark: SparkSession, sf_dir: str) -> KeywordTable:
    """The keyword table as the reports read it in production: partitioned by day of window start, its rows
    in order of time so that each task leaves files in few days and row groups hold few windows.

    The texts go in order of time to the tasks that count them, so only texts are shuffled; their counts, which
    are larger, are not. Tasks are made for the characters that the texts have, however well they are compressed, and are
    small enough to count and sort them in memory. Windows of more than WINDOW_TEXT characters are counted by keyword
    in all tasks."""
    path = shared_path(spark, "keyword-table")
    docs = table(spark, sf_dir, "documents").select(doc_time().alias("ts"), "text")
    texts = docs.select(F.window("ts", "30 seconds").start.alias("window_start"), "text").where("text IS NOT NULL")
    sizes = texts.groupBy("window_start").agg(F.sum(F.length("text")).alias("size"))
    many = F.col("size") > WINDOW_TEXT
    found = sizes.agg(F.sum(F.when(~many, F.col("size"))).alias("size"), F.collect_list(F.when(many, F.unix_seconds("window_start"))).alias("crowded")).first()
    crowded = found["crowded"]
    apart = F.unix_seconds("window_start").isin(crowded) if crowded else F.lit(False)
    counts = in_order_of_time(keywords_in_place(texts.where(~apart), found["size"] or 0))
    if crowded:
        few = keyword_counts(texts.where(apart), "window_start", "text", "30 seconds")
        counts = counts.unionAll(in_order_of_time(few.repartitionByRange("window_start", "keyword")))
    write_files(counts, path, "parquet", partition_by=["window_day"])
    _STORED[_state_of(spark, sf_dir)] = path
    return KeywordTable(spark, path)


def _state_of(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, input_version(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def stored_keyword_table(spark: SparkSession, sf_dir: str) -> KeywordTable:
    """The table built from the documents as they are now: built again whenever a file of the input has
    been added, removed or changed."""
    path = _STORED.get(_state_of(spark, sf_dir))
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        return build_keyword_table(spark, sf_dir)
    return KeywordTable(spark, path)


def q_keyword_table_build(spark, sf_dir):
    """K1, Q5: the keyword table of the reports, built anew and read back."""
    return as_wall_clock(build_keyword_table(spark, sf_dir).all(), "window_start", "window_end")


def q_latest_window_ranking(spark, sf_dir):
    """Q7 (F1, A5, O4, C10): keywords of the newest window by appearances."""
    return as_wall_clock(latest_window_ranking(stored_keyword_table(spark, sf_dir).newest_day()), "window_end_local")


def q_latest_window_ranking_sql(spark, sf_dir):
    """Q7 as SQL text over a view of the stored table's newest day."""
    stored_keyword_table(spark, sf_dir).newest_day().createOrReplaceTempView("stored_keywords_ranking")
    return as_wall_clock(run_report(spark, LATEST_WINDOW_RANKING, "stored_keywords_ranking"), "window_end_local")


def q_latest_window_bag(spark, sf_dir):
    """Q8 (C12): the newest window's keywords, one row per appearance."""
    return as_wall_clock(latest_window_bag(stored_keyword_table(spark, sf_dir).newest_day()), "window_end_local")


def q_latest_window_text(spark, sf_dir):
    """The newest window's word bag as space-joined pieces of text."""
    return as_wall_clock(bag_text_pieces(stored_keyword_table(spark, sf_dir).newest_day()), "window_end_local")


def q_alltime_span(spark, sf_dir):
    """Q9 (A6, C10, C11): first window start and last window end, with a caption."""
    return as_wall_clock(alltime_span(stored_keyword_table(spark, sf_dir).edge_days()), "first_start_local", "last_end_local")


def q_alltime_span_sql(spark, sf_dir):
    """Q9 as SQL text over a view of the stored table's first and last day."""
    stored_keyword_table(spark, sf_dir).edge_days().createOrReplaceTempView("stored_keywords_span")
    return as_wall_clock(run_report(spark, ALLTIME_SPAN, "stored_keywords_span"), "first_start_local", "last_end_local")


def q_latest_window_from_table(spark, sf_dir):
    """Q7 over a table built for this call, whatever was stored before."""
    return as_wall_clock(latest_window_ranking(build_keyword_table(spark, sf_dir).newest_day()), "window_end_local")


def q_alltime_top100(spark, sf_dir):
    """Q10 (A4, O5, F2): the 100 keywords with the most appearances."""
    return alltime_top(stored_keyword_table(spark, sf_dir).all(), 100)


def q_alltime_top100_sql(spark, sf_dir):
    """Q10 as SQL text over a view of the stored table."""
    stored_keyword_table(spark, sf_dir).all().createOrReplaceTempView("stored_keywords_top")
    return run_report(spark, ALLTIME_TOP, "stored_keywords_top")


# Added to every document: a short link, Japanese tokens that meet each rule, and single characters.
JAPANESE_TAIL = " 犬 走っ こと は し 猫カフェ 青 鬼 あ 12 www "


def q_keywords_links_japanese(spark, sf_dir):
    """Keywords per language of the documents with a short link in front and Japanese
    tokens behind."""
    docs = text_table(spark, sf_dir, "documents")
    link = F.concat(F.lit("https://t.co/"), F.col("doc_id").cast("string"), F.lit("Ab "))
    texts = docs.select("lang", F.concat(link, F.col("text"), F.lit(JAPANESE_TAIL)).alias("text"))
    return count_keywords(texts, "text", ["lang"], lexicon=TEST_LEXICON)


def letter_run_analyzer(texts):
    """A batch analyzer: letter runs of all texts of a batch; runs of three letters are verbs, the rest nouns."""
    import re

    found = [re.findall(r"[^\W_]+", t) for t in texts.to_pylist()]
    flat = [w for ws in found for w in ws]
    verbs = [len(w) == 3 for w in flat]
    return ([len(ws) for ws in found], flat, ["動詞,自立,*,*" if v else "名詞,一般,*,*" for v in verbs],
            [w + "る" if v else w for w, v in zip(flat, verbs)])


def q_keyword_batch_analyzer(spark, sf_dir):
    """Keywords per conversation role from an external analyzer that takes a batch of texts at once."""
    conv = text_table(spark, sf_dir, "conversations")
    return batch_tokens(conv, "text", ["role"], letter_run_analyzer).groupBy("role", "keyword").agg(
        F.count("*").alias("appearances"))


# --- running text -----------------------------------------------------------------------------

def running_text(text: F.Column) -> F.Column:
    """The text with two of each three blanks gone: runs of up to three words."""
    return F.regexp_replace(text, r"([^ \t\r\n]+)[ \t\r\n]+([^ \t\r\n]+)[ \t\r\n]+([^ \t\r\n]+)", "$1$2$3")


def corpus_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon of the documents' own words of three or more occurrences: frequent words are cheap; words of
    one or two letters are particles, those of three verbs, the others nouns."""
    docs = text_table(spark, sf_dir, "documents")
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(TOKEN_PATTERN), F.lit(0))).alias("surface"))
    counts = words.groupBy("surface").count().where("count >= 3")
    size = F.length("surface")
    return counts.select(
        "surface", F.when(size <= 2, "助詞,係助詞,*,*").when(size == 3, "動詞,自立,*,*").otherwise("名詞,一般,*,*").alias("pos"),
        F.when(size == 3, F.concat("surface", F.lit("る"))).otherwise(F.col("surface")).alias("base_form"),
        (8000 - 700 * F.length(F.col("count").cast("string")) + 150 * size).alias("cost"))


def q_keyword_segments(spark, sf_dir):
    """Keywords per language of running text, cut into words by a least-cost lattice over a
    lexicon of the corpus (broadcast as a trie)."""
    docs = text_table(spark, sf_dir, "documents").select("lang", running_text(F.col("text")).alias("text"))
    return segmented_keywords(docs, "text", ["lang"], corpus_lexicon(spark, sf_dir))


def q_keyword_segments_blocks(spark, sf_dir):
    """The same with a lexicon taken as too large to broadcast at once: in blocks of about 8,000 entries."""
    docs = text_table(spark, sf_dir, "documents").select("lang", running_text(F.col("text")).alias("text"))
    return segmented_keywords(docs, "text", ["lang"], corpus_lexicon(spark, sf_dir), trie_rows=8000)


QUERIES = {
    "message_decode": q_message_decode,
    "message_rejects": q_message_rejects,
    "message_kept": q_message_kept,
    "message_bad_times": q_message_bad_times,
    "keyword_tokens": q_keyword_tokens,
    "keywords_per_document": q_keywords_per_document,
    "keyword_lexicon": q_keyword_lexicon,
    "keyword_lexicon_level1": q_keyword_lexicon_level1,
    "keyword_lexicon_table": q_keyword_lexicon_table,
    "keyword_occurrences_table": q_keyword_occurrences_table,
    "window_counts_batch": q_window_counts_batch,
    "keyword_counts_batch": q_keyword_counts_batch,
    "keyword_batch_analyzer": q_keyword_batch_analyzer,
    "keyword_segments": q_keyword_segments,
    "keyword_segments_blocks": q_keyword_segments_blocks,
    "keyword_table_build": q_keyword_table_build,
    "latest_window_ranking": q_latest_window_ranking,
    "latest_window_ranking_sql": q_latest_window_ranking_sql,
    "latest_window_text": q_latest_window_text,
    "alltime_span_sql": q_alltime_span_sql,
    "alltime_top100_sql": q_alltime_top100_sql,
    "keywords_links_japanese": q_keywords_links_japanese,
    "latest_window_bag": q_latest_window_bag,
    "alltime_span": q_alltime_span,
    "alltime_top100": q_alltime_top100,
    "latest_window_from_table": q_latest_window_from_table,
}

# --- DuckDB twins -----------------------------------------------------------------------------

# The word classes and lists of the rules, stated here on their own, so that a wrong
# character in the Spark side's constants shows as a difference.
URL_PATTERN = r"https://t.co/[0-9a-zA-Z]+"
ALLOWED_TOKEN = r"^[0-9a-zA-Zぁ-んーァ-ヶｱ-ﾝﾞﾟ一-龠]+$"
SINGLE_CHAR_STOP = r"^[0-9a-zA-Zぁ-んァ-ヶｱ-ﾝﾞﾟのにはがとてー-十年月日時分秒火水木金土様方\\*]$"
SINGLE_CHAR_KEEP = r"^[亀長黒戸竜西青鬼]$"
NOUN_STOP = r"^(こと|もの|www|http[s]?|[0-9]+)$"
VERB_STOP = r"^(する|なる|言う|見る|思う|聞く|いう|やる|行く|いく|できる|出来る|ある|ない|いる|いない|http[s]?|[0-9]+)$"
MAX_TOKEN_LENGTH = 32
WORD_PATTERN = r"[\p{L}\p{N}]+"

SQL_DOC_TS = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id))"
SQL_RULES = """'[{"id":"' || source || '","tag":"' || lang || '"}]'"""
SQL_SURFACE_OK = (f"length(surface) <= {MAX_TOKEN_LENGTH} AND regexp_matches(surface, '{ALLOWED_TOKEN}') "
                  f"AND NOT (regexp_matches(surface, '{SINGLE_CHAR_STOP}') AND NOT regexp_matches(surface, '{SINGLE_CHAR_KEEP}'))")
SQL_NOUN_OK = f"NOT regexp_matches(surface, '{NOUN_STOP}')"


def sql_tokens(source: str, keep: str) -> str:
    sep = ", " if keep else ""
    return (f"SELECT {keep}{sep}unnest(regexp_extract_all(regexp_replace(text, '{URL_PATTERN}', '', 'g'), "
            f"'{WORD_PATTERN}')) AS surface FROM ({source}) WHERE text IS NOT NULL")


def sql_lexicon() -> str:
    rows = ", ".join(f"('{s}', '{p}', '{b}')" for s, p, b in TEST_LEXICON)
    return f"SELECT * FROM (VALUES {rows}) AS v(surface, pos, base_form)"


def sql_lexicon_keywords(pos_mode: str, group: str = "role", source: str | None = None) -> str:
    if pos_mode == "level1":
        noun = "split_part(pos, ',', 1) = '名詞'"
        verb = "split_part(pos, ',', 1) IN ('動詞', '形容詞')"
    else:
        noun = "(starts_with(pos, '名詞') AND NOT starts_with(pos, '名詞,非自立'))"
        verb = "(starts_with(pos, '動詞,自立') OR starts_with(pos, '形容詞,自立'))"
    return f"""
        WITH lex AS ({sql_lexicon()}),
        t AS ({sql_tokens(source or f'SELECT {group}, text FROM conversations', group)}),
        s AS (SELECT * FROM t WHERE {SQL_SURFACE_OK}),
        k AS (SELECT s.{group},
                     CASE WHEN lex.pos IS NULL OR {noun}
                               THEN CASE WHEN NOT regexp_matches(s.surface, '{NOUN_STOP}') THEN s.surface END
                          WHEN {verb}
                               THEN CASE WHEN NOT regexp_matches(lex.base_form, '{VERB_STOP}') THEN lex.base_form END
                     END AS keyword
              FROM s LEFT JOIN lex ON s.surface = lex.surface)
        SELECT {group}, keyword, count(*) AS appearances FROM k WHERE keyword IS NOT NULL GROUP BY {group}, keyword"""


SQL_DOC_COUNTS = f"""
    t AS ({sql_tokens(f'SELECT {SQL_DOC_TS} AS ts, text FROM documents', 'ts')}),
    c AS (SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start,
                 time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND AS window_end,
                 surface AS keyword, count(*) AS appearances
          FROM t WHERE {SQL_SURFACE_OK} AND {SQL_NOUN_OK} GROUP BY ALL)
"""

ORACLE = {
    "message_decode": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, text, {SQL_DOC_TS} AS ts, {SQL_RULES} AS matching_rules
        FROM documents""",
    "message_rejects": """
        SELECT 'no_text' AS reason, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE lang = 'de'
        UNION ALL
        SELECT 'malformed' AS reason, NULL AS id FROM documents WHERE lang = 'es'""",
    "message_kept": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, text, {SQL_DOC_TS} AS ts FROM documents
        WHERE lang NOT IN ('de', 'es')""",
    "message_bad_times": "SELECT 'bad_ts' AS reason, CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE lang = 'fr'",
    "keyword_tokens": f"""
        WITH t AS ({sql_tokens('SELECT text FROM documents', '')})
        SELECT surface AS keyword, count(*) AS appearances FROM t
        WHERE {SQL_SURFACE_OK} AND {SQL_NOUN_OK} GROUP BY surface""",
    "keywords_per_document": f"""
        SELECT doc_id, CAST(len(list_filter(
            regexp_extract_all(regexp_replace(text, '{URL_PATTERN}', '', 'g'), '{WORD_PATTERN}'),
            lambda surface: {SQL_SURFACE_OK} AND {SQL_NOUN_OK})) AS INTEGER) AS n_keywords
        FROM documents""",
    "keyword_lexicon": sql_lexicon_keywords("subclass"),
    "keyword_lexicon_level1": sql_lexicon_keywords("level1"),
    "keyword_lexicon_table": sql_lexicon_keywords("subclass"),
    "keyword_occurrences_table": sql_lexicon_keywords("subclass", "conv_id"),
    "window_counts_batch": """
        SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
               time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end,
               event_type AS keyword, count(event_type) AS appearances
        FROM events GROUP BY ALL""",
    "keyword_counts_batch": f"WITH {SQL_DOC_COUNTS} SELECT * FROM c",
    "latest_window_ranking": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT window_end + INTERVAL 9 HOUR AS window_end_local, keyword, appearances FROM c
        WHERE window_end = (SELECT max(window_end) FROM c) ORDER BY appearances DESC, keyword""",
    "latest_window_bag": f"""
        WITH {SQL_DOC_COUNTS},
        l AS (SELECT window_end + INTERVAL 9 HOUR AS window_end_local, keyword, appearances FROM c
              WHERE window_end = (SELECT max(window_end) FROM c))
        SELECT window_end_local, keyword FROM (SELECT window_end_local, keyword, unnest(range(appearances)) FROM l)""",
    "alltime_span": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT min(window_start) + INTERVAL 9 HOUR AS first_start_local,
               max(window_end) + INTERVAL 9 HOUR AS last_end_local,
               'From ' || strftime(min(window_start) + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S')
               || ' To ' || strftime(max(window_end) + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') AS caption
        FROM c""",
    "latest_window_from_table": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT window_end + INTERVAL 9 HOUR AS window_end_local, keyword, appearances FROM c
        WHERE window_end = (SELECT max(window_end) FROM c) ORDER BY appearances DESC, keyword""",
    "alltime_top100": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT keyword, CAST(sum(appearances) AS BIGINT) AS total FROM c
        GROUP BY keyword ORDER BY total DESC, keyword LIMIT 100""",
    "latest_window_text": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT window_end + INTERVAL 9 HOUR AS window_end_local, keyword,
               array_to_string(list_transform(range(appearances), lambda x: keyword), ' ') AS piece
        FROM c WHERE window_end = (SELECT max(window_end) FROM c)""",
    "keywords_links_japanese": sql_lexicon_keywords(
        "subclass", "lang", f"SELECT lang, 'https://t.co/' || doc_id || 'Ab ' || text || '{JAPANESE_TAIL}' AS text FROM documents"),
}
# Running text: every span of a run that is a word or may be an unknown one, then the dynamic program over the
# places of a run (a fold that appends the best way to reach each place), then the cuts backwards.
ORACLE["keyword_segments"] = f"""
    WITH texts AS (SELECT lang, regexp_replace(text,
            '([^ \\t\\r\\n]+)[ \\t\\r\\n]+([^ \\t\\r\\n]+)[ \\t\\r\\n]+([^ \\t\\r\\n]+)', '\\1\\2\\3', 'g') AS text FROM documents),
    lex AS (SELECT surface, CASE WHEN length(surface) <= 2 THEN '助詞,係助詞,*,*' WHEN length(surface) = 3 THEN '動詞,自立,*,*'
                                 ELSE '名詞,一般,*,*' END AS pos,
                   CASE WHEN length(surface) = 3 THEN surface || 'る' ELSE surface END AS base_form,
                   8000 - 700 * length(CAST(count(*) AS VARCHAR)) + 150 * length(surface) AS cost
            FROM (SELECT unnest(regexp_extract_all(text, '{WORD_PATTERN}')) AS surface FROM documents)
            GROUP BY surface HAVING count(*) >= 3),
    counted AS (SELECT lang, surface AS run, count(*) AS n FROM ({sql_tokens('texts', 'lang')}) GROUP BY ALL),
    places AS (SELECT run, length(run) AS n, unnest(range(length(run))) AS s FROM (SELECT DISTINCT run FROM counted)),
    classes AS (SELECT *, CASE WHEN regexp_matches(substr(run, s + 1, 1), '[ぁ-ゟ]') THEN 1
                               WHEN regexp_matches(substr(run, s + 1, 1), '[ァ-ヿｦ-ﾟ]') THEN 2
                               WHEN regexp_matches(substr(run, s + 1, 1), '[㐀-鿿々]') THEN 3
                               WHEN regexp_matches(substr(run, s + 1, 1), '[0-9]') THEN 4 ELSE 0 END AS class FROM places),
    bounds AS (SELECT *, lead(class) OVER (PARTITION BY run ORDER BY s) IS DISTINCT FROM class AS bound FROM classes),
    ends AS (SELECT *, min(CASE WHEN bound THEN s + 1 END)
                 OVER (PARTITION BY run ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS class_end FROM bounds),
    spans AS (
      SELECT run, s, e, min(cost) FILTER (WHERE known) AS kc, min(cost) FILTER (WHERE NOT known) AS uc FROM (
        SELECT run, s, s + k AS e, cost, true AS known
        FROM (SELECT run, s, unnest(range(1, least(n - s, 64) + 1)) AS k FROM places) JOIN lex ON substr(run, s + 1, k) = surface
        UNION ALL SELECT run, s, s + 1, 21000, false FROM ends
        UNION ALL SELECT run, s, class_end, 20000 + 1000 * (class_end - s), false FROM ends)
      GROUP BY run, s, e),
    steps AS (SELECT run, e, list(struct_pack(c := CAST(least(kc, uc) AS BIGINT), w := CAST(1 AS BIGINT), s := CAST(s AS BIGINT))) AS l
              FROM spans GROUP BY run, e),
    folds AS (SELECT run, list(l ORDER BY e) AS ls FROM steps GROUP BY run),
    dp AS (SELECT run, list_reduce(list_prepend([struct_pack(c := CAST(0 AS BIGINT), w := CAST(0 AS BIGINT), s := CAST(0 AS BIGINT))], ls),
             lambda acc, x: list_append(acc, list_sort(list_transform(x, lambda y: struct_pack(
               c := acc[y.s + 1].c + y.c, w := acc[y.s + 1].w + 1, s := y.s)))[1])) AS best FROM folds),
    back AS (SELECT run, list_reduce(list_prepend([CAST(len(best) - 1 AS BIGINT)], list_transform(range(len(best)), lambda x: [x])),
               lambda acc, x: CASE WHEN acc[-1] = 0 THEN acc ELSE list_append(acc, best[acc[-1] + 1].s) END) AS cuts FROM dp),
    cut AS (SELECT run, cuts[i] AS e, cuts[i + 1] AS s FROM (SELECT run, cuts, unnest(range(1, len(cuts))) AS i FROM back)),
    tagged AS (SELECT cut.run, substr(cut.run, cut.s + 1, cut.e - cut.s) AS surface, coalesce(kc <= uc, kc IS NOT NULL) AS known
               FROM cut JOIN spans ON cut.run = spans.run AND cut.s = spans.s AND cut.e = spans.e),
    k AS (SELECT t.run, CASE WHEN NOT known OR starts_with(pos, '名詞')
                                  THEN CASE WHEN NOT regexp_matches(t.surface, '{NOUN_STOP}') THEN t.surface END
                             WHEN starts_with(pos, '動詞,自立')
                                  THEN CASE WHEN NOT regexp_matches(base_form, '{VERB_STOP}') THEN base_form END END AS keyword
          FROM (SELECT * FROM tagged WHERE {SQL_SURFACE_OK}) t LEFT JOIN lex ON t.surface = lex.surface)
    SELECT lang, keyword, CAST(sum(n) AS BIGINT) AS appearances FROM counted JOIN k ON counted.run = k.run
    WHERE keyword IS NOT NULL GROUP BY lang, keyword"""
ORACLE["keyword_batch_analyzer"] = f"""
    WITH t AS ({sql_tokens('SELECT role, text FROM conversations', 'role')})
    SELECT role, CASE WHEN length(surface) = 3 THEN surface || 'る' ELSE surface END AS keyword, count(*) AS appearances FROM t
    WHERE {SQL_SURFACE_OK} AND CASE WHEN length(surface) = 3 THEN NOT regexp_matches(surface || 'る', '{VERB_STOP}') ELSE {SQL_NOUN_OK} END
    GROUP BY ALL"""
ORACLE["keyword_segments_blocks"] = ORACLE["keyword_segments"]
ORACLE["keyword_table_build"] = f"WITH {SQL_DOC_COUNTS} SELECT *, CAST(window_start AS DATE) AS window_day FROM c"
for _name in ("latest_window_ranking", "alltime_span", "alltime_top100"):
    ORACLE[f"{_name}_sql"] = ORACLE[_name]

"""Keyword extraction as native column expressions.

The text is cut into runs of letters and digits, each run is one token (its *surface*). A token
must pass three surface rules (length, allowed characters, single-character stop list), then a
part-of-speech rule: nouns give their surface, independent verbs and adjectives give their base
form, anything else is dropped. Parts of speech come from a lexicon table
``(surface, pos, base_form)`` joined on the surface; a token missing from the lexicon is a noun.

This classifies tokens like a morphological analyzer would, but it does not segment running
Japanese text into words: a run of kana and kanji stays one token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# --- Fixed values: these word classes and lists must equal the reference's rules exactly. ----
URL_PATTERN = r"https://t.co/[0-9a-zA-Z]+"
ALLOWED_TOKEN = r"^[0-9a-zA-Zぁ-んーァ-ヶｱ-ﾝﾞﾟ一-龠]+$"
SINGLE_CHAR_STOP = r"^[0-9a-zA-Zぁ-んァ-ヶｱ-ﾝﾞﾟのにはがとてー-十年月日時分秒火水木金土様方\\*]$"
SINGLE_CHAR_KEEP = r"^[亀長黒戸竜西青鬼]$"
NOUN_STOP = r"^(こと|もの|www|http[s]?|[0-9]+)$"
VERB_STOP = r"^(する|なる|言う|見る|思う|聞く|いう|やる|行く|いく|できる|出来る|ある|ない|いる|いない|http[s]?|[0-9]+)$"
MAX_TOKEN_LENGTH = 32
NOUN = "名詞"
DEPENDENT_NOUN = "名詞,非自立"
VERB = "動詞"
ADJECTIVE = "形容詞"
INDEPENDENT_VERB = "動詞,自立"
INDEPENDENT_ADJECTIVE = "形容詞,自立"
# --- end of fixed values ----------------------------------------------------------------------

# Our own split rule: a token is a maximal run of Unicode letters and digits.
WORD_PATTERN = r"[\p{L}\p{N}]+"
SEPARATOR_PATTERN = r"[^\p{L}\p{N}]+"

POS_MODES = ("subclass", "level1")
LEXICON_SCHEMA = StructType([StructField("surface", StringType()), StructField("pos", StringType()),
                             StructField("base_form", StringType())])


def strip_urls(text: Column) -> Column:
    """Delete short links (C7); the ``.`` of the pattern matches any character. Only texts with what a link begins with
    are searched."""
    return F.when(text.contains("https://t"), F.regexp_replace(text, F.lit(URL_PATTERN), F.lit(""))).otherwise(text)


def words(text: Column) -> Column:
    """All tokens of a text, in order, as ``array<string>``; NULL text gives NULL.

    Cut at runs of separators, which is cheaper than extracting the letter runs; the only extra
    pieces are empty strings at the ends, and no empty string passes ``surface_ok``.
    """
    return F.split(strip_urls(text), SEPARATOR_PATTERN)


def surface_ok(surface: Column, of_words: bool = False) -> Column:
    """At most 32 characters, only allowed characters, not a one-character stop word. ``of_words``: the surface
    is one of ``words``, of letters and digits alone; of those all ASCII ones are allowed, without a look at the pattern."""
    length = F.length(surface)
    allowed = surface.rlike(ALLOWED_TOKEN)
    if of_words:
        allowed = ((length > 0) & (F.octet_length(surface) == length)) | allowed
    # The stop pattern matches single characters only; the length test spares longer tokens
    # two regular-expression matches (``And`` stops at the first false operand).
    one_char_stop = (length == 1) & surface.rlike(SINGLE_CHAR_STOP) & ~surface.rlike(SINGLE_CHAR_KEEP)
    return (length <= MAX_TOKEN_LENGTH) & allowed & ~one_char_stop


def noun_ok(surface: Column) -> Column:
    """nouns other than the meaningless ones and plain numbers."""
    # What the pattern matches starts with a digit (bytes below ":") or like one of its words; few surfaces do.
    may_stop = (surface < ":") | surface.startswith("w") | surface.startswith("h") | surface.startswith("こ") | surface.startswith("も")
    return ~(may_stop & surface.rlike(NOUN_STOP))


def verb_ok(base_form: Column) -> Column:
    """verbs and adjectives other than the light ones and plain numbers."""
    return ~base_form.rlike(VERB_STOP)


def keyword_array(text: Column) -> Column:
    """Keywords of a text as an array, for texts whose every token is a noun (no lexicon).

    Stays a single expression (higher-order ``filter``), so it runs inside whole-stage code.
    """
    return F.filter(words(text), lambda w: surface_ok(w) & noun_ok(w))


def is_noun(pos: Column, pos_mode: str) -> Column:
    if pos_mode == "level1":
        return F.split(pos, ",").getItem(0) == NOUN
    return pos.startswith(NOUN) & ~pos.startswith(DEPENDENT_NOUN)


def is_verb_or_adjective(pos: Column, pos_mode: str) -> Column:
    if pos_mode == "level1":
        return F.split(pos, ",").getItem(0).isin(VERB, ADJECTIVE)
    return pos.startswith(INDEPENDENT_VERB) | pos.startswith(INDEPENDENT_ADJECTIVE)


def keyword_of(surface: Column, pos: Column, base_form: Column, pos_mode: str = "subclass") -> Column:
    """F6-F8 after the lexicon lookup: the keyword a token contributes, or NULL if none.

    A token with no lexicon entry (NULL ``pos``) counts as a noun with its own surface.
    """
    if pos_mode not in POS_MODES:
        raise ValueError(f"pos_mode must be one of {POS_MODES}")
    noun = pos.isNull() | is_noun(pos, pos_mode)
    verb = pos.isNotNull() & is_verb_or_adjective(pos, pos_mode)
    return (F.when(noun, F.when(noun_ok(surface), surface))
            .when(verb, F.when(verb_ok(base_form), base_form)))


def explode_tokens(df: DataFrame, text_col: str, keep: list[str], surface_name: str = "surface",
                   salt_name: str | None = None) -> DataFrame:
    """One row per token that passes the surface rules (C6, F3-F5); NULL or empty text gives none.
    With ``salt_name`` each token also gets a hash of its text and its position in it: the same on a
    retry, and spread evenly whatever the word and wherever it stands."""
    if salt_name:
        tokens = df.select(*keep, F.xxhash64(*keep, text_col).alias("_row"), F.posexplode(words(F.col(text_col))).alias("_pos", surface_name))
        tokens = tokens.select(*keep, F.xxhash64("_row", "_pos").alias(salt_name), surface_name)
    else:
        tokens = df.select(*keep, F.explode(words(F.col(text_col))).alias(surface_name))
    return tokens.filter(surface_ok(F.col(surface_name), of_words=True))


def lexicon_frame(spark: SparkSession, entries: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Lexicon as a DataFrame with one entry per surface, so a token is never counted twice (of
    several readings the smallest stays). Whether it is broadcast is left to Spark's size threshold."""
    if not isinstance(entries, DataFrame):
        entries = spark.createDataFrame(entries, LEXICON_SCHEMA)
    one = entries.groupBy("surface").agg(F.min(F.struct("pos", "base_form")).alias("r"))
    return one.select("surface", F.col("r.pos").alias("pos"), F.col("r.base_form").alias("base_form"))


def stored_lexicon(spark: SparkSession, entries: list[tuple[str, str, str]] | DataFrame, path: str) -> DataFrame:
    """``lexicon_frame`` written to ``path`` and read back, for plans that meet it again and again: it is prepared once,
    and Spark's size threshold has its size on disk to go by."""
    lexicon_frame(spark, entries).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def hot_surfaces(tokens: DataFrame, surface_col: str = "surface", tasks: int | None = None) -> list[str]:
    """The surfaces that hold more than half of one task's share of all tokens, of ``tasks`` tasks (the
    cluster's default parallelism): at most twice as many as there are tasks. One pass over the tokens
    with a partial aggregate; the grand total is that of its counts (both read one exchange)."""
    tasks = tasks or max(2, tokens.sparkSession.sparkContext.defaultParallelism)
    counts = tokens.groupBy(F.col(surface_col).alias("surface")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n")).limit(2 * tasks).select("surface", "n", F.lit(False).alias("total"))
    found = top.unionAll(counts.agg(F.lit(None).cast("string"), F.sum("n"), F.lit(True))).collect()
    total = next(r["n"] for r in found if r["total"]) or 0
    return sorted(r["surface"] for r in found if not r["total"] and r["n"] * 2 * tasks > total)


def classify(tokens: DataFrame, lexicon: DataFrame | None, surface_col: str = "surface", keyword_name: str = "keyword",
             pos_mode: str = "subclass", salt_col: str | None = None, hot: list[str] | None = None) -> DataFrame:
    """Turn surface rows into keyword rows (F6-F8), dropping tokens that give none.

    All columns of ``tokens`` other than the surface (and the salt) are kept. With ``salt_col``, for
    raw tokens, and ``hot``, the surfaces found to be hot, the join key is (surface, salt): a hot token's salt
    is its hash modulo the cluster's default parallelism, and a hot lexicon row is copied once per salt, so
    a word that holds a third of all tokens is spread over all cores. Every other word has one salt and
    one lexicon row.
    """
    keep = [c for c in tokens.columns if c not in (surface_col, salt_col)]
    surface = F.col(surface_col)
    if lexicon is None:
        return tokens.filter(noun_ok(surface)).select(*keep, surface.alias(keyword_name))
    if salt_col and hot:
        salts = max(2, tokens.sparkSession.sparkContext.defaultParallelism)
        copies = F.when(F.col("surface").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        lex = lexicon.withColumn("_salt", F.explode(copies))
        salt = F.when(surface.isin(hot), F.pmod(F.col(salt_col), F.lit(salts))).otherwise(F.lit(0))
        tokens = tokens.withColumn("_salt", salt.cast("int"))
        joined = tokens.join(lex, (tokens[surface_col] == lex["surface"]) & (tokens["_salt"] == lex["_salt"]), "left")
    else:
        lex = lexicon
        joined = tokens.join(lex, tokens[surface_col] == lex["surface"], "left")
    keyword = keyword_of(tokens[surface_col], lex["pos"], lex["base_form"], pos_mode)
    out = joined.select(*[tokens[c] for c in keep], keyword.alias(keyword_name))
    return out.filter(F.col(keyword_name).isNotNull())


def extract_keywords(df: DataFrame, text_col: str, keep: list[str], lexicon=None,
                     pos_mode: str = "subclass", keyword_name: str = "keyword") -> DataFrame:
    """One row per keyword occurrence: ``keep`` columns plus ``keyword`` (U1 as a plan). With a lexicon, a
    first pass over the tokens finds the hot words, which alone are salted."""
    lex = None if lexicon is None else lexicon_frame(df.sparkSession, lexicon)
    salt = None if lex is None else "_token"
    rows = df.filter(F.col(text_col).isNotNull())
    hot = hot_surfaces(explode_tokens(rows, text_col, [])) if salt else None
    tokens = explode_tokens(rows, text_col, keep, salt_name=salt)
    return classify(tokens, lex, keyword_name=keyword_name, pos_mode=pos_mode, salt_col=salt, hot=hot)


def count_keywords(df: DataFrame, text_col: str, group_cols: list[str], lexicon=None,
                   pos_mode: str = "subclass", count_name: str = "appearances",
                   hot: list[str] | None = None) -> DataFrame:
    """Keyword appearances per group (and overall when ``group_cols`` is empty).

    With a lexicon, surfaces are counted per group before the join, so the join sees each distinct
    surface once per group instead of every token; on a stream, where that would add a stateful
    step, the ``hot`` surfaces (as ``hot_surfaces`` finds them in earlier rows) are salted instead.
    """
    lex = None if lexicon is None else lexicon_frame(df.sparkSession, lexicon)
    salt = "_token" if lex is not None and df.isStreaming else None
    tokens = explode_tokens(df.filter(F.col(text_col).isNotNull()), text_col, group_cols, salt_name=salt)
    if lex is not None and not salt:
        per_surface = tokens.groupBy(*group_cols, "surface").agg(F.count("*").alias("_n"))
        return (classify(per_surface, lex, pos_mode=pos_mode)
                .groupBy(*group_cols, "keyword").agg(F.sum("_n").cast("bigint").alias(count_name)))
    keywords = classify(tokens, lex, pos_mode=pos_mode, salt_col=salt, hot=hot)
    return keywords.groupBy(*group_cols, "keyword").agg(F.count("keyword").alias(count_name))

from pyspark.sql import functions as F

from kestrel.functions.keywords import extract_keywords, keyword_array


def _keywords(spark, texts, lexicon=None, pos_mode="subclass"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = extract_keywords(df, "text", ["i"], lexicon=lexicon, pos_mode=pos_mode).collect()
    return [r["keyword"] for r in sorted(rows, key=lambda r: r["i"])]


def test_token_length_limit(spark):
    assert _keywords(spark, ["a" * 32, "b" * 33]) == ["a" * 32]


def test_token_classes(spark):
    texts = ["東京", "ABC", "a", "é", "ヴ", "人", "水", "亀", "長", "々", "123", "www"]
    assert _keywords(spark, texts) == ["東京", "ABC", "亀", "長"]


def test_url_removal_and_words(spark):
    assert _keywords(spark, ["see https://t.co/Ab1 now"]) == ["see", "now"]


def test_accented_word_is_dropped_whole(spark):
    assert _keywords(spark, ["café ok"]) == ["ok"]


def test_null_and_empty_text_give_nothing(spark):
    assert _keywords(spark, [None, "", "  "]) == []


LEXICON = [("犬", "名詞,一般,*,*", "犬"), ("こと", "名詞,非自立,一般,*", "こと"), ("方", "名詞,非自立,*,*", "方"),
           ("ため", "名詞,非自立,副詞可能,*", "ため"), ("走っ", "動詞,自立,*,*", "走る"), ("し", "動詞,自立,*,*", "する"),
           ("は", "助詞,係助詞,*,*", "は"), ("まし", "助動詞,*,*,*", "ます"), ("ほし", "形容詞,非自立,*,*", "ほしい")]


def test_lexicon_branches(spark):
    texts = ["犬", "走っ", "し", "は", "まし", "ほし", "こと", "ほげ"]
    assert _keywords(spark, texts, LEXICON) == ["犬", "走る", "ほげ"]


def test_dependent_noun_kept_only_in_level1(spark):
    # ため is a dependent noun: dropped by default, kept with level1.
    assert _keywords(spark, ["ため"], LEXICON) == []
    assert _keywords(spark, ["ため"], LEXICON, "level1") == ["ため"]
    # こと is a noun stop word in both modes; ほし is a dependent adjective: level1 keeps its base form.
    assert _keywords(spark, ["こと", "ほし"], LEXICON, "level1") == ["ほしい"]


def test_duplicate_lexicon_entries_do_not_duplicate_tokens(spark):
    lex = LEXICON + [("犬", "名詞,固有名詞,*,*", "犬")]
    assert _keywords(spark, ["犬"], lex) == ["犬"]


def test_keyword_array_matches_exploded_form(spark):
    texts = ["see https://t.co/Ab1 now 123 www 東京 a", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    arrays = [r[0] for r in df.select(keyword_array(F.col("text"))).collect()]
    assert arrays == [["see", "now", "東京"], None]


def test_duplicates_in_one_message_count_separately(spark):
    assert _keywords(spark, ["alpha beta alpha"]) == ["alpha", "beta", "alpha"]


def test_hot_word_at_one_position_spreads_over_many_salts(spark):
    """1,000 texts that start with the same word: its salts are as many as the join has, evenly used."""
    from collections import Counter

    from kestrel.functions.keywords import explode_tokens

    texts = spark.createDataFrame([(i, f"RT w{i}") for i in range(1000)], "i int, text string")
    tokens = explode_tokens(texts, "text", ["i"], salt_name="salt").filter("surface = 'RT'")
    salts = Counter(r["s"] for r in tokens.select(F.pmod(F.col("salt"), F.lit(8)).alias("s")).collect())
    assert len(salts) == 8 and max(salts.values()) < 200


def test_lexicon_table_join_is_salted(spark, capsys):
    texts = ["犬 走っ " * 30, "ほげ 犬"]
    table = spark.createDataFrame(LEXICON, "surface string, pos string, base_form string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    salted = extract_keywords(df, "text", ["i"], lexicon=table)
    salted.explain()
    assert "_salt" in capsys.readouterr().out
    assert sorted(r["keyword"] for r in salted.collect()) == sorted(_keywords(spark, texts, LEXICON))


def test_shortcuts_of_the_rules_keep_their_patterns(spark):
    """Tokens that are allowed, or kept as nouns, without a look at the pattern are those that it allows or keeps."""
    from kestrel.functions.keywords import ALLOWED_TOKEN, NOUN_STOP, explode_tokens, noun_ok

    texts = ["", " ", "12 0 9a a9 007x www wwww ww http https httpss h w こと ことも もの も x", "é über straße 犬 ｱ 青 鬼 あ ⅷ ² ٣ ñandú Ωmega",
             "a" * 33 + " " + "b" * 32 + " 犬" * 3 + " :x ;9 http:9 /8", "w" * 5 + " こ こと1 https0"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    words = df.select(F.explode(F.split("text", r"[^\p{L}\p{N}]+")).alias("surface"))
    one = F.expr("length(surface) = 1")
    kept = sorted(r["surface"] for r in explode_tokens(df, "text", ["i"]).where("length(surface) > 1").collect())
    assert kept == sorted(r["surface"] for r in words.where(~one & F.col("surface").rlike(ALLOWED_TOKEN) & (F.length("surface") <= 32)).collect())
    surfaces = spark.createDataFrame([(s,) for s in [None, "", "12\n", "www\n", " 12", ":", "9:", "-1", "+"] + [w for t in texts for w in t.split()]], "s string")
    assert surfaces.where(~noun_ok(F.col("s")).eqNullSafe(~F.col("s").rlike(NOUN_STOP))).count() == 0


def test_links_go_wherever_they_stand(spark):
    """Texts without the beginning of a link are not searched for one; the others lose what the pattern matches."""
    from kestrel.functions.keywords import URL_PATTERN, strip_urls

    texts = [None, "", "no link", "https://t.co/a1B", "x https://t-co/9 y https://t.co/Zz", "https://tXco/a", "http://t.co/a", "HTTPS://T.CO/a", "https://t.co/"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~strip_urls(F.col("t")).eqNullSafe(F.regexp_replace("t", URL_PATTERN, ""))).count() == 0

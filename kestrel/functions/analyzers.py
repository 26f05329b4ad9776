"""Pluggable analyzer (U1, U2): an external per-text tokenizer in place of the letter-run split.

A morphological analyzer segments running Japanese text into words and tags each with a part of
speech and a base form, which the letter-run split cannot do. ``analyzed_tokens`` runs such an
analyzer as an Arrow-batched pandas UDF (texts travel in batches; the analyzer is called once per
text) and hands its ``(surface, pos, base_form)`` triples to the same native rules as the lexicon path
(F3-F8).

The analyzer is any Python callable ``text -> iterable of (surface, pos, base_form)``, importable
on the executors (shipped with ``--py-files`` or installed); a dictionary-backed analyzer should
build its tokenizer once per worker process (a module-level or cached object), not per call. The UDF is
marked nondeterministic so the optimizer neither runs it twice nor moves it.

``batch_tokens`` is the form for analyzers that work on many texts at once: the callable gets the texts of
an Arrow batch as an array and returns three columns and the number of tokens of each text, so no object
is made per token, and texts whose words are needed under several keys are analyzed once. An accumulator
counts calls and texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import sys

import pandas as pd
import pyarrow as pa
from pyspark import Accumulator, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from kestrel.functions.keywords import keyword_of, strip_urls, surface_ok

Analyzer = Callable[[str], Iterable[tuple[str, str, str]]]
TOKEN_TYPE = ArrayType(StructType([StructField("surface", StringType()), StructField("pos", StringType()),
                                   StructField("base_form", StringType())]))


def _ship_by_value(*modules) -> None:
    """Send these modules' code with the UDF, so executors need not have them installed."""
    for name in modules:
        module = sys.modules.get(name)
        if module is not None and name not in ("__main__", "builtins"):
            cloudpickle.register_pickle_by_value(module)


def analyzer_udf(analyze: Analyzer, ship_analyzer_module: bool = False):
    """The analyzer as a nondeterministic pandas UDF. The analyzer's module normally travels by
    reference (installed on the executors, its dictionaries loaded once per worker);
    ``ship_analyzer_module=True`` sends its code with the UDF instead, for small analyzers only."""
    _ship_by_value(__name__, getattr(analyze, "__module__", None) if ship_analyzer_module else None)

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else
                         [{"surface": s, "pos": p, "base_form": b} for s, p, b in analyze(t)])
    return F.pandas_udf(run, TOKEN_TYPE).asNondeterministic()


def analyzed_tokens(df: DataFrame, text_col: str, keep: list[str], analyze: Analyzer,
                    pos_mode: str = "subclass", keyword_name: str = "keyword",
                    ship_analyzer_module: bool = False) -> DataFrame:
    """One row per keyword occurrence, tokens and tags from ``analyze``."""
    udf = analyzer_udf(analyze, ship_analyzer_module)
    texts = df.filter(F.col(text_col).isNotNull()).select(*keep, strip_urls(F.col(text_col)).alias("_text"))
    tokens = texts.select(*keep, F.explode(udf(F.col("_text"))).alias("t"))
    surface, pos, base = F.col("t.surface"), F.col("t.pos"), F.col("t.base_form")
    keyword = keyword_of(surface, pos, base, pos_mode)
    return (tokens.filter(surface_ok(surface))
            .select(*keep, keyword.alias(keyword_name))
            .filter(F.col(keyword_name).isNotNull()))


#: texts of a batch -> (tokens of each text, surfaces, parts of speech, base forms), the last three flat
BatchAnalyzer = Callable[[pa.Array], tuple[list[int], list[str], list[str | None], list[str | None]]]


def batch_tokens(df: DataFrame, text_col: str, keep: list[str], analyze: BatchAnalyzer, pos_mode: str = "subclass",
                 keyword_name: str = "keyword", calls: Accumulator | None = None, texts: Accumulator | None = None) -> DataFrame:
    """One row per keyword occurrence, tokens and tags from a batch analyzer, called once per Arrow batch.
    ``calls`` and ``texts`` count what it was asked (a retried task counts again)."""
    _ship_by_value(__name__)
    rows = df.filter(F.col(text_col).isNotNull()).select(*keep, strip_urls(F.col(text_col)).alias("_text"))
    schema = StructType([rows.schema[c] for c in keep] + TOKEN_TYPE.elementType.fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, *columns = analyze(batch.column("_text"))
            if calls is not None:
                calls.add(1)
            if texts is not None:
                texts.add(batch.num_rows)
            place = pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(place) for c in keep]
                                             + [pa.array(c, pa.string()) for c in columns], names=names)

    tokens = rows.mapInArrow(run, schema)
    surface = F.col("surface")
    return (tokens.filter(surface_ok(surface))
            .select(*keep, keyword_of(surface, F.col("pos"), F.col("base_form"), pos_mode).alias(keyword_name))
            .filter(F.col(keyword_name).isNotNull()))

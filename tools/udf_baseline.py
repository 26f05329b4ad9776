"""Keyword counting at sf0.1: the native column pipeline vs the same rules in a row-at-a-time
Python UDF (the way a per-text tokenizer function runs in Spark). Prints one JSON line.

    python tools/udf_baseline.py [/root/testdata/sf0.1]

The UDF side uses the plain-Python rule model of ``tests/test_keyword_model.py`` (letter runs,
no morphological analyzer), so both sides compute the same keywords; only the execution differs.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from pyspark import cloudpickle
    from pyspark.sql import functions as F
    from pyspark.sql.types import ArrayType, StringType

    import test_keyword_model
    from kestrel.functions.keywords import count_keywords
    from kestrel.plans.tables import text_table
    from kestrel.session import get_session

    cloudpickle.register_pickle_by_value(test_keyword_model)
    spark = get_session("local[8]", shuffle_partitions=8)
    docs = text_table(spark, sf_dir, "documents").select("text")
    docs.write.format("noop").mode("overwrite").save()  # warm-up

    def timed(df):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()  # the whole plan, nothing to the driver
        sec = time.perf_counter() - t0
        return sec, sorted((r["keyword"], r["appearances"]) for r in df.collect())

    native_df = count_keywords(docs, "text", [])
    model_udf = F.udf(test_keyword_model.model, ArrayType(StringType()))
    udf_df = (docs.select(F.explode(model_udf("text")).alias("keyword"))
              .groupBy("keyword").agg(F.count("*").alias("appearances")))
    # Alternate the two and keep the second run of each, so neither pays the JVM warm-up alone.
    timed(native_df), timed(udf_df)
    (native_sec, native), (udf_sec, via_udf) = timed(native_df), timed(udf_df)
    print(json.dumps({"sf_dir": sf_dir, "native_sec": round(native_sec, 2), "python_udf_sec": round(udf_sec, 2),
                      "speedup": round(udf_sec / native_sec, 1), "same_result": native == via_udf,
                      "keywords": len(native)}))


if __name__ == "__main__":
    main(sys.argv)

"""Fit and score times at the size of the published numbers: short rows, 320-d vectors, 4 classes.

Every line of every document is a row (95,513 at sf0.1). A word's vector is the
concatenation of five embeddings its hash points to. One fold of five is held out.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from presswork.catalog.registry import CLASSES, LANGUAGES, documents, table
from presswork.functions import text as tx
from presswork.operators import metrics as mt
from presswork.operators import validation as va
from presswork.operators import vectors as vc
from presswork.operators.terms import document_frequencies
from presswork.plans import staged
from presswork.session import local_session

PARTS = 5


def line_vectors(spark, folder):
    lines = documents(spark, folder).select(
        "lang", F.col("doc_id").alias("source"), F.posexplode(F.split("text", "\n")).alias("line", "text")
    )
    category = F.element_at(F.create_map(*[F.lit(v) for p in LANGUAGES.items() for v in p]), F.col("lang"))
    lines = staged(
        lines.select((F.col("source") * 1_000_000 + F.col("line")).alias("doc_id"), category.alias("category"), "text"), "lines"
    )
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("e"))
    n = vectors.count()
    words = document_frequencies(lines, tx.wordpunct_tokens(F.col("text")), 3).select(F.col("term").alias("word"))
    slots = F.array(*[F.pmod(F.xxhash64(F.lit(i), "word"), F.lit(n)) for i in range(PARTS)])
    placed = words.select("word", F.posexplode(slots).alias("i", "vec_id")).join(vectors, "vec_id")
    pieces = F.array_sort(F.collect_list(F.struct("i", "e")))
    words = placed.groupBy("word").agg(F.flatten(F.transform(pieces, lambda p: p["e"])).alias("vector"))
    means = vc.doc_embeddings(lines, tx.wordpunct_tokens(F.col("text")), staged(words, "words"))
    rows = lines.select("doc_id", "category").join(means, "doc_id")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5)).cast("int")
    return staged(rows.withColumn("features", array_to_vector("vec")).withColumn("fold", fold), "lines")


def measure(spark, folder, names=()):
    """rows, dimensions, and per algorithm fit time, score time and micro scores of one fold."""
    rows = line_vectors(spark, folder).repartition(spark.sparkContext.defaultParallelism)
    train, test = rows.where("fold <> 0").persist(), rows.where("fold = 0").persist()
    out = {"rows": train.count() + test.count(), "dimensions": 64 * PARTS}
    for name, fitter in va.standard_fitters().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        score = fitter(train, CLASSES)
        fitted = time.perf_counter()
        row = mt.micro_metrics(score(test)).first()
        out[name] = {
            "fit_time": round(fitted - start, 2),
            "score_time": round(time.perf_counter() - fitted, 2),
            **{m: round(row[m], 4) for m in ("precision", "recall", "f1", "roc_auc")},
        }
        print(name, out[name], file=sys.stderr, flush=True)
    train.unpersist()
    test.unpersist()
    return out


if __name__ == "__main__":
    session = local_session()
    print(json.dumps(measure(session, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1", sys.argv[2:])))
    session.stop()

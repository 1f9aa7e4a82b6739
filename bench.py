"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from presswork.catalog import load
from presswork.catalog.models import document_vectors
from presswork.catalog.registry import CLASSES
from presswork.operators import validation as va
from presswork.plans.stage import clear
from presswork.session import local_session

HEADLINE = [
    "clean_corpus",
    "top_words_by_category",
    "bag_of_words",
    "tfidf_words",
    "tfidf_word_ngrams",
    "tfidf_char_ngrams",
    "anova_scores",
    "selected_tfidf_word_ngrams",
    "word_ids",
    "context_pairs",
    "document_embeddings",
    "similar_pairs",
    "pr_curve",
    "micro_pr_curve",
    "score_sheet",
    "assign_folds",
    "gaussian_naive_bayes",
    "grid_search_naive_bayes",
    "multinomial_naive_bayes",
    "explain_linear",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores)
    catalog = load()
    times: dict[str, float] = {}

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    spark.read.parquet(f"{folder}/documents.parquet").count()
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    for name in names:
        times[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    details: dict[str, object] = {}
    if not sys.argv[1:]:
        rows = document_vectors(spark, folder)
        details["cv_rows"] = rows.count()
        for algo, fitter in va.standard_fitters().items():
            start = time.perf_counter()
            results = va.cross_validate(rows, {algo: fitter}, CLASSES).collect()
            label = "cv5_" + algo.lower().replace("/", "_").replace(" ", "_")
            times[label] = round(time.perf_counter() - start, 3)
            for metric in ("test_precision", "test_recall", "test_f1", "test_roc_auc"):
                values = [r.value for r in results if r.metric == metric]
                details[f"{label}_{metric}"] = round(statistics.mean(values), 4)
            print(f"{label} {times[label]}", file=sys.stderr, flush=True)

    # one fold at the size of the published numbers
    if not sys.argv[1:]:
        sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tools"))
        from reference_scale import measure

        for algo, values in measure(spark, folder).items():
            label = "line_fold_" + algo.lower().replace("/", "_").replace(" ", "_")
            details[label] = values
            if isinstance(values, dict):
                times[f"{label}_fit"], times[f"{label}_score"] = values["fit_time"], values["score_time"]

    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "details": details,
            }
        )
    )
    clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()

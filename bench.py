"""Times the headline queries, the dearest last, and prints a JSON line of all so far after each of them.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. ``select_models`` is model selection over all ten families
with their default settings, on a pool of 1,500 rows at scale factor 0.1.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verbalis.plans.queries import QUERIES  # noqa: E402
from verbalis.session import local_session  # noqa: E402

HEADLINE = (
    "tokens",
    "lemma_phrases",
    "word_freq",
    "bigram_freq",
    "bigram_collocations",
    "trigram_collocations",
    "row_features",
    "split_stratified",
    "kfold_assign",
    "term_vocab",
    "tfidf_l2",
    "feature_table",
    "chi2_scores",
    "f_scores",
    "mi_scores",
    "select_k_best",
    "separating_words",
    "knn_predict",
    "cv_predictions",
    "clf_logistic",
    "clf_random_forest",
    "clf_extra_trees",
    "select_models",
    "fit_classifier",
    "score_documents",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "12g"), "bench")
    spark.read.parquet(f"{folder}/documents.parquet").selectExpr("sum(length(text))").collect()
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        out = {
            "metric": "total time of the headline queries",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(folder.rstrip("/")),
        }
        if "score_documents" in seconds:
            out["scored_rows_per_sec"] = round(documents / seconds["score_documents"], 1)
        print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()

"""Benchmark: per-model fit / recommend times plus the headline analytic queries.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_ONLY (comma-separated subset of keys, optional).

Prints ONE JSON line.  ``queries`` holds seconds per key:

* ``<model>_fit``        fit on the whole ``items`` catalogue (store cleared first)
* ``<model>_recommend``  recommendations for the 20 sampled query items, collected,
                         divided by 20 (per-query latency, as the reference reports it)
* ``q_*``                end-to-end registered queries (fit included where they fit)

The forest and the MLP use the reference's pre-trained parameter set (50 trees of
depth 8 on 500 terms; (128, 64) hidden units, 100 epochs); the other four use its
library parameters.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.operators import models  # noqa: E402
from marquee.plans import registry as R  # noqa: E402
from marquee.session import cut_lineage, get_session  # noqa: E402

MODELS = {
    "content_based": models.LIBRARY["content_based"],
    "knn": models.LIBRARY["knn"],
    "linear": models.LIBRARY["linear"],
    "svd": models.LIBRARY["svd"],
    "random_forest": models.PRETRAINED["random_forest"],
    "neural": models.PRETRAINED["neural"],
}

QUERIES = {
    "q_content_based": R.q_content_based,
    "q_knn_manhattan": R.q_knn_manhattan,
    "q_knn_embeddings_cosine": R.q_knn_embeddings_cosine,
    "q_ridge_two_features": R.q_ridge_two_features,
    "q_nearest_by_value": R.q_nearest_by_value,
    "q_comparison_score": R.q_comparison_score,
    "q_agreement_matrix": R.q_agreement_matrix,
    "q_catalog_union": R.q_catalog_union,
    "q_describe": R.q_describe,
    "q_correlation_matrix": R.q_correlation_matrix,
    "q_genre_distribution": R.q_genre_distribution,
    "q_rating_histogram": R.q_rating_histogram,
}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [s for s in os.environ.get("BENCH_ONLY", "").split(",") if s]
    spark = get_session(f"local[{cpus}]", cpus)
    items = R._items(spark, sf_dir)
    # Warm-up, not timed: JIT-compiles the scan, tokeniser, aggregation and
    # top-k code paths on a small slice of the same table.
    warm = items.orderBy("item_id").limit(300)
    wq = R._queries(warm)
    models.fit_model("content_based", warm).recommend(wq, R.N_RECS).collect()
    models.fit_model("knn", warm).recommend(wq, R.N_RECS).collect()
    times = {}

    def want(key):
        return not only or any(key.startswith(o) for o in only)

    queries = cut_lineage(R._queries(items))
    n_q = max(queries.count(), 1)
    for name, params in MODELS.items():
        if not want(name):
            continue
        models.clear_store()
        t0 = time.perf_counter()
        fm = models.fit_model(name, items, params)
        times[f"{name}_fit"] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        fm.recommend(queries, R.N_RECS).collect()
        times[f"{name}_recommend"] = round((time.perf_counter() - t0) / n_q, 4)
        print(f"# {name}: fit {times[f'{name}_fit']}s, recommend {times[f'{name}_recommend']}s/query",
              file=sys.stderr, flush=True)
    for key, fn in QUERIES.items():
        if not want(key):
            continue
        models.clear_store()
        R._RECS.clear()
        t0 = time.perf_counter()
        fn(spark, sf_dir).collect()
        times[key] = round(time.perf_counter() - t0, 3)
        print(f"# {key}: {times[key]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}
    print(json.dumps(out))


if __name__ == "__main__":
    main()

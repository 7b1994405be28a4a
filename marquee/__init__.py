"""marquee: content-recommendation analytics expressed as Spark DataFrame jobs.

Layout
------
sources/    table readers/writers and the catalogue adapters built from them
functions/  column expressions (JSON lists, text features, score arithmetic)
operators/  DataFrame-in / DataFrame-out operators (cleaning, statistics,
            top-k, TF-IDF, similarity, regressors, SVD, MLP, evaluation)
plans/      composed queries registered with the driver and their SQL oracles
streaming/  incremental catalogue ingestion with Structured Streaming
"""

__version__ = "0.1.0"

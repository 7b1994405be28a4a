"""The network learns from every training document."""

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import attention, lm
from marquee.llm.common import tokenizer_path


def test_every_training_document_trains(spark):
    """Each document alone moves the parameters, held-out ones do not."""
    cls = attention.classes_of(np.ones(60_000, np.int64))[0]
    ids = spark.range(40).select(F.col("id").alias("doc_id"), lm.held_out(F.col("id")).alias("held"),
                                 (F.pmod(F.xxhash64("id"), F.lit(64)) == 0).alias("one_in_64")).collect()
    trained = [r.doc_id for r in ids if not r.held and not r.one_in_64][:4]
    held = [r.doc_id for r in ids if r.held][:1]
    start = attention.flat(attention.new_params())
    for k in trained + held:
        docs = spark.createDataFrame([(k, "some words to learn from " * 4)], "doc_id long, text string")
        moved = not np.array_equal(attention.flat(lm.train_model(docs, tokenizer_path(), cls)), start)
        assert moved == (k in trained)


def test_chunks_hold_the_windows_of_the_whole_text():
    rng = np.random.default_rng(5)
    seqs = [rng.integers(0, attention.END, n).astype(np.int16) for n in (0, 1, 15, 16, 17, 31, 32, 33, 500, 1023, 1024)]
    inputs, targets, _ = attention.cut_windows(seqs)
    for windows in (1, 3, 32):
        parts = [c for s in seqs for c in attention.chunks(s, windows)]
        assert max(len(c) for c in parts) <= attention.STEP * windows + attention.CONTEXT + 1
        got = attention.cut_chunks(parts)
        assert np.array_equal(got[0], inputs) and np.array_equal(got[1], targets)


def test_score_is_the_sum_of_plain_attention_steps(spark, documents, docs_rows, monkeypatch):
    """Each token's probability by a loop over the inputs that it sees, from the parameters that were trained."""
    kept = []
    real = lm.train_on
    monkeypatch.setattr(lm, "train_on", lambda *a: kept.append(real(*a)) or kept[-1])
    shares = []
    classes = attention.classes_of
    monkeypatch.setattr(attention, "classes_of", lambda c: shares.append(classes(c)) or shares[-1])
    out = {r.doc_id: r.score for r in lm.score_documents(documents, tokenizer_path()).collect()}
    p, (cls, share) = kept[0], shares[0]
    p = {k: v.astype(float) for k, v in p.items()}
    from marquee.llm import bpe
    texts = {k: t for k, t in docs_rows if k in (1, 2, 4, 6, 12, 13, 100)}
    for key, ids in zip(texts, bpe.load(tokenizer_path()).encode([t or "" for t in texts.values()])):
        ids = np.frombuffer(ids, "<u4")
        seq = [attention.START, *cls[ids].tolist()]
        goals, total = [*cls[ids].tolist(), attention.END], share[ids].sum()
        for n, goal in enumerate(goals):
            begin = n // attention.STEP * attention.STEP - attention.CONTEXT       # the window's first input
            seen = [(j, j - begin) for j in range(max(0, begin), n + 1)]
            x = np.array([p["emb"][seq[j]] + p["pos"][place] for j, place in seen])
            a = (x @ p["k"]) @ (x[-1] @ p["q"]) / attention.DIM**0.5
            a = np.exp(a - a.max())
            h = np.append(x[-1] + (a / a.sum()) @ (x @ p["v"]) @ p["o"], 1.0)
            for scores, chosen in ((h @ p["group"], goal // attention.MEMBERS),
                                   (h @ p["member"][goal // attention.MEMBERS], goal % attention.MEMBERS)):
                total += (scores[chosen] - np.log(np.exp(scores).sum())) / np.log(10)
        assert abs(out[key] - total) < 1e-3 * max(1, abs(total)), key

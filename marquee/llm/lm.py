"""Language-model scores of documents (operator 6).

Method.  A causal self-attention model in numpy on subword ids (``attention``).  Documents whose crc32(doc_id) mod 7
is not 2 train it, the others are held out.

1. All words of the training documents are counted (combined per batch, then by a shuffle).  Subword counts follow
   from the word counts, since the tokenizer never joins across white space; they give the token classes.
2. One pass over all texts stores their token classes and the sum over frequent words.  The words' counts are at hand
   for at most ``KNOWN`` words of at most ``KNOWN_BYTES`` bytes; all other words meet their counts in a join, in which
   no key can be frequent.
3. All training documents' classes are cut into chunks of windows, dealt by a hash to partitions and rounds, so that the
   rounds together are one pass over the training text.  In each round every partition trains from the common
   parameters, and the partitions' parameters are averaged by a Spark aggregation (as many numbers as the model has).
4. The stored classes are scored.

Defined results: null text is the empty text, which has the end token only; a null doc_id counts as the text '';
repeated rows train and are scored one by one; very long texts are cut into chunks for training and scored whole; an
empty table gives no rows.  A table too small to give a round any window leaves the parameters as they were drawn.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attention, bpe
from .common import parallelism, stored

TRAIN_EVERY = 1              # all training documents
STEPS = 128                  # least number of steps per round and part of a partition
LEAST, BATCH = 32, 256       # windows per step: as many as give STEPS steps, between these
CHUNK = 32                   # windows that are dealt together
PART = 2500                  # chunks that a task holds as windows at once
RATES = (0.02, 0.012, 0.006, 0.002)       # one round each, a share of the windows each
KNOWN, KNOWN_BYTES = 100_000, 64
DISTINCT = 100_000           # distinct words that a task counts before it passes them on
END_WORD = b""               # a word is never empty, so this stands for the end of a text
SLICE = 300


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()       # bytes: A-Z only, and exactly the six ASCII blanks


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the training documents, the end of each text included."""

    def count(batches):
        seen: Counter = Counter()

        def counted():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                             ["word", "c"])
            seen.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.column(0).slice(at, SLICE).to_pylist():
                    seen.update(words_of(text))
                    seen[END_WORD] += 1
                    if len(seen) > DISTINCT:
                        yield counted()
        yield counted()

    rows = docs.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("string")).mapInArrow(
        count, "word binary, c long")
    return stored(rows.groupBy("word").agg(F.sum("c").alias("c")), "words")


def token_counts(words: DataFrame, path: str) -> np.ndarray:
    """How often each id occurs in the training documents; a number per vocabulary entry reaches the driver."""

    def count(batches):
        encoder = bpe.load(path)
        for batch in batches:
            total = np.zeros(encoder.size, np.float64)
            for at in range(0, batch.num_rows, 20_000):
                c = batch.column(1).slice(at, 20_000).to_numpy()
                ids = encoder.encode([w.decode() for w in batch.column(0).slice(at, 20_000).to_pylist()])
                n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                total += np.bincount(np.frombuffer(b"".join(ids), "<u4"), np.repeat(c, n), minlength=encoder.size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["id", "n"])

    found = words.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(bpe.load(path).size, np.int64)
    for r in found:
        out[r.id] = r.n
    return out


def train_model(docs: DataFrame, path: str, cls: np.ndarray, every: int = TRAIN_EVERY) -> dict[str, np.ndarray]:
    """Parameters from the training rows of ``docs(doc_id, text)``, with the class of every token id."""

    def encode(batches):
        encoder = bpe.load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                ids = encoder.encode([x or "" for x in batch.column(1).slice(at, SLICE).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, SLICE), pa.array([cls[np.frombuffer(x, "<u4")].astype("<i2").tobytes() for x in ids],
                                                                pa.binary())], ["doc_id", "classes"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return train_on(rows.mapInArrow(encode, "doc_id long, classes binary"), every)


def train_on(classes: DataFrame, every: int = TRAIN_EVERY) -> dict[str, np.ndarray]:
    """Parameters from the training rows of ``classes(doc_id, classes)``."""

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                keys = batch.column(0).slice(at, SLICE)
                parts = [attention.chunks(np.frombuffer(x, "<i2"), CHUNK) for x in batch.column(1).slice(at, SLICE).to_pylist()]
                owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                rows = [x.tobytes() for p in parts for x in p]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(owner)), pa.array(np.arange(len(rows))), pa.array(rows, pa.binary())],
                    ["doc_id", "place", "chunk"])

    chosen = classes.where(~held_out(F.col("doc_id"))).where(
        F.pmod(F.xxhash64(F.col("doc_id")), F.lit(every)) == 0)
    chunks = chosen.select("doc_id", "classes").mapInArrow(cut, "doc_id long, place long, chunk binary")
    # Dealt evenly, in a fixed order: a lost partition trains the same model again.
    turn = F.pmod(F.xxhash64("doc_id", "place", "chunk"), F.lit(len(RATES))).cast("int")
    chunks = stored(chunks.repartition(parallelism(classes.sparkSession), "doc_id", "place").select(
        "doc_id", "place", "chunk", turn.alias("turn")), "chunks")
    params = attention.new_params()
    for turn, rate in enumerate(RATES):

        def fit(batches, params=params, rate=rate):
            # A partition's windows come in bounded batches; each goes on from where the last one ended.
            p, n = params, 0
            for batch in batches:
                for at in range(0, batch.num_rows, PART):
                    x = attention.cut_chunks([np.frombuffer(c, "<i2") for c in batch.column(0).slice(at, PART).to_pylist()])
                    size = min(BATCH, max(LEAST, len(x[0]) // STEPS))
                    p = attention.train(p, *x, STEPS, size, rate * (size / 64)**0.5, n)
                    n += len(x[0])
            if n:
                w = attention.flat(p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(w))), pa.array(w.astype(np.float64) * n), pa.array(np.full(len(w), n))],
                    ["at", "w", "n"])

        rows = chunks.where(F.col("turn") == turn).sortWithinPartitions("doc_id", "place", "chunk").select("chunk")
        total = rows.mapInArrow(fit, "at long, w double, n long").groupBy("at").agg(
            (F.sum("w") / F.sum("n")).alias("w")).collect()
        if not total:
            continue
        mean = np.zeros(len(total))
        for r in total:
            mean[r["at"]] = r.w
        params = attention.shaped(mean)
    return params


def frequent_words(words: DataFrame, most: int = KNOWN) -> dict[bytes, int]:
    """Counts of the most frequent words, at most ``most`` of at most ``KNOWN_BYTES`` bytes each."""
    short = words.where(F.octet_length("word") <= KNOWN_BYTES)
    level = F.floor(F.log2("c") * 16).cast("int")
    kept, least = 0, None
    for r in sorted(short.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        kept += r.n
        if kept > most:
            break
        least = r.level
    if least is None:
        return {}
    return {bytes(r.word): r.c for r in short.where(level >= least).collect()}


def score_documents(docs: DataFrame, path: str, every: int = TRAIN_EVERY) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = word_counts(docs)
    n_all, n_distinct = (x or 0 for x in words.agg(F.sum("c"), F.count(F.lit(1))).first())
    counts = token_counts(words, path)
    cls, share = attention.classes_of(counts)
    ready = spark.sparkContext.broadcast((frequent_words(words), cls, share))
    base = float(np.log10(n_all + n_distinct + 1))

    def encode(batches):
        known, cls, share = ready.value
        value = {w: float(np.log10(c + 1)) for w, c in known.items()}
        end_share = value.get(END_WORD)
        encoder = bpe.load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                texts = batch.column(1).slice(at, SLICE).to_pylist()
                ids = [np.frombuffer(x, "<u4") for x in encoder.encode([x or "" for x in texts])]
                rows = []
                for text in texts:
                    cut = words_of(text)
                    found = list(map(value.get, cut))
                    missed = found.count(None)
                    rare: Counter = Counter([w for w, v in zip(cut, found) if v is None] if missed else ())
                    total = sum(filter(None, found)) - base * (len(cut) + 1)
                    if end_share is None:
                        rare[END_WORD] += 1
                    else:
                        total += end_share
                    rows.append((len(cut) + 1, len(cut) - missed + (end_share is not None), total, list(rare.items())))
                n, k, total, rare = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, SLICE), pa.array(n, pa.int64()), pa.array(k, pa.int64()),
                     pa.array(total, pa.float64()), pa.array([float(share[x].sum()) for x in ids], pa.float64()),
                     pa.array([cls[x].astype("<i2").tobytes() for x in ids], pa.binary()),
                     pa.array([[{"word": w, "n": c} for w, c in x] for x in rare],
                              pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))],
                    ["doc_id", "n_tokens", "n_sure", "sure", "share", "classes", "rare"])

    rows = docs.mapInArrow(encode, "doc_id long, n_tokens long, n_sure long, sure double, share double, classes binary, "
                                   "rare array<struct<word:binary,n:bigint>>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")
    trained = spark.sparkContext.broadcast(train_on(rows.select("doc_id", "classes"), every))

    def score(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                seqs = [np.frombuffer(x, "<i2") for x in batch.column(2).slice(at, SLICE).to_pylist()]
                inputs, targets, owner = attention.cut_windows(seqs)
                lp = attention.log10_probabilities(trained.value, inputs, targets).sum(axis=1)
                model = np.bincount(owner, lp, minlength=len(seqs)) + batch.column(1).slice(at, SLICE).to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, SLICE), pa.array(model)], ["row", "score"])

    scores = stored(rows.select("row", "share", "classes").mapInArrow(score, "row long, score double"), "scores")
    rows = rows.drop("classes").join(scores, "row")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(words, "word")
    rare = rare.groupBy("row").agg(F.sum("n").alias("n_rare"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    out = rows.drop("rare").join(rare, "row", "left")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
                      (F.col("n_sure") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
                      F.lit(n_all).cast("long").alias("train_tokens"),
                      (F.col("sure") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")

"""Spelling variant grouping by blocked Gram matrices of letter counts (operator 11).

Method.  Words are counted by Spark.  A word's letters, counted in ``CLASSES`` letter classes, name its block; so a
block's words have one length.  One edit changes at most two of these counts by one, so near words lie in the same
block, in a block of the next length (one class more), or in one of the same length (one class more, one less).  Each
word is a member of its own block and a guest of the neighbouring ones, each unordered pair of blocks once.  In a task
the letter counts of a block's members and guests are multiplied (a Gram matrix), which gives the squared distances of
all counts; pairs at a distance of one (next length) or two (same length) are verified letter by letter.  A block of
over ``MEMBERS`` words is cut into chunks that are compared in different tasks; nothing is left out.

A task holds one chunk's members and one Arrow batch of guests.  Forms point to words at least twice as frequent, so
following them by doubling ends after a few joins.

Defined results: null and empty texts have no words; a null doc_id counts as the empty text in the hash; rows with the
same doc_id each count; very long texts and runs are taken whole (a chunk's size falls with the words' length); an
empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .line_dedup import LOWER, UPPER

LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT, DAMAGE = 5, 3, 97
CLASSES = 8
MEMBERS = 1024               # of a block's chunk
CELLS = 1 << 22              # letters of a chunk, and of a slice of pairs under verification
SLICE = 2048                 # guests multiplied at once
SMALL = 100_000              # rows of the table of large blocks that may be broadcast
MEMBER, SAME, SHORTER = 0, 1, 2

_DIMS = np.zeros(256, np.int64)
_DIMS[[*range(97, 123), *range(192, 256)]] = np.arange(90)


def count_words(docs: DataFrame, damage: int = DAMAGE, min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all damaged words that are long and frequent enough."""
    # An outer explode: for an inner one the optimizer infers a filter that searches every text once more.
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode_outer(
        F.regexp_extract_all(F.col("text").cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= min_letters).withColumn("run", F.translate("run", UPPER, LOWER))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    cut = F.pmod("h", F.length("run")).cast("int")
    word = F.when(F.col("h") % damage == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring(
        "run", cut + 2, F.length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _matrix(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _counted(letters: np.ndarray, dims: np.ndarray, width: int) -> np.ndarray:
    """How often each row holds each of ``width`` dimensions."""
    rows = np.arange(len(letters))[:, None] * width
    return np.bincount((rows + dims[letters]).ravel(), minlength=len(letters) * width).reshape(len(letters), width)


def _places(words: list[bytes], classes: int, guests: bool):
    """(row, kind, block) of every place of the words."""
    sizes = np.array([len(w) for w in words])
    counts = np.zeros((len(words), classes), np.int64)
    for size in np.unique(sizes):
        same = np.flatnonzero(sizes == size)
        step = max(1, CELLS // int(size))
        for at in (same[k:k + step] for k in range(0, len(same), step)):
            counts[at] = _counted(_matrix([words[k] for k in at]), np.arange(256) % classes, classes)
    rows = np.arange(len(words))
    yield rows, MEMBER, counts
    for more in range(classes if guests else 0):
        up = counts.copy()
        up[:, more] += 1
        yield rows, SHORTER, up
        for less in range(more + 1, classes):
            at = np.flatnonzero(counts[:, less])
            moved = up[at]
            moved[:, less] -= 1
            yield at, SAME, moved


def placed(words: DataFrame, classes: int, guests: bool) -> DataFrame:
    """``words(letters, n)`` in their own blocks and, with ``guests``, in the neighbouring ones."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            letters, n = batch.column(0), batch.column(1)
            for rows, kind, block in _places(letters.to_pylist(), classes, guests):
                names = block.astype(">i4").tobytes()
                width = 4 * classes
                block_col = pa.array([names[k:k + width] for k in range(0, len(names), width)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [block_col, pa.array(np.full(len(rows), kind, np.int32)), letters.take(pa.array(rows)),
                     n.take(pa.array(rows))], ["block", "kind", "letters", "n"])

    return words.select("letters", "n").mapInArrow(run, "block binary, kind int, letters binary, n long")


def dealt(words: DataFrame, classes: int = CLASSES, members: int = MEMBERS) -> DataFrame:
    """(block, chunk, kind, letters, n), each chunk with all guests it has to meet."""
    limit = F.greatest(F.lit(1), F.least(F.lit(members), F.floor(F.lit(CELLS) / F.max(F.length("letters")))))
    sizes = placed(words, classes, False).groupBy("block").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("chunks"))
    large = stored(sizes.where("chunks > 1"), "large-blocks")
    if large.count() <= SMALL:
        large = F.broadcast(large)
    own = F.pmod(F.xxhash64("letters"), F.col("chunks")).cast("int")
    # A member meets the chunks before its own as a guest; a guest from another block meets all.
    meets = F.when(F.col("kind") == MEMBER, F.transform(F.sequence(F.lit(0), own), lambda k: F.struct(
        k.alias("chunk"), F.when(k < own, SAME).otherwise(MEMBER).alias("kind")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct(
            k.alias("chunk"), F.col("kind").alias("kind"))))
    rows = placed(words, classes, True).join(large, "block", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    return rows.select("block", F.explode(meets).alias("to"), "letters", "n").select(
        "block", "to.chunk", "to.kind", "letters", "n")


def _one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the letters of each row of ``y`` (as long as ``x`` or one shorter) are one edit from those of ``x``."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(axis=1) == 1
    width = y.shape[1]
    front, back = x[:, :width] != y, (x[:, 1:] != y)[:, ::-1]
    before = np.where(front.any(axis=1), front.argmax(axis=1), width)
    behind = np.where(back.any(axis=1), back.argmax(axis=1), width)
    return before + behind >= width


def near_pairs(x: np.ndarray, y: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of letter matrices that are one edit apart; within ``x`` (i > j) if ``y`` is None.

    The Gram matrix of the letter counts gives all squared distances; those that one edit can make are verified.
    """
    other = x if y is None else y
    wide = np.float32 if x.shape[1] < 4000 else np.float64            # exact below 2**24
    left, right = (_counted(z, _DIMS, 90).astype(wide) for z in (x, other))
    gram = left @ right.T
    square = (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1) - 2 * gram
    close = square == (2 if x.shape[1] == other.shape[1] else 1)
    if y is None:
        close &= np.tri(len(x), len(x), -1, dtype=bool)
    i, j = np.nonzero(close)
    step = max(1, CELLS // x.shape[1])
    fine = [_one_edit(x[i[k:k + step]], other[j[k:k + step]]) for k in range(0, len(i), step)]
    fine = np.concatenate([np.zeros(0, bool), *fine])
    return i[fine], j[fine]


class _Best:
    """Per word: near words so far, and the most frequent of them (ties: smallest)."""

    def __init__(self):
        self.found: dict[bytes, tuple[int, int, bytes]] = {}

    def add(self, words, n, others, m) -> None:
        for w, k, v, l in zip(words, n, others, m):
            for a, b, c in ((w, v, l), (v, w, k)):
                seen, least, best = self.found.get(a, (0, 1, b""))
                self.found[a] = (seen + 1, *min((least, best), (-c, b)))

    def batch(self) -> pa.RecordBatch:
        rows = [(a.decode("latin-1"), seen, -least, best.decode("latin-1")) for a, (seen, least, best) in self.found.items()]
        self.found = {}
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        cols = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          ["word", "n_near", "best_n", "best"])


def _pieces(batches):
    """(key, kind, letters, n) of each run of rows of one block, chunk and kind within a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, letters = batch.column("block").to_pylist(), batch.column("letters").to_pylist()
        chunk, kind, n = (batch.column(c).to_numpy() for c in ("chunk", "kind", "n"))
        names = _matrix(blocks).view(">i4")
        new = (names[1:] != names[:-1]).any(axis=1) | (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            yield (blocks[a], int(chunk[a])), int(kind[a]), letters[a:b], n[a:b].tolist()


def compared(rows: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): partial results of every chunk of ``dealt`` rows."""

    def run(batches):
        best, key, words, counts, matrix = _Best(), None, [], [], None

        def close():
            i, j = near_pairs(matrix)
            best.add([words[k] for k in i], [counts[k] for k in i], [words[k] for k in j], [counts[k] for k in j])

        for name, kind, letters, n in _pieces(batches):
            if name != key:
                if words and matrix is None:
                    matrix = _matrix(words)
                    close()
                key, words, counts, matrix = name, [], [], None
            if kind == MEMBER:
                words, counts = words + letters, counts + n
                continue
            if not words:
                continue
            if matrix is None:
                matrix = _matrix(words)
                close()
            step = max(1, min(SLICE, CELLS // len(letters[0])))
            for at in range(0, len(letters), step):
                i, j = near_pairs(matrix, _matrix(letters[at:at + step]))
                best.add([words[k] for k in i], [counts[k] for k in i], [letters[at + k] for k in j], [n[at + k] for k in j])
            if len(best.found) > 50_000:
                yield best.batch()
        if words and matrix is None:
            matrix = _matrix(words)
            close()
        yield best.batch()

    rows = rows.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "kind")
    return rows.mapInArrow(run, "word string, n_near long, best_n long, best string")


def with_roots(words: DataFrame) -> DataFrame:
    """``words(word, form, ...)`` with ``root``: the last word that following the forms reaches."""
    jumps = stored(words.where("form is not null").select("word", F.col("form").alias("root")), "jumps")
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if not jumps.join(further, "root", "left_semi").take(1):
            break
        jumps = stored(jumps.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root")), "jumps")
    return words.join(jumps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_spellings(docs: DataFrame, classes: int = CLASSES, members: int = MEMBERS, damage: int = DAMAGE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every counted word of ``docs(doc_id, text)``."""
    words = stored(count_words(docs, damage), "words")
    letters = words.select(F.encode("word", "ISO-8859-1").alias("letters"), "n")
    near = compared(dealt(letters, classes, members)).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    form = F.col("b.m") * -1 >= 2 * F.col("n")
    joined = stored(words.join(near, "word", "left").select(
        "word", F.when(form, F.col("b.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form, -F.col("b.m")).alias("form_n")), "forms")
    return with_roots(joined).select("word", "form", "root", "n", "n_near", "form_n")

"""Line dedup over levelled sorted runs, DataFrame operations only (operator 5).

Method.  The lines' keys become 128-bit hashes.  Documents come in batches by ascending doc_id.  An index of earlier
lines is a list of runs (hash, owner), sorted by hash and without a hash in common.  A batch reduces its lines to each
hash's smallest doc_id, merge-anti-joins that with the runs and adds what is new as a run of level 0; whenever
``fanout`` runs share a level they are compacted into one of the next.  A line is dropped if its hash belongs to
another document.  Only hashes and places are shuffled for this; texts move once, to meet the places of their dropped
lines.

Defined results: null or empty text is one empty line; a null doc_id counts as the largest id; rows with the same
doc_id are one document; an empty table gives no rows.  A document whose lines all go keeps the empty text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_row

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, version, pos, h1, h2) of every line with a key of at least ``min_chars`` code points; ``version`` tells
    rows of one doc_id with different texts apart."""
    lines = docs.select("doc", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = lines.select("doc", "version", "pos", line_key(F.col("line")).alias("key")).where(
        F.length("key") >= min_chars)
    return key.select("doc", "version", "pos", F.xxhash64("key").alias("h1"),
                      F.xxhash64(F.lit("second"), "key").alias("h2"))


class LineIndex:
    """Levelled sorted runs of (h1, h2, owner)."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.levels = fanout, {}

    def runs(self) -> list[DataFrame]:
        return [r for level in sorted(self.levels) for r in self.levels[level]]

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes the hashed lines of one batch (a stored table, doc ids above all earlier ones) into the index;
        returns the lines to drop."""
        fresh = lines.groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
        for run in self.runs():
            fresh = fresh.join(run, ["h1", "h2"], "left_anti")
        self.levels.setdefault(0, []).append(self._sorted_run(fresh))
        owners = reduce(DataFrame.unionAll, self.runs())
        dropped = lines.join(owners, ["h1", "h2"]).where("doc != owner").select("doc", "version", "pos")
        dropped = stored(dropped, "dropped")
        self._compact()
        return dropped

    @staticmethod
    def _sorted_run(rows: DataFrame) -> DataFrame:
        return stored(rows.sortWithinPartitions("h1", "h2"), "run")

    def _compact(self) -> None:
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            merged = reduce(DataFrame.unionAll, self.levels.pop(level))
            self.levels.setdefault(level + 1, []).append(self._sorted_run(merged.repartition("h1", "h2")))
            level += 1


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``_text`` (kept lines), ``_n_lines`` and ``_n_dropped``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(whole_row(docs).alias("row"), text.alias("text"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"))
    keyed = keyed.withColumn("version", F.xxhash64("text"))
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), [k / batches for k in range(1, batches)],
                                           1000).alias("c")).first().c or []
    batch = reduce(lambda a, b: a + b, [(F.col("doc") > c).cast("int") for c in cuts], F.lit(0))
    lines = stored(hashed_lines(keyed, min_chars).withColumn("batch", batch), "lines")
    index = LineIndex()
    dropped = [index.add(lines.where(F.col("batch") == b).drop("batch")) for b in range(len(cuts) + 1)]
    places = reduce(DataFrame.unionAll, dropped).groupBy("doc", "version").agg(
        F.array_sort(F.collect_set("pos")).alias("gone"))
    out = keyed.join(places, ["doc", "version"], "left")
    none = F.array().cast("array<int>")
    out = out.select("row", "text", F.coalesce("gone", none).alias("gone"), F.split("text", "\n").alias("lines"))
    # Kept lines are what lies between two dropped ones.
    out = out.withColumn("cuts", F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("lines"))))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("gone")), lambda i: F.slice(
        "lines", F.col("cuts")[i] + 2, F.col("cuts")[i + 1] - F.col("cuts")[i] - 1)))
    return out.select("row", F.when(F.size("gone") == 0, F.col("text")).otherwise(
        F.array_join(kept, "\n")).alias("_text"), F.size("lines").cast("long").alias("_n_lines"),
        F.size("gone").cast("long").alias("_n_dropped"))

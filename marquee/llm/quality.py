"""Quality rules as a short-circuit cascade (operator 3).

Method.  Each rule rejects a document by a few of its features.  On a sample (the documents whose hashed id is
divisible by ``SAMPLE_EVERY``) every rule is run alone, its time and its rejections are counted, and the rules are
ordered by rejections per second.  The cascade then tries them in that order and stops at a document's first
rejection.  The order changes the cost, never the verdict.

Words are maximal runs of bytes other than the six ASCII blanks.  Defined results: null text has no words and is
rejected; the empty table gives no rows; repeated rows are judged one by one.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import whole_row

SAMPLE_EVERY = 64
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


class Document:
    """A text whose features are computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.found: dict[str, int] = {}

    def __getitem__(self, name: str) -> int:
        if name not in self.found:
            self.found[name] = getattr(self, "_" + name)()
        return self.found[name]

    def _words(self) -> list[bytes]:
        return self.text.encode().split()               # bytes split at exactly the six ASCII blanks

    def _n_words(self) -> int:
        return len(self["words"])

    def _word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    def _n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    def _n_shouts(self) -> int:
        return self.text.count("!")

    def _n_lines(self) -> int:
        return sum(1 for x in self.text.split("\n") if x.strip(BLANKS))

    def _n_dup_lines(self) -> int:
        lines = [x for x in self.text.split("\n") if x.strip(BLANKS)]
        return len(lines) - len(set(lines))

    def _n_repeat_words(self) -> int:
        """Words inside 3-word windows that occur twice or more in the text."""
        w = self["words"]
        windows = list(zip(w, w[1:], w[2:]))
        seen = Counter(windows)
        if len(seen) == len(windows):
            return 0
        n, covered = 0, 0                               # covered: words before this place are counted already
        for k, x in enumerate(windows):
            if seen[x] > 1:
                n += k + 3 - max(k, covered)
                covered = k + 3
        return n


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


BASE = (
    Rule("too_short", lambda d: d["n_words"] < 50),
    Rule("repetitive", lambda d: 100 * d["n_repeat_words"] > 50 * d["n_words"]),
)
RULES = (
    *BASE,
    Rule("symbols", lambda d: 10 * d["n_symbols"] > d["n_words"]),
    Rule("shouting", lambda d: 5 * d["n_shouts"] > d["n_words"]),
    Rule("duplicate_lines", lambda d: 10 * d["n_dup_lines"] > 3 * d["n_lines"]),
    Rule("word_length", lambda d: not 2 * d["n_words"] <= d["word_chars"] <= 20 * d["n_words"]),
)
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ordered_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, every: int = SAMPLE_EVERY) -> tuple[Rule, ...]:
    """The rules by rejections per second on the sample, best first."""

    def measure(batches):
        for batch in batches:
            texts = batch.column(0)
            rows = []
            for rule in rules:
                began = time.perf_counter_ns()
                rejected = sum(rule.rejects(Document(texts[k].as_py())) for k in range(len(texts)))
                rows.append((rule.name, rejected, time.perf_counter_ns() - began))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["name", "rejected", "ns"])

    sample = docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(every)) == 0).select(
        F.col("text").cast("string"))
    seen = {r.name: (r.rejected, r.ns) for r in sample.mapInArrow(measure, "name string, rejected long, ns long")
            .groupBy("name").agg(F.sum("rejected").alias("rejected"), F.sum("ns").alias("ns")).collect()}
    return tuple(sorted(rules, key=lambda r: -seen[r.name][0] / seen[r.name][1] if r.name in seen else 0))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Every row of ``docs`` as ``row`` with ``kept``, ``base_failed`` and the features asked for (they are completed
    after the verdict; ask for none to leave out what the cascade did not need)."""
    order = ordered_rules(docs, rules)

    def verdict(text: str | None) -> tuple:
        # A document's words live no longer than its verdict; a batch keeps numbers only.
        d = Document(text)
        kept = not any(r.rejects(d) for r in order)
        if not features:
            return (kept,)
        return (kept, not kept and any(r.rejects(d) for r in BASE), *(d[f] for f in features))

    def run(batches):
        for batch in batches:
            row = batch.column(0)
            text = row.field("text").cast(pa.string())
            cols = list(zip(*(verdict(text[k].as_py()) for k in range(len(text))))) or [()] * len(made)
            yield pa.RecordBatch.from_arrays([row, *(pa.array(c, t) for c, t in zip(cols, made.values()))],
                                             ["row", *made])

    made = {"kept": pa.bool_()} | ({"base_failed": pa.bool_()} | dict.fromkeys(features, pa.int64()) if features else {})
    assert {r.name for r in BASE} <= {r.name for r in rules}
    rows = docs.select(whole_row(docs).alias("row"))
    kind = StructType([*rows.schema.fields, StructField("kept", BooleanType())])
    if features:
        kind = StructType([*kind.fields, StructField("base_failed", BooleanType()), *(StructField(f, LongType()) for f in features)])
    return rows.mapInArrow(run, kind)

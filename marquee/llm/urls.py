"""URL filter by character language models, DataFrame operations only (operator 8).

Method.  Allow and block rules on hosts and paths decide the urls they fit.  Those urls train two variable-order Markov
models over characters (order 3, each order smoothed with the next lower one, the lowest with the uniform
distribution).  Every other url gets the difference of the two log-likelihoods per character; it is allowed if that
reaches a threshold calibrated on all urls with a rule (least sum of both error rates; the middle of equal ones).

Characters beyond printable ASCII count as one symbol, so tables of 4-grams are bounded.  Log-likelihood differences
are whole millionths, so sums do not depend on their order.  Defined results: null urls and urls without ``://`` have
empty host and path and score as the empty text; without urls of both kinds to train on, the method allows; repeated
rows are judged one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .line_dedup import LOWER, UPPER

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
ORDER = 4                    # characters of a gram: three of context and one
BETA = 4.0                   # weight of the next lower order
ALPHABET = 97.0              # printable ASCII, one symbol for all others, start and end
SALTS = 16
CLIP = 20_000                # thousandths per character at which scores are cut off for the calibration only


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(url, whole, 1), UPPER, LOWER), F.regexp_extract(url, whole, 2))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    found = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def model_text(url: Column) -> Column:
    """What the models read: the url after the scheme, lower-cased, other than printable ASCII as one symbol."""
    text = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", "")
    return F.regexp_replace(F.translate(text, UPPER, LOWER), r"[^\x21-\x7e]", "\x7f")


def grams(text: Column) -> Column:
    """All 4-grams of a text with three start marks and one end mark."""
    chars = F.concat(F.array(*[F.lit("\x02")] * (ORDER - 1)), F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)),
                     F.array(F.lit("\x03")))
    return F.transform(F.sequence(F.lit(0), F.length(text)),
                       lambda i: F.concat(*(chars[i + k] for k in range(ORDER))))


def gram_scores(texts: DataFrame) -> DataFrame:
    """``texts(text, allowed, blocked)`` to (gram, llr): millionths of ln P_allow - ln P_block of every 4-gram."""
    rows = texts.select(F.explode(grams(F.col("text"))).alias("gram"), "allowed", "blocked")
    t = stored(rows.groupBy("gram").agg(F.sum("allowed").alias("a4"), F.sum("blocked").alias("b4")), "grams")
    out, p = t, {"a": F.lit(1 / ALPHABET), "b": F.lit(1 / ALPHABET)}
    for k in range(1, ORDER + 1):
        for side, width in (("n", k), ("c", k - 1)):       # counts of the k characters, and of their context
            key = F.expr(f"substring(gram, {ORDER + 1 - k}, {width})")
            name = f"{side}{k}"
            part = t.groupBy(key.alias(name)).agg(F.sum("a4").alias(name + "a"), F.sum("b4").alias(name + "b"))
            out = out.withColumn(name, key).join(part, name)
    for k in range(1, ORDER + 1):
        for s in "ab":
            p[s] = (F.col(f"n{k}{s}") + BETA * p[s]) / (F.col(f"c{k}{s}") + BETA)
    llr = F.round((F.log(p["a"]) - F.log(p["b"])) * 1e6).cast("long")
    return stored(out.select("gram", llr.alias("llr")), "scores")


def text_scores(texts: DataFrame, scores: DataFrame) -> DataFrame:
    """(h1, h2, score): thousandths per character, rounded down, of every text."""
    rows = texts.select("h1", "h2", F.explode(grams(F.col("text"))).alias("gram")).withColumn(
        "salt", F.pmod("h1", F.lit(SALTS)))
    salted = scores.withColumn("salt", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SALTS)])))
    total = rows.join(salted, ["gram", "salt"]).groupBy("h1", "h2").agg(F.sum("llr").alias("s"),
                                                                        F.count(F.lit(1)).alias("n"))
    return total.select("h1", "h2", F.floor(F.col("s") / (F.col("n") * 1000)).cast("long").alias("score"))


def threshold(judged: DataFrame) -> int:
    """Least score to allow, from the scores of urls with a rule; at most 2 * CLIP + 1 counts reach the driver."""
    clipped = F.least(F.greatest("score", F.lit(-CLIP)), F.lit(CLIP))
    hist = judged.groupBy(clipped.alias("score")).agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    rows = sorted((r.score, r.a or 0, r.b or 0) for r in hist.collect())
    n_a, n_b = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not n_a or not n_b:
        return -2**62
    # Errors at threshold t: allowed ones below t, blocked ones from t on.
    best, missed, passed = [], 0, n_b
    for score, a, b in [*rows, (rows[-1][0] + 1, 0, 0)]:
        best.append((missed * n_b + passed * n_a, score))
        missed, passed = missed + a, passed - b
    least = min(best)[0]
    tied = [s for e, s in best if e == least]
    return (tied[0] + tied[-1]) // 2


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages(page_id, url)``."""
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    text = model_text(url)
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"), text.alias("text"),
                        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("said", said)
    for name, says in (("allowed", "allow"), ("blocked", "block")):
        rows = rows.withColumn(name, F.coalesce(F.col("said") == says, F.lit(False)).cast("long"))
    rows = stored(rows, "urls")
    # Copies of a text are counted here once and weighted by their number.
    texts = stored(rows.groupBy("h1", "h2", "text").agg(F.sum("allowed").alias("allowed"),
                                                        F.sum("blocked").alias("blocked")), "texts")
    found = stored(text_scores(texts, gram_scores(texts)), "llr")
    least = threshold(found.join(texts, ["h1", "h2"]))
    verdict = F.coalesce(F.col("said"), F.when(F.col("score") >= least, "allow").otherwise("block"))
    return rows.join(found, ["h1", "h2"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")

"""Every operator against a plain version, on a small fixture of awkward rows and on the smallest tables."""

import collections
import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marquee.llm import attention, bpe, chat, embeddings, line_dedup, lm, minhash, packing, quality, sharding, urls
from marquee.llm.common import components, stored, tokenizer_path

SF = "/root/testdata/sf0.001"


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def read(spark, name, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]


def run(spark, name):
    return entry.queries()[name](spark, SF)


# ------------------------------------------------------------------ 1 and 10

def check_packed(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, documents, docs_rows):
    for capacity in (64, 2048):
        rows = packing.pack_documents(documents, tokenizer_path(), capacity).collect()
        want = brute.pieces(docs_rows, capacity)
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
        n = check_packed(rows, capacity)
        assert n <= math.ceil(sum(w[3] for w in want) / capacity) * 1.1 + 1


def test_plan_pairs_large_pieces_and_fills_gaps():
    rng = random.Random(3)
    counts = collections.Counter(rng.choice([rng.randint(1, 100), rng.randint(400, 1000)]) for _ in range(4000))
    table = packing.plan(dict(counts), 1000)
    fill = collections.Counter()
    large = collections.Counter()
    for length, n in counts.items():
        part = table[table[:, 0] == length]
        for rank in range(n):
            _, first, seq, per, offset = part[np.searchsorted(part[:, 1], rank, side="right") - 1]
            place = seq + (rank - first) // per
            fill[place] += length
            large[place] += 3 * length > 1000
    assert max(fill.values()) <= 1000 and max(large.values()) <= 2 and sum(fill.values()) == sum(
        k * n for k, n in counts.items())


def test_bpe(spark, documents, docs_rows):
    rows = {r.doc_id: r for r in bpe.encode_documents(documents, tokenizer_path()).collect()}
    t = brute.tokenizer()
    for (key, _), ids in zip(docs_rows, brute.ids_of([x for _, x in docs_rows])):
        assert np.frombuffer(rows[key].ids, "<u4").tolist() == ids
        assert rows[key].decoded == t.decode(ids, skip_special_tokens=False)


def test_bpe_random_words():
    rng = random.Random(5)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(1, 40))) for a in ("ab", "the ing", "lloo'l", "éèaß ")
             for _ in range(500)] + ["a" * n for n in range(1, 120)] + ["ab" * 400]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.load(tokenizer_path()).encode(texts)] == brute.ids_of(texts)


# ------------------------------------------------------------------ 2

def test_embeddings(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 16))
    rows = [(k, (base[k % 30] + 0.12 * (k // 30) * rng.standard_normal(16)).tolist()) for k in range(150)]
    rows += [(200, None), (201, []), (202, [0.0] * 16), (203, [1.0] * 15 + [None]), (204, [float("nan")] * 16),
             (205, [float("inf")] * 16), (206, (base[0] * 1e200).tolist()), (207, (-base[0]).tolist())]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, links int")
    assert got(embeddings.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == sorted(
        brute.embeddings(rows))


def test_embeddings_blocks(spark, monkeypatch):
    """A group far larger than a block is compared whole."""
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rng = np.random.default_rng(4)
    rows = [(k, (np.ones(8) + 0.2 * rng.standard_normal(8)).tolist()) for k in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(embeddings.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == sorted(
        brute.embeddings(rows))


# ------------------------------------------------------------------ 3, 5, 7

def test_quality(spark, documents, docs_rows):
    out = quality.judge(documents).select("row.doc_id", *quality.FEATURES, "base_failed", "kept")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(out, "doc_id", *names) == sorted(brute.quality(docs_rows))
    assert {r.doc_id for r in out.where("kept").collect()} == brute.kept_by_rules(docs_rows)


def test_lines(spark, documents, docs_rows):
    out = line_dedup.dedup_lines(documents)
    out = out.select("row.doc_id", "_n_lines", "_n_dropped", F.sha2("_text", 256).alias("sha"))
    assert got(out, "doc_id", "_n_lines", "_n_dropped", "sha") == sorted(brute.lines(docs_rows))


def test_runs_are_disjoint_and_compacted(spark):
    index = line_dedup.LineIndex()
    for b in range(4):
        rows = [(b * 10 + k, 0, 0, h, h) for k in range(3) for h in (k, b)]
        index.add(stored(spark.createDataFrame(rows, "doc long, version long, pos int, h1 long, h2 long"), "t"))
    assert list(index.levels) == [2] or {k: len(v) for k, v in index.levels.items() if v} == {2: 1}
    run = index.runs()[0]
    assert run.count() == run.select("h1").distinct().count() == 4


def test_near_duplicates(spark, documents, docs_rows):
    assert got(minhash.near_duplicates(documents), "doc_id", "n_shingles", "component_id", "kept") == sorted(
        brute.near_duplicates(docs_rows))


def test_near_duplicates_repeated_and_null_ids(spark, docs_rows):
    text = dict(docs_rows)[7]
    df = spark.createDataFrame([(1, text), (1, text), (1, "other words"), (2, text), (None, text), (3, "other words")],
                               "doc_id long, text string")
    rows = got(minhash.near_duplicates(df).where("doc_id is not null"), "doc_id", "component_id", "kept")
    assert rows == [(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False)]


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
    for a, b in (((0, 8), (1, 9)), ((0, 200), (20, 220))):
        x, y = (np.sort(pool[slice(*s)]) for s in (a, b))
        share = (minhash.signature(x) == minhash.signature(y)).mean()
        assert abs(share - len(np.intersect1d(x, y)) / len(np.union1d(x, y))) < 0.2


def test_components(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [
        (rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a long, b long")
    want = brute.linked({x for p in pairs for x in p}, pairs)
    assert dict(got(components(df), "node", "component")) == {k: v for k, v in want.items() if any(
        k in p and p[0] != p[1] for p in pairs)}


# ------------------------------------------------------------------ 4, 8, 9

def test_chat(spark):
    rows = [(1, 0, "user", "a [INST] <s> </s> [\\INST] <\\\\s> [TURN][ROLE]x[/ROLE]"), (1, 1, "assistant", "b</s>"),
            (1, 2, "assistant", ""), (1, 3, "assistant", "<"), (1, None, "system", None), (2, 1, None, "t\nu"),
            (2, 1, "tool</s>", "x"), (3, 0, "assistant", "é😀[/INST]"), (3, 0, "assistant", "é😀[/INST]"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(df)).collect()
    want = {x[0]: x for x in brute.chats(rows) if x[0] != -7}
    for r in back:
        said = "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        assert (r.conv_id, len(r.turns), brute.sha(said), len(r.loss_text), brute.sha(r.loss_text)) == want[r.conv_id]
        assert sum(s.length for s in r.loss_spans) <= len(r.formatted)
    assert len(back) == 4


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.ORG/es/x?q"), (4, "http://example.org/en/12"),
            (5, "x://b.org"), (6, "http://notorg/"), (7, "http://shop.com/fr/1"), (8, "http://com/de/#x"),
            (9, "http://myexample.org/es/"), (10, "http://x.net/a://b.org/"), (11, "http://é.net/" + "x" * 3000)]
    df = spark.createDataFrame([(k, u, "h") for k, u in rows], "page_id long, url string, host string")
    out = {r.page_id: r for r in urls.filter_urls(df).collect()}
    assert [(out[k].host, out[k].path) for k in (1, 2, 3, 5, 10)] == [
        ("", ""), ("", ""), ("a.example.org", "/es/x"), ("b.org", ""), ("x.net", "/a://b.org/")]
    assert [out[k].rule for k in range(3, 11)] == ["example.org/es/", "example.org/en/1", None, None, "com/fr/",
                                                   "com/de/", "org/", None]
    assert [out[k].verdict for k in (3, 4, 7, 8, 9)] == ["block", "block", "allow", "block", "allow"]
    assert set(r.verdict for r in out.values()) <= {"allow", "block"} and len(out) == 11


def test_url_model_separates_kinds(spark):
    rng = random.Random(1)
    rows = [(k, f"http://{'good' if k % 2 else 'evil'}{rng.randint(0, 999)}.{'org/a' if k % 2 else 'com/de/'}")
            for k in range(300)]
    rows += [(1000 + k, f"http://{'good' if k % 2 else 'evil'}{k}.net/") for k in range(40)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 1000").collect()
    assert all((r.verdict == "allow") == bool(r.page_id % 2) for r in out)


def test_sharding(spark, documents, docs_rows):
    rows = sharding.shard_documents(documents).collect()
    assert len(rows) == len(docs_rows)
    by, where = collections.defaultdict(list), collections.defaultdict(set)
    text = dict(docs_rows)
    for r in rows:
        by[r.shard].append(r.slot)
        where[text[r.doc_id] or ""].add(r.shard)
        assert r.size == len((text[r.doc_id] or "").encode()) + 8
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert all(len(v) == 1 for v in where.values())


def test_longest_first_is_balanced():
    rng = random.Random(7)
    sizes = collections.Counter(int(rng.paretovariate(1.1) * 50) + 8 for _ in range(30_000))
    sizes = {k: n for k, n in sizes.items() if k < 20_000}
    table = sharding.longest_first([(k, n, k * n) for k, n in sizes.items()], 24)
    load = np.zeros(24)
    for k, n in sizes.items():
        part = table[table[:, 0] == k]
        for (_, a, s), b in zip(part, [*part[1:, 1], n]):
            load[s] += k * (b - a)
    assert load.sum() == sum(k * n for k, n in sizes.items()) and load.max() - load.min() <= 100


# ------------------------------------------------------------------ 6

def test_lm_base_scores(spark, documents, docs_rows, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 40)                # most words take the join
    out = {r.doc_id: r for r in lm.score_documents(documents, tokenizer_path(), every=2).collect()}
    for k, held, n, known, total, score in brute.base_scores(docs_rows):
        r = out[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9) and r.score < 0 and math.isfinite(r.score)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    i, t, owner = attention.cut_windows([rng.integers(0, 1000, n).astype(np.int16) for n in (40, 0, 15, 16)])
    assert (t >= 0).sum() == 41 + 1 + 16 + 17 and owner.max() == 3
    p = attention.new_params()
    g = attention.gradients(p, i, t)

    def loss(p):
        return -attention.log10_probabilities(p, i, t).sum() * np.log(10) / (t >= 0).sum()

    for n in p:
        k = np.unravel_index(np.abs(g[n]).argmax(), g[n].shape)
        up, down = ({m: v.copy() for m, v in p.items()} for _ in range(2))
        up[n][k] += 1e-2
        down[n][k] -= 1e-2
        assert g[n][k] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.02)


def test_attention_learns_context():
    """A class mostly repeats the one three places before, which only attention can see; held-out text then gets far
    more than the uniform probability, the best that a model of the last class could give."""
    rng = np.random.default_rng(0)

    def text(n):
        x = [int(rng.integers(7)) for _ in range(3)]
        for _ in range(n):
            x.append(x[-3] if rng.random() < 0.9 else int(rng.integers(7)))
        return np.array(x, np.int16)

    i, t, _ = attention.cut_windows([text(200) for _ in range(150)])
    p = attention.train(attention.new_params(), i, t, 500, 64, 0.01, 1)
    i, t, _ = attention.cut_windows([text(200) for _ in range(10)])
    assert attention.log10_probabilities(p, i, t).sum() / (t >= 0).sum() > math.log10(1 / 7) + 0.25


def test_token_shares_are_probabilities():
    cls, share = attention.classes_of(np.random.default_rng(0).integers(0, 1000, 5000))
    assert np.allclose(np.bincount(cls, 10**share)[np.unique(cls)], 1)


# ------------------------------------------------------------------ whole queries, empty tables, pipeline

def test_queries_on_the_smallest_tables(spark):
    docs = read(spark, "documents", "doc_id", "text")
    assert got(run(spark, "op5_line_dedup"), "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(brute.lines(docs))
    assert got(run(spark, "op7_minhash"), "doc_id", "n_shingles", "component_id", "kept") == sorted(
        brute.near_duplicates(docs))
    assert got(run(spark, "op4_chat"), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(
        brute.chats(read(spark, "conversations", "conv_id", "turn", "role", "text")))
    assert got(run(spark, "op2_embeddings"), "vec_id", "n_links", "component_id", "kept") == sorted(
        brute.embeddings(read(spark, "embeddings", "vec_id", "embedding")))
    rows = run(spark, "pipeline").collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(brute.pipeline(docs))
    check_packed(rows, 2048)


def test_empty_tables(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    path = tokenizer_path()
    for out in (packing.pack_documents(docs, path), quality.judge(docs), line_dedup.dedup_lines(docs),
                lm.score_documents(docs, path), minhash.near_duplicates(docs), sharding.shard_documents(docs),
                bpe.encode_documents(docs, path), *(f(spark, docs, "") for _, f in corpus_pipeline.STAGES),
                embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
                chat.format_conversations(spark.createDataFrame([], "conv_id long, turn int, role string, text string")),
                urls.filter_urls(spark.createDataFrame([], "page_id long, url string"))):
        assert out.count() == 0


def test_stages_keep_all_columns(spark, documents, docs_rows):
    import corpus_pipeline

    df = documents.unionByName(spark.createDataFrame([(None, "no id", *[None] * 9)], documents.schema))
    for _, stage in corpus_pipeline.STAGES[:3]:
        df = stored(stage(spark, df, ""), "stage")
        assert df.columns == documents.columns
    assert {r.row for r in df.collect()} == {1}

"""Spelling variants, WARC archives and conversation repair against plain versions."""

import gzip
import hashlib
import io
import random
import zlib

import brute_new as brute
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marquee.llm import repair, spelling, warc

SF = "/root/testdata/sf0.001"


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def read(spark, name, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]


def same(df, want, *cols):
    assert got(df, *cols) == sorted(want, key=str)


# ------------------------------------------------------------------ 11

SPELLED = ("word", "form", "root", "n", "n_near", "form_n")


def variants(rng, n=1500):
    base = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(4, 9))) for _ in range(25)]
    for _ in range(n):
        w = list(rng.choice(base[:1 + int(rng.paretovariate(0.6)) % 25]))
        for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
            k = rng.randrange(len(w))
            w[k:k + rng.randint(0, 1)] = rng.choice(("", "a", "x", "é", "B"))
            w = w or ["a"]
        yield "".join(w)


def spelling_rows():
    rng = random.Random(11)
    rows = [(k, " ".join(variants(rng, 150))) for k in range(20)]
    long = "y" * 70_000
    return rows + [(30, None), (31, ""), (None, " ".join(variants(rng, 50))), (5, rows[5][1]), (5, "other"),
                   (32, f"{long} {long} {long}, {long}z {long}z {long}z {long}z {long}z {long}z {long}z"),
                   (33, "ÀÉÎõü×÷ÿ 'ÀÉÎõü×÷ÿ' ÀÉÎõü×÷ÿ. àéîõü×÷ÿ Ωabcde1abcde_abcdèabcde İstanbul ſabcde")]


def spelling_docs(spark, rows):
    return spark.createDataFrame([(*r, "w", 7, 1, 2) for r in rows],
                                 "doc_id long, text string, word string, n int, block int, root int").repartition(3)


@pytest.mark.parametrize("members", [1024, 4])
def test_spellings(spark, members):
    """Also with chunks of four words, so that blocks are compared chunk by chunk."""
    rows = spelling_rows()
    out = spelling.group_spellings(spelling_docs(spark, rows), members=members, damage=7)
    same(out, brute.spellings(rows, 7), *SPELLED)


def test_spellings_of_the_smallest_table(spark):
    same(entry.queries()["op11_spelling"](spark, SF), brute.spellings(read(spark, "documents", "doc_id", "text")), *SPELLED)


def test_near_pairs_are_all_pairs_one_edit_apart():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(n)) for n in (6, 7) for _ in range(150)})
    by = {n: [w.encode() for w in words if len(w) == n] for n in (6, 7)}
    m = {n: np.frombuffer(b"".join(v), np.uint8).reshape(-1, n) for n, v in by.items()}
    i, j = spelling.near_pairs(m[7], m[6])
    found = {(by[7][a].decode(), by[6][b].decode()) for a, b in zip(i, j)}
    assert found == {(a, b) for a in words for b in words if len(a) == 7 and len(b) == 6 and brute.one_edit(a, b)}
    i, j = spelling.near_pairs(m[7])
    found = {frozenset((by[7][a].decode(), by[7][b].decode())) for a, b in zip(i, j)}
    assert len(found) == len(i) and found == {frozenset((a, b)) for a in words for b in words
                                              if len(a) == len(b) == 7 and brute.one_edit(a, b)}


def test_roots_follow_long_chains(spark):
    rows = [(f"w{k}", f"w{k + 1}" if k % 50 < 49 else None) for k in range(200)]
    out = spelling.with_roots(spark.createDataFrame(rows, "word string, form string"))
    assert {r.word: r.root for r in out.collect()} == {f"w{k}": f"w{k - k % 50 + 49}" for k in range(200)}


# ------------------------------------------------------------------ 12

WARC = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def page_rows():
    body = "<html>é" + "x" * 200
    return [(5, "http://a/", body), (3, "http://b/ c\r\nWARC-Type: x", body), (9, None, body), (9, "http://é/%41", body),
            (3, "again", body), (None, "no id", body), (1, "u", None), (2, "", ""), (4, "s", "y" * 99), (6, "s", "y" * 99),
            (7, "s", "y" * 100), (8, "s", "y" * 100), (-2, "neg", "y" * 100), (10, "w", "WARC/1.1\r\n\r\n\r\n\r\n" * 9),
            (11, "long", "z\r\n\r\n" * 400_000), (12, "long", "z\r\n\r\n" * 400_000), (13, "nul", "\x00" * 120)]


def pages_of(spark, rows):
    kind = "page_id long, url string, html string, payload int, id string, digest int, original int, salt int, path string"
    return spark.createDataFrame([(*r, 1, "i", 2, 3, 4, "p") for r in rows], kind).repartition(3)


def test_warc(spark, tmp_path):
    rows = page_rows()
    archives = warc.archive_pages(pages_of(spark, rows), f"file://{tmp_path}/w", roll_bytes=1000)
    assert archives.count() > 3 and archives.agg(F.sum("records")).first()[0] == len(rows)
    same(warc.read_pages(archives), brute.warc([(k, h) for k, _, h in rows]), *WARC)
    kept = warc.read_archives(archives, keep=True).where("type != 'warcinfo'").collect()
    text = {(k, h or "") for k, _, h in rows}
    for r in kept:
        assert r.error is None and (r.type == "revisit" or (
            int(r.record_id[10:-1]) if r.record_id != "<urn:page:>" else None, r.payload.decode()) in text)
    assert "http://b/%20c%0D%0AWARC-Type:%20x" in {r.uri for r in kept} and "http://%C3%A9/%41" in {r.uri for r in kept}
    # Every member is a whole record that any gzip reader inflates.
    for a in archives.collect():
        data = open(a.path.removeprefix("file://"), "rb").read()
        assert len(data) == a.bytes and gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == a.records + 1


def test_warc_of_the_smallest_table(spark):
    same(entry.queries()["op12_warc"](spark, SF), brute.warc(read(spark, "pages", "page_id", "html")), *WARC)


def members(*records):
    return io.BytesIO(b"".join(records))


def errors(stream):
    return [r[-1] for r in warc.records(stream)]


def page(k, html, original=None, **swap):
    data = warc.page_record(k, "u", html, hashlib.sha256(html).hexdigest(), original)
    for a, b in swap.values():
        data = gzip.compress(gzip.decompress(data).replace(a, b))
    return data


def test_reader_names_broken_records():
    good, html = page(1, b"q" * 300), b"q" * 300
    assert errors(members(good, page(2, html, 1))) == [None, None]
    assert errors(members(good, page(2, html, s=(b"qqq", b"qrq")), good)) == [None, "payload digest differs", None]
    assert errors(members(page(2, html, 1, s=(b"200 OK", b"200 KO")), good)) == ["block digest differs", None]
    assert errors(members(page(2, html, s=(b"Content-Length: 3", b"Content-Length: 4")), good)) == [
        "member ends within the record", None]
    assert errors(members(page(2, html, s=(b"WARC/1.1", b"WARC/9.9")), good)) == ["no WARC version line", None]
    assert errors(members(gzip.compress(gzip.decompress(good) * 2), good)) == ["more than one record in a gzip member", None]
    assert errors(members(good, good[:-20])) == [None, "truncated gzip member"]
    assert errors(members(good[:60] + bytes([good[60] ^ 255]) + good[61:]))[0] is not None
    assert errors(members(gzip.compress(b"no header at all"))) == ["no end of the record header"]
    assert errors(members(good, b"not gzip"))[-1].startswith("broken gzip member")
    assert errors(members()) == []


def test_reader_needs_one_piece_at_a_time():
    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 7))

    html = random.Random(1).randbytes(3000)
    rows = list(warc.records(Slow(page(1, html) + page(2, html, 1)), keep=True))
    assert [r[1] for r in rows] == ["response", "revisit"] and rows[0][7] == html and [r[5] for r in rows] == [3000, 3000]
    assert rows[0][6] == rows[1][6] == hashlib.sha256(html).hexdigest()


def test_broken_archive_fails_the_query(spark, tmp_path):
    archives = warc.archive_pages(pages_of(spark, page_rows()[:3]), f"file://{tmp_path}/w").collect()
    with open(archives[0].path.removeprefix("file://"), "r+b") as f:
        f.truncate(300)
    with pytest.raises(PySparkException):
        warc.read_pages(spark.createDataFrame(archives)).collect()


# ------------------------------------------------------------------ 13

REPAIRED = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def turn_rows():
    rng = random.Random(13)
    roles = ("system", "user", "assistant", "user", "assistant", "user", "assistant", "tool", "", None, "ubot", "s")
    texts = ("Yes.", "no", " ", None, "", "What? ", "a.b!\n", "Yes.", "é ", "x" * 3000 + ".", "end ")
    rows = [(c, k if rng.random() < 0.9 else rng.choice((None, 2 * k, 0)), rng.choice(roles), rng.choice(texts))
            for c in range(60) for k in range(rng.randint(1, 9))]
    rows += [(1000, k, ("user", "assistant")[k % 2], f"Row {k % 40}{'.' * (k % 3)}") for k in range(700)]
    rows += [(1001, None, "user", "same.")] * 40 + [(None, k, "user", "n.") for k in range(3)] + [(1002, None, None, None)]
    return rows + [(2000 + k, 0, "user", "Alone.") for k in range(40)]


def turns_of(spark, rows):
    kind = ("conv_id long, turn long, role string, text string, conv int, seq string, copies int, audit int, blank string, "
            "kind int, block int")
    return spark.createDataFrame([(*r, 1, "s", 2, 3, "b", 4, 5) for r in rows], kind).repartition(3)


@pytest.mark.parametrize("block", [1024, 4])
def test_repair(spark, block):
    rows = turn_rows()
    same(repair.repair_conversations(turns_of(spark, rows), block), brute.repairs(rows), *REPAIRED)


def test_repair_of_the_smallest_table(spark):
    turns = read(spark, "conversations", "conv_id", "turn", "role", "text")
    same(entry.queries()["op13_repair"](spark, SF), brute.repairs(turns), *REPAIRED)


def parse(rows):
    spans = repair.Spans()
    for role, _, fault in rows:
        spans.add(repair.row_cell(role[:1], fault == "truncated", fault in ("blank", "duplicate")))
    return repair.cheapest(spans.whole())


def test_cells_against_all_edit_strings():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(("system", "user", "assistant", "tool")), "", rng.choice((None, None, "truncated", "blank")))
                for _ in range(rng.randint(1, 4))]
        assert parse(rows) == brute.repair_by_trial(rows) == brute.repair(rows)[:2]


def test_any_split_gives_the_same_cell():
    """Every split point of every span, as in a plain CYK table."""
    rng = random.Random(6)
    cells = [repair.row_cell(rng.choice("suax"), rng.random() < 0.3, rng.random() < 0.3) for _ in range(9)]
    table = {(k, k + 1): c for k, c in enumerate(cells)}
    for size in range(2, 10):
        for a in range(10 - size):
            found = {repair.combine(table[a, m], table[m, a + size]) for m in range(a + 1, a + size)}
            assert len(found) == 1
            table[a, a + size] = found.pop()


def test_copies_that_must_go():
    one = repair.row_cell("", False, True)
    for n in range(1, 9):
        want = one
        for _ in range(n - 1):
            want = repair.combine(want, one)
        assert repair.copies_cell(n) == want


def test_new_operators_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert spelling.group_spellings(docs).count() == 0
    assert warc.read_pages(warc.archive_pages(pages)).count() == 0
    assert repair.repair_conversations(turns).count() == 0


def test_damage_hash_is_that_of_zlib(spark):
    rows = spark.range(3).select(F.crc32(F.concat(F.col("id").cast("string"), F.lit(":é"))).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(f"{k}:é".encode()) for k in range(3)]

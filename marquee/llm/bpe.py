"""BPE encoding and decoding by speculation and verification (operator 10).

Method.  A text is normalised and cut into words as the tokenizer file says.  For all words of a batch that the
worker has not met yet, greedy longest-match over a trie proposes tokens (all words advance together, one numpy step
per trie level).  A proposal is the BPE result exactly if every token encodes to itself and every adjacent pair is
compatible, i.e. no merge across the pair's border would have run before the merges that built the two tokens.  Both
tests are vectorised; only words that fail are merged exactly, merge by merge.

Defined results: null text encodes as the empty text (no ids, decoded text ''); the special tokens' own strings in a
text become their ids, as in the library; other columns of the input are kept as they are.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import numpy as np
import regex

MAX_CACHED = 900_000         # chunks kept per Python worker (memory bound, about 150 MB)
LONG_WORD = 400              # longer words are matched one by one, not in the batch

WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n", regex.V0)
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n", re.ASCII)     # the same on lower-case ASCII
CONTROLS = re.compile("[\x1c-\x1f]")        # white space to str.split, not to the tokenizer
BLANKS = regex.compile(r"\s+", regex.V0)
#: Anything outside Latin, Greek, Cyrillic, general punctuation, kana, common CJK ideographs and Hangul syllables.
UNSETTLED = re.compile("[^\x00-\u0527\u1e00-\u1fff\u2010-\u2064\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters stand for themselves, others from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder and decoder for a tokenizer file of kind "BPE with word ends"."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.alphabet, vocab = byte_alphabet(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * size
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s
        # Rank of the merge that makes a token (-1: single symbols), and its two parts.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, (list, tuple)) else m.split(" ")
            i, a, b = vocab[a + b], vocab[a], vocab[b]
            self.rank[i], self.left[i], self.right[i] = r, a, b
            self.merges[a, b] = i
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_ranks = self.rank[np.array(list(self.merges.values()), np.int64)[order]]
        self.symbol = np.zeros(512, np.int64)          # byte -> token; 256 + byte -> token that also ends the word
        trie: list[dict[int, int]] = [{}]
        inside, closing = {}, {}                       # node -> token there, within a word and at its end
        own = self._self_encoding()
        for s, i in vocab.items():
            ends = s.endswith(suffix) and len(s) > len(suffix)
            body = bytes(self.alphabet[c] for c in (s[:-len(suffix)] if ends else s))
            if len(body) == 1:
                self.symbol[body[0] + 256 * ends] = i
            if own[i]:
                node = 0
                for x in body:
                    if x not in trie[node]:
                        trie[node][x] = len(trie)
                        trie.append({})
                    node = trie[node][x]
                (closing if ends else inside)[node] = i
        inner = [n for n, kids in enumerate(trie) if kids]
        number = {n: k for k, n in enumerate(inner)}
        number |= {n: len(inner) + k for k, n in enumerate(x for x, kids in enumerate(trie) if not kids)}
        self.children = np.full((len(inner), 256), -1, np.int32)
        for n in inner:
            for x, kid in trie[n].items():
                self.children[number[n], x] = number[kid]
        self.inside, self.closing = np.full(len(trie), -1, np.int32), np.full(len(trie), -1, np.int32)
        for table, found in ((self.inside, inside), (self.closing, closing)):
            for n, i in found.items():
                table[number[n]] = i
        self.made_by = np.zeros(len(self.merges), np.int64)
        for i in self.merges.values():
            self.made_by[self.rank[i]] = i
        self.cache: dict[str, bytes] = {}
        self.pieces = [s.encode() for s in self.strings]

    # ------------------------------------------------------------------ verification

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a huge number where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether no merge of rank below ``limit`` joins across the border while a and b are being built.

        The two tokens are taken apart along the border, latest merge first; at each state the pair that then meets
        at the border must not have a merge that would have run earlier than the merge just undone.  On equal ranks
        the left one runs first, hence the +1 for merges undone on the right.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), limit.copy()
        while len(live):
            bad = self._ranks_of(a, b) < limit
            good[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            on_left = ra > rb
            limit = np.where(on_left, ra, rb + 1)[go]
            a, b = np.where(on_left, self.right[a], a)[go], np.where(on_left, b, self.left[b])[go]
            live = live[go]
        return good

    def _self_encoding(self) -> np.ndarray:
        """Tokens that merging their own string gives back."""
        own = np.ones(self.size, bool)
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        fine = self.compatible(self.left[made], self.right[made], self.rank[made])
        for i, ok in zip(made.tolist(), fine.tolist()):
            own[i] = ok and own[self.left[i]] and own[self.right[i]]
        return own

    # ------------------------------------------------------------------ speculation

    def _propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match: (word number, token) in order, and which words found no match somewhere."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        stream = np.frombuffer(b"".join(words), np.uint8)
        pos, live, failed = np.r_[0, ends[:-1]] if words else ends, np.arange(len(words)), np.zeros(len(words), bool)
        out_w, out_t = [], []
        inner = len(self.children)
        while len(live):
            best_t, best_p = np.full(len(live), -1, np.int32), pos.copy()
            on, node, p, end = np.arange(len(live)), np.zeros(len(live), np.int32), pos, ends[live]
            while len(on):
                node = self.children[node, stream[p]]
                go = node >= 0
                on, node, p, end = on[go], node[go], p[go] + 1, end[go]
                tok = np.where(p == end, self.closing[node], self.inside[node])
                hit = tok >= 0
                best_t[on[hit]], best_p[on[hit]] = tok[hit], p[hit]
                go = (node < inner) & (p < end)
                on, node, p, end = on[go], node[go], p[go], end[go]
            ok = best_t >= 0
            failed[live[~ok]] = True
            out_w.append(live[ok])
            out_t.append(best_t[ok])
            more = ok & (best_p < ends[live])
            live, pos = live[more], best_p[more]
        w = np.concatenate(out_w) if out_w else np.zeros(0, np.int64)
        t = np.concatenate(out_t) if out_t else np.zeros(0, np.int32)
        order = np.argsort(w, kind="stable")
        return w[order], t[order].astype(np.int64), failed

    def _merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost first; a heap over a linked list."""
        ids = [int(x) for x in self.symbol[np.frombuffer(word, np.uint8)]]
        ids[-1] = int(self.symbol[word[-1] + 256])
        merges, rank = self.merges, self.rank
        nxt, prev = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(int(rank[m]), i, m) for i in range(len(ids) - 1) if (m := merges.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, m = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] < 0 or j >= len(ids) or merges.get((ids[i], ids[j])) != m:
                continue                                            # an older entry of a pair that has changed
            ids[i], ids[j] = m, -1
            nxt[i] = nxt[j]
            if nxt[i] < len(ids):
                prev[nxt[i]] = i
                if (k := merges.get((m, ids[nxt[i]]))) is not None:
                    heapq.heappush(heap, (int(rank[k]), i, k))
            if prev[i] >= 0 and (k := merges.get((ids[prev[i]], m))) is not None:
                heapq.heappush(heap, (int(rank[k]), prev[i], k))
        return [x for x in ids if x >= 0]

    def _merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once: in each step every unfinished word does its lowest, leftmost merge.
        Returns (word number, token), by word."""
        none = np.iinfo(np.int64).max
        lens = np.fromiter(map(len, words), np.int64, len(words))
        s = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        last = np.cumsum(lens) - 1
        s[last] = self.symbol[np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8).astype(np.int64) + 256]
        w = np.repeat(np.arange(len(words)), lens)
        r = np.full(len(s), none)
        inside = np.flatnonzero(w[1:] == w[:-1])
        r[inside] = self._ranks_of(s[inside], s[inside + 1])
        done_w, done_s = [], []
        while len(s):
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            least = np.minimum.reduceat(r, first)
            size = np.diff(np.r_[first, len(s)])
            ended = np.repeat(least == none, size)
            if ended.any():
                done_w.append(w[ended])
                done_s.append(s[ended])
                s, w, r, least, size = s[~ended], w[~ended], r[~ended], least[least != none], size[least != none]
                if not len(s):
                    break
            at = np.flatnonzero(r == np.repeat(least, size))
            at = at[np.r_[True, w[at][1:] != w[at][:-1]]]
            s[at] = self.made_by[r[at]]
            keep = np.ones(len(s), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))                 # one symbol left each word before
            s, w, r = s[keep], w[keep], r[keep]
            for k in (at, at - 1):
                k = k[(k >= 0) & (k + 1 < len(s))]
                k = k[w[k] == w[k + 1]]
                r[k] = self._ranks_of(s[k], s[k + 1])
            closes = at[(at + 1 == len(s)) | (w[np.minimum(at + 1, len(s) - 1)] != w[at])]
            r[closes] = none
        w, s = np.concatenate(done_w), np.concatenate(done_s)
        order = np.argsort(w, kind="stable")
        return w[order], s[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words behind each other, and how many each word has."""
        raw = [w.encode() for w in words]
        long = np.fromiter((len(w) > LONG_WORD for w in raw), bool, len(raw))
        short = np.flatnonzero(~long)
        w, t, failed = self._propose([raw[k] for k in short.tolist()])
        inside = np.flatnonzero(w[1:] == w[:-1])
        pairs, back = np.unique(t[inside] * self.size + t[inside + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size, np.full(len(pairs), np.iinfo(np.int64).max))
        failed[w[inside[~fine[back]]]] = True
        good = ~failed[w]
        parts = [(short[w[good]], t[good])]
        if failed.any():
            again = short[failed]
            w, t = self._merge_many([raw[k] for k in again.tolist()])
            parts.append((again[w], t))
        for k in np.flatnonzero(long).tolist():
            t = np.array(self._merge(raw[k]), np.int64)
            parts.append((np.full(len(t), k), t))
        w, t = (np.concatenate(x) for x in zip(*parts))
        return t[np.argsort(w, kind="stable")], np.bincount(w, minlength=len(raw))

    # ------------------------------------------------------------------ texts

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _words(self, chunks: list[str]) -> list[str]:
        """Normalised words of chunks, a line feed after each chunk's.

        Libraries of different Unicode versions class some new characters differently; chunks with any beyond the
        long-settled blocks are cut by the tokenizer library's own rules.
        """
        text = "\n".join([*chunks, ""])
        if text.isascii():
            return PLAIN.findall(text.lower())
        if not UNSETTLED.search(text):
            return WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())   # no final-sigma rule
        out = []
        for c in chunks:
            if UNSETTLED.search(c):
                cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(c))
                out += [bytes(self.alphabet[x] for x in w).decode() for w, _ in cut] + ["\n"]
            else:
                out += self._words([c])
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Ids of chunks (runs without white space) that are not in the cache yet."""
        marked = [c for c in chunks if "<|" in c and self.special_re.search(c)]
        for c in marked:
            parts = [x for x in self.special_re.split(c) if x]
            rest = [x for x in parts if x not in self.special]
            known = dict(zip(rest, self._chunks(rest)))
            self.cache[c] = b"".join([np.array([self.special[x]], "<u4").tobytes() if x in self.special else known[x]
                                      for x in parts])
        if marked:
            chunks = [c for c in chunks if c not in self.cache]
        plain = [c for c in chunks if c.isascii()]
        other = [c for c in chunks if not c.isascii()]
        for part in (plain, other):
            self.cache.update(zip(part, self._chunks(part)))

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        number: dict[str, int] = {"\n": 0}
        at = np.array([number.setdefault(w, len(number)) for w in self._words(chunks)], np.int64)
        ids, size = self.encode_words(list(number)[1:])
        start, size = np.r_[0, 0, np.cumsum(size)], np.r_[0, size]
        each = size[at]
        ends = np.cumsum(each)
        flat = ids[np.repeat(start[at] - ends + each, each) + np.arange(int(each.sum()))].astype("<u4").tobytes()
        cuts = [0, *(4 * ends[at == 0]).tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers.

        White space never joins a word and never composes with its neighbours under NFC, so chunks between white
        space are encoded alone and remembered.
        """
        if len(self.cache) > MAX_CACHED:
            self.cache.clear()
        cut = [x.split() if not CONTROLS.search(x) else [c for c in BLANKS.split(x) if c] for x in texts]
        cache = self.cache
        new = list(set().union(*cut).difference(cache)) if cut else []
        if new:
            self._learn(new)
        return [b"".join([cache[c] for c in row]) for row in cut]

    def decode(self, ids: bytes) -> bytes:
        """Text in UTF-8 of little-endian ids.  The file names no decoder, so the library joins the tokens' strings by
        blanks; special tokens stay."""
        pieces = self.pieces
        return b" ".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One encoder per worker process and file."""
    return WordBpe(path)


def encode_documents(docs, path: str):
    """``docs(doc_id, text)`` to ``doc_id, ids`` (binary, little-endian unsigned 32-bit) and ``decoded``."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    def run(batches):
        encoder = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                texts = [x or "" for x in batch.column(1).slice(at, 500).to_pylist()]
                ids = encoder.encode(texts)
                decoded = [encoder.decode(x).decode() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 500), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary, decoded string")

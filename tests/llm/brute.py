"""Plain single-process versions of the operators' contracts, for comparison on small tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

from marquee.llm.common import tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")
UP = {c: c + 32 for c in range(65, 91)}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(texts):
    return [e.ids for e in tokenizer().encode_batch([x or "" for x in texts], add_special_tokens=False)]


def pieces(docs, capacity=2048):
    out = []
    for (key, _), ids in zip(docs, ids_of([t for _, t in docs])):
        ids = np.array([*ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            out.append((key, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    return out


def quality(docs):
    out = []
    for key, text in docs:
        text = text or ""
        w = WORD.findall(text)
        seen = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        out.append((key, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                    len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    return out


def lines(docs):
    owner, held = {}, collections.defaultdict(set)
    cut = [(key, (text or "").split("\n")) for key, text in docs]
    def norm(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(UP)
    for key, ls in cut:
        for x in map(norm, ls):
            if len(x) >= 10:
                held[x].add(key)
    owner = {x: min(s) for x, s in held.items() if len(s) > 1}
    out = []
    for key, ls in cut:
        kept = [x for x in ls if owner.get(norm(x), key) == key]
        out.append((key, len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return out


def chats(turns):
    probe = "</s>[INST] ok [/INST]"
    by = collections.defaultdict(list)
    for conv, turn, role, text in [*turns, (-7, 0, "user", probe), (-7, 1, "assistant", probe)]:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, rows in by.items():
        rows.sort()
        loss = "".join(t for _, _, r, t in rows if r == "assistant")
        out.append((conv, len(rows), sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows)), len(loss), sha(loss)))
    return out


def shingles(text, n=4):
    w = WORD.findall((text or "").translate(UP))
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def linked(keys, pairs):
    """(component by key)"""
    top = {k: k for k in keys}

    def root(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def near_duplicates(docs, n=4):
    sets = [(key, shingles(text, n)) for key, text in docs]
    by = collections.defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(n)
    near = set()
    for group in by.values():
        near.update(itertools.combinations(group, 2))
    pairs = []
    for i, j in near:
        (a, x), (b, y) = sets[i], sets[j]
        if 100 * len(x & y) >= 80 * len(x | y):
            pairs.append((a, b))
    comp = linked({k for k, _ in sets}, pairs)
    return [(k, len(s), comp[k], comp[k] == k) for k, s in sets]


def embeddings(rows, least=0.95):
    good = [(k, np.array(v, float)) for k, v in rows
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    keys = [k for k, _ in good]
    x = np.array([v / abs(v).max() / np.linalg.norm(v / abs(v).max()) for _, v in good])
    sim = x @ x.T if len(x) else np.zeros((0, 0))
    np.fill_diagonal(sim, 0)
    hit = np.argwhere(sim >= least)
    comp = linked({k for k, _ in rows}, [(keys[i], keys[j]) for i, j in hit])
    n = collections.Counter(keys[i] for i, _ in hit)
    return [(k, n[k], comp[k], comp[k] == k) for k, _ in rows]


def base_scores(docs):
    cut = {}
    for key, text in docs:
        cut[key] = [*WORD.findall((text or "").translate(UP)), None]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in cut}
    c = collections.Counter(w for k, ws in cut.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(k, held[k], len(ws), sum(1 for w in ws if c[w]), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for k, ws in cut.items()]


def kept_by_rules(docs):
    """The quality verdicts, rule by rule."""
    out = set()
    for (key, text), (_, n, chars, symbols, dup, repeat, _) in zip(docs, quality(docs)):
        lines = sum(1 for x in (text or "").split("\n") if WORD.search(x))
        shouts = (text or "").count("!")
        if (n >= 50 and repeat * 2 <= n and symbols * 10 <= n and shouts * 5 <= n and dup * 10 <= lines * 3
                and n * 2 <= chars <= n * 20):
            out.add(key)
    return out


def pipeline(docs, capacity=2048):
    kept = kept_by_rules(docs)
    docs = [d for d in docs if d[0] in kept]
    held = collections.defaultdict(set)
    def norm(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(UP)
    for key, text in docs:
        for x in map(norm, text.split("\n")):
            if len(x) >= 10:
                held[x].add(key)
    docs = [(key, "\n".join(x for x in text.split("\n") if min(held.get(norm(x), {key})) == key)) for key, text in docs]
    stay = {k for k, _, _, same in near_duplicates(docs, 5) if same}
    return pieces([d for d in docs if d[0] in stay], capacity)

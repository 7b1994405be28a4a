"""Plain versions of the contracts of operators 11 to 13."""

import collections
import hashlib
import itertools
import re
import zlib

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
WORD = re.compile("[^\x20\x09-\x0d]")
UP = {c: c + 32 for c in range(65, 91)}


def crc(text):
    return zlib.crc32(text.encode())


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def spellings(docs, damage=97):
    count = collections.Counter()
    for key, text in docs:
        for run in LETTERS.findall(text or ""):
            run = run.translate(UP)
            h = crc(f"{'' if key is None else key}:{run}")
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    # Near words share the word itself or a word with one letter less.
    by = collections.defaultdict(set)
    for w in n:
        for x in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            by[x].add(w)
    near = collections.defaultdict(set)
    for group in by.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def warc(pages):
    """(page_id, html) -> rows; a null id counts as the largest."""
    data = [(k, (h or "").encode()) for k, h in pages]
    least = {}
    for k, h in data:
        if k is not None:
            least[h] = min(k, least.get(h, k))
    out = []
    for k, h in data:
        first = least.get(h)
        again = len(h) >= 100 and first is not None and first != k
        out.append((k, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", first if again else None))
    return out


def damage(turns):
    by = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        rows = by[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in by.items()}


NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAMES = {"u": "user", "a": "assistant"}


def repair(rows):
    """rows: (role, text, fault).  Least (cost, audit, repaired) over all edits, row by row over the last initial."""
    def inserted(ways):
        for _ in range(4):
            new = dict(ways)
            for last, (cost, audit, said) in ways.items():
                for x in NEXT[last]:
                    if x in NAMES:
                        new[x] = min(new.get(x, (cost + 9,)), (cost + 3, audit + "I", said + ((NAMES[x], ""),)))
            ways = new
        return ways

    ways = {"": (0, "", ())}
    for role, text, fault in rows:
        new = {}

        def offer(last, way):
            new[last] = min(new.get(last, (way[0] + 1,)), way)

        for last, (cost, audit, said) in inserted(ways).items():
            offer(last, (cost + 4, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            for x in NEXT[last]:
                if x == role[:1]:
                    offer(x, (cost + extra, audit + "K", said + ((role, text),)))
                if x in NAMES:
                    offer(x, (cost + extra + 3, audit + "R", said + ((NAMES[x], text),)))
        ways = new
    return min(w for last, w in inserted(ways).items() if last in ("", "a"))


def repairs(turns):
    out = []
    for conv, rows in damage(turns).items():
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        cost, audit, said = repair([(r, t, f) for (_, r, t), f in zip(rows, faults)])
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in said)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def repair_by_trial(rows, most=3):
    """All edit strings, for very short conversations: least (cost, audit)."""
    best = None
    n = len(rows)
    for gaps in itertools.product(range(most), repeat=n + 1):
        for edits in itertools.product("KRD", repeat=n):
            audit = "".join("I" * gaps[k] + (edits[k] if k < n else "") for k in range(n + 1))
            cost, last, at, good = 3 * sum(gaps), "", 0, True
            for x in audit:
                if x == "I":
                    step = next((y for y in NEXT[last] if y in NAMES), None)
                else:
                    role, _, fault = rows[at]
                    at += 1
                    if x == "D":
                        cost += 4
                        continue
                    if fault in ("blank", "duplicate"):
                        good = False
                        break
                    cost += (3 if fault else 0) + (3 if x == "R" else 0)
                    step = role[:1] if x == "K" else next((y for y in NEXT[last] if y in NAMES), None)
                if step is None or step not in NEXT[last]:
                    good = False
                    break
                last = step
            if good and last in ("", "a") and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best

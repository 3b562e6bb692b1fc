"""Plain single-process versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def substring(docs, width=35):
    words = [SPACED.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def suffix(docs, length=100):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        b = (t or "").encode()
        flags = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                flags[i : i + length] = b"\1" * length
            seen.add(s)
        spans = len(re.findall(rb"\x01+", bytes(flags)))
        out.append((d, len(b), sum(flags), spans, sha(bytes(c for c, f in zip(b, flags) if not f))))
    return sorted(out, key=repr)


def decontaminate(docs, items, window=10):
    passages = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(UPPER))
        size = min(len(w), window)
        for a in range(len(w) - size + 1 if size else 0):
            passages.setdefault(tuple(w[a : a + size]), set()).add("" if i is None else str(i))
    sizes = {len(p) for p in passages}
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(UPPER))
        hit, found = set(), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                p = tuple(w[a : a + size])
                if p in passages:
                    hit.update(range(a, a + size))
                    found |= passages[p]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=repr)


def jaccard(docs, shingle=3, share=90):
    sets = []
    for _, t in docs:
        w = SPACED.findall((t or "").translate(UPPER))
        sets.append({tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 10 * min(len(a), len(b)) >= 8 * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= share * (len(a) + len(b) - shared):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def quality(docs, min_docs=10, max_share=0.01, min_left=30):
    """docs: (doc_id, text, host); the figures of the quality rules."""
    normal = lambda x: re.sub("[0-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", x.lower())).strip(" ")
    texts, sharing, rows = {}, {}, []
    for d, t, h in docs:
        t = t or ""
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        texts.setdefault(h, set()).add(t)
        for x in lines:
            sharing.setdefault((h, normal(x)), set()).add(t)
        rows.append((d, t, h, lines))
    out = []
    for d, t, h, lines in rows:
        w = SPACED.findall(t)
        at = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        rep = {j for i in range(len(w) - 4) if at[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        gone = sum(len(SPACED.findall(x)) for x in lines if len(sharing[h, normal(x)]) > max(min_docs, max_share * len(texts[h])))
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        kept = not failed and not 100 * (len(w) - gone) < min_left * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep), failed, kept, gone))
    return sorted(out, key=repr)

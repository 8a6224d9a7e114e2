"""Plain-Python statements of what the operators return, to test against."""

import hashlib
import re
from collections import Counter

import numpy as np

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def words(text):
    return WORD.findall((text or "").translate(AZ))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def contamination(text, items, window=13):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        n = min(window, len(w))
        for s in range(len(w) - n + 1) if n else ():
            for i in range(len(own) - n + 1):
                if own[i : i + n] == w[s : s + n]:
                    hit.update(range(i, i + n))
                    found.add("" if item is None else str(item))
    digest = sha(",".join(sorted(found)))
    return len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)


def repeats(texts, length=400):
    """(n_bytes, n_removed, n_spans, sha of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((len(r), int(gone.sum()), int((edges == 1).sum()), sha(kept)))
    return out


def secrets(text):
    """Base spans (kind, start, end) by start and kind."""
    t, found = text or "", []
    found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def units(text, size=5):
    """The weighted shingles of a text: each with the number of its earlier occurrences."""
    w, before, out = words(text), Counter(), set()
    for g in [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] or ([tuple(w)] if w else []):
        out.add((g, before[g]))
        before[g] += 1
    return out


def near_classes(rows, similar=0.8):
    """rows (key, text) → key → smallest key of its class; keys are distinct."""
    sets, posts, up = {}, {}, {}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for key, text in rows:
        up[key], sets[key] = key, units(text)
        near = Counter(other for u in sets[key] for other in posts.get(u, ()))
        for other, n in near.items():
            if n >= similar * (len(sets[key]) + len(sets[other]) - n):
                a, b = top(key), top(other)
                up[max(a, b)] = min(a, b)
        for u in sets[key]:
            posts.setdefault(u, []).append(key)
    return {key: top(key) for key in up}


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def licenses(text):
    w, starts, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(w), len(starts), *ends, ",".join(sorted(labels))


def collocations(docs, least=30, longest=4, most=2000):
    """{lang: [(phrase, a, l, r, n, score), …]} of (text, lang) pairs, best first."""
    counts, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, c in counts.items():
        cand = [p for p, a in c.items() if len(p) > 1 and a >= least]
        longer = {}
        for p in cand:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i : i + m]
                    longer[q] = max(longer.get(q, 0), c[p])
        rows = []
        for p in cand:
            a = c[p]
            if 100 * longer.get(p, 0) >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, l, r, total[lang], score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        if rows:
            out[lang] = rows[:most]
    return out


def resampled(docs, target, least=20, percent=25, seed=7):
    """Sorted (doc_id, n_features, weight, score, rank) of (doc_id, text) pairs."""
    import math
    import zlib

    def buckets(text):
        w = words(text)
        runs = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        return [zlib.crc32(f.encode()) % 10000 for f in runs]

    s, t = (Counter(b for x in texts for b in buckets(x)) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        own = buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(own), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)

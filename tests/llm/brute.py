"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def substring_dedup(docs, window=20):
    """docs: (id, text).  Rows of the query, by id."""
    docs = sorted(docs, key=lambda d: d[0])
    first, words = {}, {i: SPACES.findall(t or "") for i, t in docs}
    for i, _ in docs:
        w = words[i]
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s:s + window]), (i, s))
    out = []
    for i, _ in docs:
        w = words[i]
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] != (i, s):
                gone.update(range(s, s + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def roots(n, pairs):
    """Label of each of n things: the least index reachable by pairs."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_groups(docs):
    """docs: (id, text).  (id, n_shingles, component), by id."""
    docs = sorted(docs, key=lambda d: d[0])
    sets = []
    for _, t in docs:
        w = SPACES.findall(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    has = {}
    for i, s in enumerate(sets):
        for x in s:
            has.setdefault(x, []).append(i)
    pairs, seen = [], set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in has[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                pairs.append((i, j))
    label = roots(len(docs), pairs)
    return [(d[0], len(s), docs[r][0]) for d, s, r in zip(docs, sets, label)]


def discounts(counts, cut=5):
    """Discounted count of each n-gram by Good and Turing, written out from the counts of counts."""
    from collections import Counter
    from fractions import Fraction

    n = Counter(counts.values())
    star = {r: Fraction((r + 1) * n[r + 1], n[r]) for r in range(1, cut + 1) if n[r]}
    if len(star) == cut and n[cut + 1]:
        rest = Fraction((cut + 1) * n[cut + 1], n[1])
        if rest < 1:
            kept = {r: (star[r] / r - rest) / (1 - rest) for r in star}
            if all(0 < k < 1 for k in kept.values()):
                return {g: float(kept.get(c, 1) * c) for g, c in counts.items()}
    off = Fraction(n[1], n[1] + 2 * n[2]) if n[1] and n[2] else Fraction(1, 2)
    return {g: float(c - off if c <= cut else c) for g, c in counts.items()}


def katz(docs, order):
    """docs: (id, text).  Rows of the language-model query by plain dictionaries and recursion, by id."""
    import math
    import zlib
    from collections import Counter, defaultdict

    lines = {i: ["<s>", *SPACES.findall(lower(t)), "</s>"] for i, t in docs}
    out_of = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    counts = {n: Counter() for n in range(1, order + 1)}
    for i, line in lines.items():
        if not out_of[i]:
            counts[1].update((w,) for w in line[1:])
            for n in range(2, order + 1):
                counts[n].update(zip(*[line[k:] for k in range(n)]))
    uni = {g[0]: c for g, c in counts[1].items()}
    total = sum(uni.values())
    cut = {n: discounts(c) for n, c in counts.items()}
    p1 = {g[0]: d / (total + 1) for g, d in cut[1].items()}
    unknown = 1 - sum(p1.values())
    after = defaultdict(list)
    for n in range(2, order + 1):
        for g in counts[n]:
            after[g[:-1]].append(g[-1])
    sizes = {h: sum(counts[len(h) + 1][(*h, w)] for w in ws) for h, ws in after.items()}
    sizes = {h: n + (n > 5) for h, n in sizes.items()}
    weights = {}

    def weight(h):
        if h not in weights:
            left = 1 - sum(cut[len(h) + 1][(*h, w)] for w in after[h]) / sizes[h]
            weights[h] = left / (1 - sum(p(w, h[1:]) for w in after[h]))
        return weights[h]

    def p(w, h):
        if not h:
            return p1.get(w, unknown)
        if h not in after:
            return p(w, h[1:])
        seen = cut[len(h) + 1].get((*h, w))
        return weight(h) * p(w, h[1:]) if seen is None else seen / sizes[h]

    rows = []
    for i in sorted(lines):
        line = lines[i]
        rows.append((i, out_of[i], len(line) - 1, sum(w in uni for w in line[1:]), total,
                     sum(math.log10((uni.get(w, 0) + 0.1) / (total + 0.1 * (len(uni) + 1))) for w in line[1:]),
                     sum(math.log10(p(w, tuple(line[max(0, at + 2 - order):at + 1]))) for at, w in enumerate(line[1:]))))
    return rows, p, after, p1, unknown


LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licences(docs):
    """(id, n_words, n_base, first_word, last_word, base_labels) by id."""
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    out = []
    for i, t in sorted(docs, key=lambda d: d[0]):
        w = LETTERS.findall(lower(t))
        found = [(s, label) for s in range(len(w)) for p, label in phrases.items() if tuple(w[s:s + len(p)]) == p]
        starts = [s for s, _ in found]
        out.append((i, len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small_letters(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def leaks(docs, items, window=10):
    """Rows (id, n_words, hit words, items)."""
    known = {}
    for name, text in items:
        w = TERM.findall(small_letters(text))
        n = min(len(w), window)
        for p in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[p:p + n]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, places, names = TERM.findall(small_letters(text)), set(), set()
        for n in {len(k) for k in known}:
            for p in range(len(w) - n + 1):
                if (key := tuple(w[p:p + n])) in known:
                    places.update(range(p, p + n))
                    names |= known[key]
        out.append((i, len(w), sorted(places), sorted(names)))
    return out


def ranked(docs, queries, k=10):
    """Rows (query, rank, id, score)."""
    sets = [(i, Counter(TERM.findall(small_letters(t)))) for i, t in docs]
    n_docs, all_terms = sum(bool(c) for _, c in sets), sum(sum(c.values()) for _, c in sets)
    df = Counter(t for _, c in sets for t in c)
    out = []
    for q, text in queries:
        found = []
        for i, c in sets:
            n, score = sum(c.values()), 0
            for t, repeats in Counter(TERM.findall(small_letters(text))).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += repeats * w * (10 ** 9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // all_terms)))
            if score > 0:
                found.append((-score, i is not None, i))
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def collocations(docs, least, longest=4, top=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score)."""
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", small_letters(text)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[p:p + n])) for n in range(1, longest + 1) for p in range(len(w) - n + 1))
    chosen = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in chosen.items():
        if any(100 * b >= 80 * a and any(v[p:p + len(w)] == w for p in range(len(v) - len(w) + 1))
               for (other, v), b in chosen.items() if other == lang and len(v) > len(w)):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                    for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return [(lang, r + 1, p.decode(), -a, left, right, total[lang], -s) for lang, found in out.items()
            for r, (s, a, p, left, right) in enumerate(sorted(found)[:top])]

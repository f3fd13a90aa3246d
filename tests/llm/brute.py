"""Plain versions of the corpus operators, for small tables."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def statistics(text):
    w = WORD.findall(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(grams)
    covered = {k for i, g in enumerate(grams) if count[g] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), lines


def shingles(text, k=5):
    w = WORD.findall(text.translate(LOWER))
    if len(w) >= k:
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def row_components(rows, percent):
    """(set size, smallest id reachable) of each row (id, text), in their order; every row is a node."""
    sets = [shingles(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    places: dict = {}
    for i, mine in enumerate(sets):
        for j, n in Counter(j for g in mine for j in places.get(g, ())).items():
            if 100 * n >= percent * (len(mine) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in mine:
            places.setdefault(g, []).append(i)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return [(len(sets[i]), least[find(i)]) for i in range(len(rows))]


def components(texts, percent):
    """{id: (set size, component)} of {id: text}."""
    rows = sorted(texts.items())
    return {i: found for (i, _), found in zip(rows, row_components(rows, percent), strict=True)}


def row_repeats(rows, length):
    """(bytes, removed flags) of each row (id, text), in their order; a byte goes for a smaller id alone."""
    first: dict = {}
    data = [(t or "").encode() for _, t in rows]
    for (i, _), b in zip(rows, data, strict=True):
        for p in range(len(b) - length + 1):
            key = b[p : p + length]
            first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        out.append((b, bytes(gone)))
    return out


def repeats(texts, length):
    """{id: (bytes, removed flags)} of {id: text}."""
    rows = sorted(texts.items())
    return {i: found for (i, _), found in zip(rows, row_repeats(rows, length), strict=True)}


def lines_removed(texts, run, chars, words=None, long_chars=None):
    """{id: set of line numbers} of {id: text}; with words or long_chars shorter runs that are long, or a whole text, count too."""
    first, out = {}, {}
    for i in sorted(texts):
        norm = [x.strip(" \t\r") for x in texts[i].split("\n")]
        gone = set()
        for k in range(run if words is None and long_chars is None else 1, run + 1):
            for s in range(len(norm) - k + 1):
                g = tuple(norm[s : s + k])
                n = sum(map(len, g))
                counts = n >= chars and k in (run, len(norm))
                if k < run:
                    counts |= words is not None and len(" ".join(g).split()) >= words
                    counts |= long_chars is not None and n >= long_chars
                if counts and first.setdefault(g, (i, s)) < (i, s):
                    gone.update(range(s, s + k))
        out[i] = gone
    return out


def winnowed_lines(texts, run, hashed):
    """As ``lines_removed`` without a least length, by winnowing as it is described: all pairs of positions with one
    fingerprint (the first least ``hashed`` line of a window) are extended to both sides, and the later run goes."""
    norm = {i: [x.strip(" \t\r") for x in t.split("\n")] for i, t in texts.items()}
    places: dict = {}
    for i in sorted(norm):
        lines = norm[i]
        for p in sorted({min(range(s, s + run), key=lambda q: (hashed(lines[q]), q)) for s in range(len(lines) - run + 1)}):
            places.setdefault(lines[p], []).append((i, p))
    gone = {i: set() for i in texts}
    for found in places.values():
        for n, (i, p) in enumerate(found):
            for j, q in found[:n]:
                a, b = norm[i], norm[j]
                left = right = 0
                while min(p, q) - left > 0 and a[p - left - 1] == b[q - left - 1]:
                    left += 1
                while p + right + 1 < len(a) and q + right + 1 < len(b) and a[p + right + 1] == b[q + right + 1]:
                    right += 1
                if left + right + 1 >= run:
                    gone[i].update(range(p - left, p + right + 1))
    return gone


def license_base(text):
    """(n_words, starts of phrase places, labels)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), [i for i, _ in found], sorted({x for _, x in found})


def license_spans(text, templates):
    """{(label, first, last, share)} of the notices (label, deciding phrases, text) found in a text, by voting over all pairs of positions."""
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = cut.findall(text.translate(LOWER))
    hits = []
    for t, (label, deciding, body) in enumerate(templates):
        own = cut.findall(body.translate(LOWER))
        n = len(own)
        need = set()
        for phrase in deciding:
            d = cut.findall(phrase.translate(LOWER))
            at = next(j for j in range(n) if own[j : j + len(d)] == d)
            need |= {(j, 2) for j in range(at, at + len(d) - 1)}
        kinds = {(j, 3) for j in range(n - 2)} | need if n >= 25 else {(j, 2) for j in range(n - 1)}
        votes: dict = {}
        for j, k in kinds:
            for i in range(len(words) - k + 1):
                if words[i : i + k] == own[j : j + k]:
                    votes.setdefault(i - j, set()).add((j, k))
        reach = max(2, n // 4)
        total = {d: sum(len(votes[e]) for e in votes if abs(e - d) <= reach) for d in votes}
        rank = {d: (total[d], len(votes[d]), -d) for d in votes}
        for peak in votes:
            if total[peak] * 3 < 0.75 * n or any(rank[d] > rank[peak] for d in votes if abs(d - peak) <= reach):
                continue
            place: dict = {}
            for d in sorted((d for d in votes if abs(d - peak) <= reach), key=lambda d: (abs(d - peak), d)):
                for vote in votes[d]:
                    place.setdefault(vote, d)
            covered = {x for j, k in place for x in range(j, j + k)}
            first, last = min(d + j for (j, _), d in place.items()), max(d + j + k - 1 for (j, k), d in place.items())
            if len(covered) >= 0.75 * n and last - first < 1.5 * n + 2 and need <= set(place):
                hits.append((first, last, t, label, len(covered), len(covered) / n))
    out, chain, end = set(), [], None
    for h in [*sorted(set(hits)), None]:
        if chain and (h is None or h[0] > end):
            best = max(chain, key=lambda x: (x[4], x[5], -x[0], -x[2]))
            out |= {(x[3], x[0], x[1], x[5]) for x in chain if x == best or x[0] > best[1] or x[1] < best[0]}
            chain, end = [], None
        if h is not None:
            chain.append(h)
            end = h[1] if end is None else max(end, h[1])
    return out

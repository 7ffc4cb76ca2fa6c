"""Plain-Python versions of the document operators' results."""

import collections
import hashlib
import math
import re

_A_Z = re.compile("[A-Z]+")


def low(text):
    return _A_Z.sub(lambda m: m[0].lower(), text or "")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes(rows, n, percent=80):
    """rows: (id, text), ids distinct; {id: (n_shingles, component, kept)}."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    inverted, first = collections.defaultdict(list), {}
    for i in sorted(sets):
        own = sets[i]
        if not own:
            continue
        if own in first:
            parent[find(i)] = find(first[own])
            continue
        first[own] = i
        shared = collections.Counter(j for s in own for j in inverted[s])
        for s in own:
            inverted[s].append(i)
        for j, c in shared.items():
            if 100 * c >= percent * (len(own) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    least = {}
    for i in sorted(sets):
        least.setdefault(find(i), i)
    return {i: (len(sets[i]), least[find(i)], least[find(i)] == i) for i in sets}


def windows(items, n=10):
    out = collections.defaultdict(set)
    for i, text in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
        for k in range(max(1, len(w) - n + 1) if w else 0):
            out[tuple(w[k : k + n])].add(i)
    return out


def contamination(text, found):
    """(n_words, n_hit, n_items, items_sha256, contaminated)."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    hit, items = set(), set()
    for n in {len(k) for k in found}:
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in found:
                hit.update(range(k, k + n))
                items |= found[tuple(w[k : k + n])]
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit)


def cut_lines(rows, n=3):
    """rows: (id, text); [(id, n_lines, n_removed, text)] in order of id; equal rows count as one."""
    seen, gone = set(), collections.defaultdict(set)
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        lines = [] if text is None else text.split("\n")
        for p in range(len(lines) - n + 1):
            w = tuple(lines[p : p + n])
            if w in seen:
                gone[i, text].update(range(p, p + n))
            seen.add(w)
    out = []
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        rest = [x for p, x in enumerate(lines) if p not in gone[i, text]]
        out.append((i, len(lines), len(lines) - len(rest), None if text is None else "\n".join(rest)))
    return out


_M = 2**64 - 1


def _mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _M
    return x ^ x >> 31


def _span_key(b):
    key = 0
    for step in range(0, max(1, len(b)), 8):
        key = _mix(key * 0x9E3779B97F4A7C15 + int.from_bytes(b[step : step + 8], "little") + step & _M)
    return key ^ _mix(len(b))


def crf_features(word, bits):
    """Hashed features of a word (bytes, lower case), one by one."""
    w = b"\x01" + word + b"\x02"
    number = lambda part, kind: int.from_bytes(part, "little") + (kind << 40)
    raw = [_span_key(w), number(w[:2], 1), number(w[:3], 2), number(w[:4], 3), number(w[-2:], 4), number(w[-3:], 5), number(w[-4:], 6)]
    raw += [number(w[k : k + 2], 7) for k in range(len(w) - 1)] + [number(w[k : k + 3], 8) for k in range(len(w) - 2)]
    return [_mix(x & _M) >> (64 - bits) for x in raw]


def language(model, text):
    """(language, score) of one text under a model's weights, with loops over words and labels."""
    text = re.sub("[A-Z\u00c0-\u00d6\u00d8-\u00de]", lambda m: m[0].lower(), text or "")
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    words = re.findall(rb"[A-Za-z\x80-\xff]+", text.encode())
    labels = range(len(model.labels))
    total = [0.0] * len(model.labels)
    for at in range(0, len(words), model.chain):
        scores = []
        for w in words[at : at + model.chain]:
            rows = [model.weights[model.row[f]] for f in crf_features(w, model.bits)]
            sums = [sum(float(r[y]) for r in rows) for y in labels]
            scores.append([math.exp(x - max(sums)) for x in sums])
        move = [[math.exp(model.transition[a, b]) for b in labels] for a in labels]
        ahead = [[math.exp(model.start[y]) * scores[0][y] for y in labels]]
        for s in scores[1:]:
            now = [s[b] * sum(ahead[-1][a] * move[a][b] for a in labels) for b in labels]
            ahead.append([x / sum(now) for x in now])
        back = [[1.0 for _ in labels]]
        for s in scores[:0:-1]:
            now = [sum(move[a][b] * s[b] * back[0][b] for b in labels) for a in labels]
            back.insert(0, [x / sum(now) for x in now])
        for f, b in zip(ahead, back):
            both = [x * y for x, y in zip(f, b)]
            total = [t + x / sum(both) for t, x in zip(total, both)]
    best = max(labels, key=lambda y: (total[y], -y))
    return model.labels[best], total[best] / len(words)

"""The operators' results by plain Python, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

Rows = list[tuple]  # (doc_id, text)


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def fingerprint(text: str | None) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    found = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def simhash(rows: Rows) -> dict:
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {rows[i][0]: (f"{prints[i]:016x}", least[find(i)]) for i in range(len(rows))}


def substring(rows: Rows, width: int = 50) -> dict:
    first, out = {}, {}
    tokens = [(d, words(t)) for d, t in rows]
    for d, w in tokens:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, d), d)
    for d, w in tokens:
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def rule_statistics(text: str | None) -> tuple:
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if words(x)]
    marks = len(re.findall("[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), marks, len(lines) - len(set(lines)), len(covered)


def backoff(rows: Rows) -> dict:
    tokens = [words(t) for _, t in rows]
    one, two, total = Counter(), Counter(), 0
    for w in tokens:
        one.update(w)
        two.update(zip(w, w[1:]))
        total += len(w)
    out = {}
    for (key, _), w in zip(rows, tokens, strict=True):
        a, b, log_prob = Counter(w), Counter(zip(w, w[1:])), 0.0
        for i, x in enumerate(w):
            p = max(one[x] - a[x], 0.5) / max(total - len(w), 1)
            if i:
                met = two[w[i - 1], x] - b[w[i - 1], x]
                p = met / (one[w[i - 1]] - a[w[i - 1]]) if met else 0.4 * p
            log_prob += math.log(p)
        out[key] = (len(w), log_prob)
    return out


def tree_shard(key: str, tree: dict) -> int:
    """Descends by exponential draws over chained XXH64 values of key, level and child."""

    def weight(x) -> float:
        return sum(map(weight, x.values())) if isinstance(x, dict) else x

    def drawn(level: str, children: dict) -> str:
        draws = []
        for name, child in children.items():
            seed = 42
            for part in (key, level, str(name)):
                seed = xxhash.xxh64_intdigest(part.encode(), seed)
            if weight(child) > 0:
                draws.append((-math.log(((seed >> 11) + 0.5) / 2**53) / weight(child), name))
        return min(draws)[1]

    for level in ("region", "rack", "shard"):
        name = drawn(level, tree)
        tree = tree[name]
    return name


def hard_negatives(rows: list[tuple]) -> list[tuple]:
    """(vec_id, label, vector) to (anchor, positive, rank, negative, both scores), by all pairs."""
    good = []
    for key, label, v in rows:
        if key is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * float(x)) for x in v]))
    out = []
    for key, label, v in good:
        if key % 100:
            continue
        met = sorted((-sum(a * b for a, b in zip(v, w)), k, x) for k, x, w in good if k != key)
        for score, positive, _ in [m for m in met if m[2] == label][:5]:
            fits = [m for m in met if m[2] != label and 80 * -score <= 100 * -m[0] <= 100 * -score][:5]
            out += [(key, positive, i + 1, n, -score, -s) for i, (s, n, _) in enumerate(fits)]
    return sorted(out)


def decontaminate(rows: Rows, items: Rows, window: int = 10) -> list[tuple]:
    """(doc_id, words, hit words, items with a hit as text) per row."""

    def plain(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)

    owners = {}
    for key, text in items:
        w = plain(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            owners.setdefault(tuple(w[i : i + size]), set()).add(key)
    out = []
    for key, text in rows:
        w, hit, met = plain(text), set(), set()
        for size in {len(x) for x in owners}:
            for i in range(len(w) - size + 1):
                found = owners.get(tuple(w[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    met |= found
        names = ",".join(sorted(str(x) for x in met if x is not None))
        out.append((key, len(w), len(hit), names))
    return out


def alignment(tokens: list[tuple]) -> list[tuple]:
    """(a, b) lists of (id, bytes) a text to its counts and groups, offset by offset."""
    aligned, counts = [], Counter()
    for a, b in tokens:
        spans = []
        for side in (a, b):
            at, ranges = 0, []
            for key, raw in side:
                ranges.append((key, at, at + len(raw)))
                at += len(raw)
            spans.append(ranges)
        links = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for high in cuts:
            sides = [",".join(str(k) for k, s, e in r if low <= s and e <= high) for r in spans]
            groups.append("|".join(sides))
            low = high
        counts.update(links)
        aligned.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for n_a, n_b, n_groups, links, groups in aligned:
        n_best = sum(counts[x] == best[x[1]] for x in links)
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, n_groups, len(links), n_best, sum(counts[x] for x in links), sha))
    return out

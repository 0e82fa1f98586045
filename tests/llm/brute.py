"""Plain Python versions of what the operators compute, for small tables."""

import hashlib
from collections import Counter, defaultdict


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows):
    """``{(id, set size, component)}`` counted; rows are (id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for k in s for j in held[k])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for k in s:
            held[k].append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            root = find(i)
            least[root] = min(least.get(root, key), key)
    return Counter((key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def removal(rows, length=100):
    """``{id: (bytes, removed, spans, digest)}``; ids differ."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[key] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def item_leaks(docs, items):
    """``{(doc, item)}`` with a window of the item's size that is similar enough."""
    found = set()
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            target = (item or "").lower().split()
            if not target:
                continue
            size = min(5, len(target))
            want = Counter(tuple(target[k : k + size]) for k in range(len(target) - size + 1))
            for s in range(max(1, len(words) - len(target) + 1)):
                window = words[s : s + len(target)]
                if len(window) < size:
                    continue
                got = Counter(tuple(window[k : k + size]) for k in range(len(window) - size + 1))
                shared = sum((want & got).values())
                if shared and shared >= 0.8 * (sum(want.values()) + sum(got.values()) - shared):
                    found.add((d, i))
    return found

"""Plain versions of the operators, for tests: small inputs, one machine, no tricks."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def roots(nodes, pairs):
    """Smallest node reachable from each node."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def vector_links(rows, threshold=0.9):
    """vec_id -> (n_links, component)."""
    ids = [i for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([v for i, v in rows if i in set(ids)], float)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    linked = np.concatenate([x[i : i + 2000] @ x.T >= threshold for i in range(0, len(x), 2000)])
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(linked)
    root = roots([i for i, _ in rows], [(ids[p], ids[q]) for p, q in zip(a, b, strict=True) if p < q])
    count = dict(zip(ids, linked.sum(1).tolist(), strict=True))
    return {i: (count.get(i, 0), root[i]) for i, _ in rows}


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_links(rows, percent=85):
    """doc_id -> (n_shingles, component): exact, by the rarest shingles of each set."""
    sets = {i: shingles(t) for i, t in rows}
    df = Counter(s for v in sets.values() for s in v)
    posting, pairs = defaultdict(list), []
    for i, v in sets.items():
        rare = sorted(v, key=lambda s: (df[s], s))[: len(v) - -(-percent * len(v) // 100) + 1]
        seen = set()
        for s in rare:
            seen.update(posting[s])
            posting[s].append(i)
        for j in seen:
            small, big = sorted((len(v), len(sets[j])))
            if 100 * small >= percent * big:
                both = len(v & sets[j])
                if 100 * both >= percent * (len(v) + len(sets[j]) - both):
                    pairs.append((i, j))
    root = roots(list(sets), pairs)
    return {i: (len(v), root[i]) for i, v in sets.items()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """Counts and digest of the base spans."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    spans = [[(k, *m.span()) for m in re.finditer(p, text) if ok(m)] for k, p, ok in kinds]
    return (*map(len, spans), sha(",".join(f"{k}:{a}:{b}" for s in spans for k, a, b in s)), [s for one in spans for s in one])


def secrets(text):
    kinds = [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
    ]
    spans = [[(m.start(), n, m.end(), k) for m in re.finditer(p, text) if ok(m)] for n, (k, p, ok) in enumerate(kinds)]
    ordered = sorted(s for one in spans for s in one)
    return (*map(len, spans), sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in ordered)), [(k, a, b) for a, _, b, k in ordered])


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """source -> target, by resharing what is above the limits until nothing is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: most * sizes[s] for s in over})


def tiktoken_encoding(path, pattern):
    import tiktoken

    with open(path, "rb") as held:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, held)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

"""Plain Python versions of the corpus operators that SQL can't express."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

M64 = (1 << 64) - 1


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def roots(nodes, edges):
    """Smallest node that links lead to, of each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs, pct=75):
    """``{doc_id: (n_shingles, component_id)}`` of ``[(doc_id, text)]`` with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    edges = []
    for i, s in sets.items():
        for j, o in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * o >= pct * (len(s) + len(sets[j]) - o):
                edges.append((i, j))
    root = roots(sets, edges)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def _mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def token_hash(token):
    value = sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(token)) & M64
    return _mix(value + len(token) * 0xD6E8FEB86659FD93 & M64)


def sequence_hash(parts):
    state = len(parts)
    for p in parts:
        state = _mix(state * 0x9E3779B97F4A7C15 + p & M64)
    return state


def quality_features(text, buckets):
    tokens = [token_hash(t) for t in re.findall(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\x20\x09-\x0d]+", lower(text).encode())]
    return [t % buckets for t in tokens] + [sequence_hash(p) % buckets for p in zip(tokens, tokens[1:], strict=False)]


def quality_weights(docs, good, buckets):
    """Log weights of ``{doc_id: text}``; ``good`` are the ids of the target's documents."""
    raw, target = np.ones(buckets), np.ones(buckets)
    found = {i: quality_features(t, buckets) for i, t in docs.items()}
    for i, f in found.items():
        for x in f:
            raw[x] += 1
            target[x] += i in good
    ratios = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return {i: ratios[f].sum() if f else 0.0 for i, f in found.items()}


def first_fit_decreasing(lengths, size):
    bins, places = [], {}
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = next((b for b, used in enumerate(bins) if used + lengths[item] <= size), len(bins))
        if at == len(bins):
            bins.append(0)
        places[item] = (at, bins[at])
        bins[at] += lengths[item]
    return [places[i] for i in range(len(lengths))]


# --- conversations -------------------------------------------------------------------------

STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def cheapest_repair(rows):
    """Cost and audit of ``[(initial, fault)]`` by searching all edits, cheapest and least first."""
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in "ua":
            if state in STEPS[role]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, STEPS[role][state]))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            for role in "sua" if fault not in ("blank", "duplicate") else "":
                if state in STEPS[role]:
                    more = 3 * (fault == "truncated")
                    if role == initial:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, STEPS[role][state]))
                    if role != "s":
                        heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, STEPS[role][state]))


def repaired_conversations(rows):
    """``{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}`` of ``(conv_id, turn, role, text)``."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * [1, 0, 2][(kind == 0) + 2 * (kind == 3)]
    out = {}
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols = set(), []
        for _, role, text in own:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else None if visible[-1] in ".!?" else "truncated"
            seen.add((role, text))
            symbols.append((role[:1], fault))
        cost, audit = cheapest_repair(symbols)
        turns = [t for t, _, _ in own if t is not None]
        left, made, n = iter(own), [], len(audit) - audit.count("D")
        for letter in audit:
            _, role, text = (None, None, "") if letter == "I" else next(left)
            if letter != "D":
                made.append((role if letter == "K" else ["user", "assistant"][(len(made) - n % 2) % 2]) + ":" + text)
        pairs = [a[0] + b[0] for a, b in zip(symbols, symbols[1:], strict=False)]
        counts = Counter(f for _, f in symbols)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


# --- words and vectors ---------------------------------------------------------------------

def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling(docs, damage=199):
    """``{word: (form, root, n, n_near, form_n)}`` of ``(doc_id, text)``, by comparing all words with all."""
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % damage == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and _near(w, x)]
        form = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = (form if form and words[form] >= 5 * n else None, n, len(near))
    root = lambda w: w if out[w][0] is None else root(out[w][0])
    return {w: (f, root(w), n, near, words.get(f)) for w, (f, n, near) in out.items()}


def nearest(rows, top):
    """``[(query_id, [(vec_id, score)])]`` of ``(vec_id, vector)`` by comparing every query with all."""
    def valid(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    kept, seen = [], set()
    for i, v in rows:
        if valid(v) and (i, tuple(np.trim_zeros(v, "b"))) not in seen:
            seen.add((i, tuple(np.trim_zeros(v, "b"))))
            kept.append((i, v))
    width = max((len(v) for _, v in kept), default=0)
    matrix = np.array([[*v, *[0.0] * (width - len(v))] for _, v in kept]).reshape(len(kept), width)
    out = []
    for q, (i, _) in enumerate(kept):
        if i is not None and i % 20 == 0:
            scores = np.cumsum(matrix * matrix[q], axis=1)[:, -1]
            others = [(-s, j is None, j or 0, j) for (j, _), s, k in zip(kept, scores, range(len(kept)), strict=True) if k != q]
            out.append((i, [(j, -s) for s, _, _, j in sorted(others, key=lambda x: x[:3])[:top]]))
    return out

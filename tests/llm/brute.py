"""Plain versions of the contracts, one document after another."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def crc(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def bpe_digests(text, encoding):
    ids = encoding.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def base_rules(text):
    got = words(text)
    grams = [tuple(got[i : i + 3]) for i in range(len(got) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    out = {
        "n_words": len(got),
        "word_chars": sum(map(len, got)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
    return out | {"base_failed": len(got) < 50 or 100 * len(covered) > 50 * len(got)}


def shingles(text, n=3):
    got = words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not got:
        return frozenset()
    return frozenset(tuple(got[i : i + n]) for i in range(len(got) - n + 1)) if len(got) >= n else frozenset([tuple(got)])


def near_components(rows, n=3, percent=85):
    """doc_id -> (set size, smallest reachable doc_id), all pairs that share a shingle."""
    sets = {d: shingles(t, n) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    both = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                both[a, b] += 1
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), k in both.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def secret_spans(text):
    """(start, stop, kind) of the base patterns."""
    t, out = text or "", []
    value = r"[A-Za-z0-9+/_.=-]+"
    for m in re.finditer(rf"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?({value})""", t):
        if len(m[1]) >= 8:
            out.append((m.start(), m.end(), "assign"))
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))


def digest_of_spans(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()


def substring_kept(rows, n=20):
    """doc_id -> (words, removed, digest of the kept text)."""
    order = sorted((d, words(t)) for d, t in rows)
    seen, out = set(), {}
    for d, got in order:
        gone = np.zeros(len(got), bool)
        for i in range(len(got) - n + 1):
            g = tuple(got[i : i + n])
            if g in seen:
                gone[i : i + n] = True
            seen.add(g)
        kept = " ".join(w for w, x in zip(got, gone, strict=True) if not x)
        out[d] = (len(got), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def mixing_targets(sizes):
    """Targets by source: shares by weight 1, 2, 3, at most three times the size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        units = sum(weight[f] for f in free)
        share = {s: left * weight[s] / units for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def nearest(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        far = np.sqrt(((vectors - vectors[ids.index(q)]) ** 2).sum(1))
        out[q] = [(far[i], ids[i]) for i in sorted(range(len(ids)), key=lambda i: (far[i], ids[i])) if ids[i] != q][:k]
    return out


MASK = 2**64 - 1
SPACES = frozenset(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def polynomial(points):
    out = 0
    for p in points:
        out = (out * 0x9E3779B97F4A7C15 + p) & MASK
    return out


def subword_buckets(text, bits):
    """Buckets of the n-grams (3 to 5), words and pairs of neighbours of a text."""
    padded = " " + text + " "
    points = [32 if c in SPACES else ord(c) for c in padded]
    out = []
    for n in (3, 4, 5):
        for i in range(len(points) - n + 1):
            if 32 not in points[i + 1 : i + n - 1]:
                out.append(mixed((polynomial(points[i : i + n]) + n) & MASK) >> (64 - bits))
    found, now = [], []
    for p in [*points, 32]:
        if p != 32:
            now.append(p)
        elif now:
            up, total = 1, 0
            for q in now:
                total += (q + 1) * up
                up = up * 0x9E3779B97F4A7C15 & MASK
            found.append(mixed((total + 1) & MASK))
            now = []
    pairs = [2 if a == b else (a * 3 + b) & MASK for a, b in zip(found[:-1], found[1:], strict=True)]
    return out + [w >> (64 - bits) for w in found] + [mixed(p) >> (64 - bits) for p in pairs]


def quality_score(text, model):
    got = subword_buckets(text or "", model.bits)
    logit = model.bias + (sum(float(model.weights[b]) for b in got) / len(got) if got else 0)
    return 1 / (1 + np.exp(-logit))


def language(text, model):
    """Language and score by the loss of every codeword, n-grams counted one by one."""
    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0
    points, bits = [*map(ord, text.lower()), 10, 10, 10], model.config.bits
    counts = np.zeros(1 << bits)
    for n in model.config.sizes:
        for i in range(len(points) - n + 1):
            counts[mixed((polynomial(points[i : i + n]) + n) & MASK) >> (64 - bits)] += 1
    x = np.sqrt(counts / counts.sum())
    margin = x @ model.weights[:-1] + model.weights[-1]
    trust = model.trust / model.trust.sum()
    loss = [float(sum(t * np.log1p(np.exp(-m * c)) for t, m, c in zip(trust, margin, word, strict=True))) for word in model.code]
    best = int(np.argmin(loss))
    return model.names[best], 1 / sum(np.exp(-8 * (x - loss[best])) for x in loss)


def murmur(text, seed=42):
    """The 32-bit hash of a string as Spark SQL's hash() takes it."""
    raw, m = text.encode(), 2**32 - 1
    turn = lambda x, r: (x << r | x >> (32 - r)) & m
    h = seed & m
    whole = len(raw) - len(raw) % 4
    parts = [int.from_bytes(raw[i : i + 4], "little") for i in range(0, whole, 4)] + [(b - 256 if b > 127 else b) & m for b in raw[whole:]]
    for k in parts:
        h = (turn(h ^ turn(k * 0xCC9E2D51 & m, 15) * 0x1B873593 & m, 13) * 5 + 0xE6546B64) & m
    h ^= len(raw)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def rule_features(text, buckets):
    tokens = words(re.sub(r"([!-/:-@\[-`{-~]+)", r" \1 ", text or ""))
    single = [murmur(t) for t in tokens]
    return [h & (buckets - 1) for h in single] + [murmur(b, h) & (buckets - 1) for h, b in zip(single, [*tokens[1:], None], strict=True) if b is not None] + [h & (buckets - 1) for h in single[-1:]]


def rule_verdicts(rows, trusted, config):
    """doc_id -> (score, kept) by counting every document."""
    raw, target, found = np.zeros(config.buckets), np.zeros(config.buckets), {}
    for d, text in rows:
        found[d] = np.array(rule_features(text, config.buckets), int)
        np.add.at(raw, found[d], 1)
        if d in trusted:
            np.add.at(target, found[d], 1)
    a, b = config.smoothing, config.smoothing * config.buckets
    ratio = np.log((target + a) / (target.sum() + b)) - np.log((raw + a) / (raw.sum() + b))
    out = {}
    for d, text in rows:
        score = float(ratio[found[d]].mean()) if len(found[d]) else None
        out[d] = (score, not base_rules(text)["base_failed"] and (not target.sum() or (score is not None and score >= config.threshold)))
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergence(rows, least=3, ranks=200):
    """(lang, source, part, item, value, rank) of rows (text, lang, source)."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    tally, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        got = term.findall((text or "").translate(LOWER))
        tally[lang or "", source or ""].update(got)
        held[lang or ""].update(set(got))
    out = []
    for lang in held.keys() | {lang for lang, _ in tally}:
        kept = sorted((t for t, n in held[lang].items() if n >= least), key=str.encode)
        own = {s: [c[t] for t in kept] for (g, s), c in tally.items() if g == lang}
        share = lambda counts: [1 + 10**9 * (c + 1) // (sum(counts) + len(kept)) for c in counts]
        p = {s: share(c) for s, c in own.items()}
        q = share([sum(c) for c in zip(*own.values(), strict=True)])
        f = lambda a, b: (a - b) * (a - b) // b
        for s in own:
            pairs = sorted(((-sum(map(f, p[s], p[o])), o) for o in own if o != s), key=lambda x: (x[0], x[1].encode()))
            terms = sorted(((-f(a, b), t) for t, n, a, b in zip(kept, own[s], p[s], q, strict=True) if n and a > b), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, t) in enumerate(terms[:ranks])]
    return out


def leaks(docs, items, window=10):
    """For each text: its number of words, the word numbers hit, and the sorted ids of the items found."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        got = word.findall((text or "").translate(LOWER))
        n = min(window, len(got))
        for i in range(len(got) - n + 1 if n else 0):
            windows[tuple(got[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        got, hit, found = word.findall((text or "").translate(LOWER)), set(), set()
        for n in sizes:
            for i in range(len(got) - n + 1):
                holders = windows.get(tuple(got[i : i + n]))
                if holders:
                    hit |= set(range(i, i + n))
                    found |= holders
        out.append((len(got), hit, sorted(str(x) for x in found if x is not None)))
    return out


def hard_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """(anchor, positive, rank, negative, scores) of rows (id, label, whole numbers)."""
    out = []
    for anchor, label, vector in rows:
        if not is_anchor(anchor):
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, g) for i, g, v in rows if i != anchor)
        for p, i, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(-s, j) for s, j, g in scored if g != label and low * -p <= 100 * -s <= high * -p]
            out += [(anchor, i, k + 1, j, -p, s) for k, (s, j) in enumerate(inside[:negatives])]
    return out

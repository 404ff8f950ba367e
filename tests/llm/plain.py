"""The contracts, written as plainly as possible."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def held(doc_id, divisor, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % divisor == value


def substring_rows(docs, size=50):
    first = {}
    for i, text in docs:
        words = spaced(text)
        for p in range(len(words) - size + 1):
            key = tuple(words[p : p + size])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in docs:
        words = spaced(text)
        gone = set()
        for p in range(len(words) - size + 1):
            if i is not None and first[tuple(words[p : p + size])] < i:
                gone.update(range(p, p + size))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), sha(" ".join(kept))))
    return out


def luhn(digits):
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in twice) % 10 == 0


def base_spans(text):
    text = text or ""
    only = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
               if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(only(m)) <= 19 and luhn(only(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(only(m)) <= 15],
    }


def unigram_rows(docs):
    end = object()
    tokens = lambda text: [*(lower(w) for w in spaced(text)), end]
    counts = Counter()
    for i, text in docs:
        if i is not None and not held(i, 5, 1):
            counts.update(tokens(text))
    total, different = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        mine = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (different + 1))) for t in mine)
        out.append((i, held(i, 5, 1), len(mine), sum(counts[t] > 0 for t in mine), total, base))
    return out


def phrase_rows(docs, items, size=10):
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    phrases = defaultdict(set)
    for i, text in items:
        words = split(text)
        for p in range(max(1, len(words) - size + 1) if words else 0):
            phrases[tuple(words[p : p + size])].add(i)
    out = []
    for i, text in docs:
        words, hit, found = split(text), set(), set()
        for n in {len(p) for p in phrases}:
            for p in range(len(words) - n + 1):
                if tuple(words[p : p + n]) in phrases:
                    hit.update(range(p, p + n))
                    found |= phrases[tuple(words[p : p + n])]
        out.append((i, len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def quality_counts(text):
    words = spaced(text)
    lines = [line for line in (text or "").split("\n") if spaced(line)]
    seen = Counter(tuple(words[p : p + 5]) for p in range(len(words) - 4))
    again = {q for p in range(len(words) - 4) if seen[tuple(words[p : p + 5])] > 1 for q in range(p, p + 5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again),
            len(words) < 10 or 100 * len(again) > 20 * len(words))


def fingerprint(text, size=4):
    words = spaced(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[p : p + size]) for p in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, threshold=4):
    """For each fingerprint the index of the first one reachable."""
    prints = np.array(prints, np.uint64)
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[k + 1 :] ^ prints[k]) <= threshold) + k + 1:
            a, b = sorted((root(k), root(int(j))))
            parent[b] = a
    return [root(k) for k in range(len(prints))]


def convolved(network, ids):
    """Class probabilities of one row of symbols: each filter at each place, the largest response, the softmax."""
    deep = [network.embedding[i].astype(float) for i in ids]
    nothing = np.zeros(network.embedding.shape[1])
    hidden = []
    for filters, bias in zip(network.filters, network.bias):
        width, _, count = filters.shape
        for f in range(count):
            best = max(sum(float((deep[p + k] if p + k < len(deep) else nothing) @ filters[k, :, f]) for k in range(width)) for p in range(len(deep)))
            hidden.append(max(best + float(bias[f]), 0.0))
    logits = np.array(hidden) @ network.head.astype(float) + network.shift.astype(float)
    parts = np.exp(logits - logits.max())
    return parts / parts.sum()

"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

#: Null and empty texts, blanks, ties, repeated rows, null and repeated ids, one very long word.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "a b c"), (None, "a b c"), (4, "a b c"), (4, "d e f"),
    (5, "w " * 300), (6, "x" * 20_000), (7, "É été \x0b ß\r\nx"), (7, "É été \x0b ß\r\nx"), (8, None),
]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window):
    """rows: [(doc_id, text)]. (doc_id, n_words, n_removed, sha256 of what is kept), sorted."""
    seen = Counter(tuple(w[i : i + window]) for _, t in rows for w in [words(t)] for i in range(len(w) - window + 1))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, bits=3):
    """rows: [(doc_id, text)]. {doc_id: (fingerprint, component)}."""
    prints = {d: fingerprint(t) for d, t in rows}
    at = {d: d for d in prints}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    by = defaultdict(list)
    for d, f in prints.items():
        by[f].append(d)
    keys = list(by)
    for i, f in enumerate(keys):
        for g in keys[i:]:
            if (f ^ g).bit_count() <= bits:
                for d in by[g]:
                    a, b = sorted((root(by[f][0]), root(d)))
                    at[b] = a
    return {d: (f"{f:016x}", root(d)) for d, f in prints.items()}


def base_rules(text):
    """word_chars, n_words, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    again = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n_symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return sum(map(len, w)), len(w), n_symbols, len(lines) - len(set(lines)), len(again), failed


def stretches(same, least):
    """(start, stop) of the best stretches (a match +1, else -2): the shortest best, then those left and right of it."""
    sums = [0]
    for x in same:
        sums.append(sums[-1] + (1 if x else -2))
    pairs = ((i, j) for i in range(len(same)) for j in range(i + 1, len(same) + 1))
    i, j = max(pairs, key=lambda p: (sums[p[1]] - sums[p[0]], p[0] - p[1]), default=(0, 0))
    if sums[j] <= sums[i]:
        return []
    own = [(i, j)] if sum(same[i:j]) >= least else []
    return stretches(same[:i], least) + own + [(a + j, b + j) for a, b in stretches(same[j:], least)]


def crc(text):
    return zlib.crc32((text or "").encode())

"""Plain versions of the operators, without any of their helpers."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(AZ)


def line_dedup(docs, min_docs=10, keep_first=False):
    """docs: (doc_id, text) with distinct ids; {doc_id: (n_lines, n_dropped, kept text)}."""
    holders = defaultdict(set)
    first = {}
    for d, text in sorted(docs, key=lambda x: (x[0] is None, x[0])):
        for i, line in enumerate((text or "").split("\n")):
            holders[line_key(line)].add(d)
            first.setdefault(line_key(line), (d, i))
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for i, x in enumerate(lines) if not line_key(x) or len(holders[line_key(x)]) < min_docs
                or keep_first and first[line_key(x)] == (d, i)]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def tokens(text):
    return TOKEN.findall((text or "").translate(AZ))


def contamination(docs, items, min_words=10):
    """{doc_id: (n_words, n_hit, n_items, digest)}."""
    windows = defaultdict(set)
    for item, text in items:
        w = tokens(text)
        n = min(len(w), min_words)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for d, text in docs:
        w = tokens(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i:i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))))
    return out


def byte_dedup(docs, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept bytes)}."""
    least = {}
    for d, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            least[s] = min(least.get(s, d), d)
    out = {}
    for d, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def word_dedup(docs, length=35):
    """{doc_id: (n_words, n_removed, kept text)}."""
    count = Counter()
    words = {d: WORD.findall(text or "") for d, text in docs}
    for w in words.values():
        count.update(tuple(w[i:i + length]) for i in range(len(w) - length + 1))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - length + 1):
            if count[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = set()
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            repeated.update(range(i, i + 8))
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            n < 20 or 100 * len(repeated) > 30 * n)


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near_duplicates(docs, percent=85):
    """{doc_id: (n_shingles, component_id)} by all pairs that share a shingle."""
    sets = {d: shingles(text) for d, text in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(sets)
    by_shingle = defaultdict(list)
    for d in ids:
        for s in sets[d]:
            by_shingle[s].append(d)
    pairs = {(a, b) for ds in by_shingle.values() for i, a in enumerate(ds) for b in ds[i + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return m[1].translate(AZ), m[2]


def url_rule(host, path, rules):
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def letter_vector(point, dimensions=1024):
    """+1 and -1 from the bits of hashes of the code point, each byte's highest bit first."""
    out, whole = [], 2**64 - 1
    for j in range(dimensions // 64):
        h = ((point * (dimensions // 64) + j) * 0x9E3779B97F4A7C15 + 1) & whole
        h ^= h >> 31
        h = h * 0xBF58476D1CE4E5B9 & whole
        h ^= h >> 27
        h = h * 0x94D049BB133111EB & whole
        h ^= h >> 32
        out += [1 if byte >> (7 - k) & 1 else -1 for byte in h.to_bytes(8, "little") for k in range(8)]
    return out


def languages(docs, n=3):
    """{doc_id: (held out, language, score)} from (doc_id, text, lang), with all other labelled documents as examples."""
    import zlib

    import numpy as np

    letters, grams, bundles = {}, {}, {}
    for d, text, _ in docs:
        letters_only = "".join(c if c.isalpha() else " " for c in text or "").split(" ")
        runs = " ".join("".join(low if len(low := c.lower()) == 1 else c for c in run) for run in letters_only if run)
        counts = Counter(f" {runs} "[i:i + n] for i in range(len(runs) + 3 - n)) if runs else {}
        total = np.zeros(1024)
        for gram, count in counts.items():
            if gram not in grams:
                bound = np.ones(1024)
                for place, c in enumerate(gram):
                    letters.setdefault(c, np.array(letter_vector(ord(c))))
                    bound = bound * np.roll(letters[c], n - 1 - place)
                grams[gram] = bound
            total += count * grams[gram]
        bundles[d] = total if runs else None
    unit = {d: v / np.linalg.norm(v) for d, v in bundles.items() if v is not None and v.any()}
    out_of = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in docs}
    profile = defaultdict(lambda: np.zeros(1024))
    for d, _, lang in docs:
        if lang is not None and not out_of[d] and d in unit:
            profile[lang] += unit[d]
    names = sorted(profile)
    matrix = np.array([profile[x] / np.linalg.norm(profile[x]) for x in names])
    found = {}
    for d, _, _ in docs:
        if bundles[d] is None:
            found[d] = (out_of[d], "und", 0.0)
        else:
            cosine = matrix @ unit[d] if d in unit else np.zeros(len(names))
            found[d] = (out_of[d], names[int(cosine.argmax())], float(min(1, max(0, cosine.max()))))
    return found

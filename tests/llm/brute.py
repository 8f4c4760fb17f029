"""Plain Python versions of the operators, over lists of (doc_id, text)."""

import collections
import hashlib
import math
import re
import string
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def low(text):
    return (text or "").translate(_LOWER)


def words(text):
    return WORD.findall(text or "")


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(texts):
    return [e.ids for e in tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)]


def targets(sizes_by_source, weights=(5, 2, 1), budget=1.5):
    """sizes_by_source: {source or None: words}."""
    names = sorted(sizes_by_source, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, rest, out = budget * sum(sizes_by_source.values()), dict(sizes_by_source), {}
    total = left
    while rest:
        share = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / share > 2 * sizes_by_source[s]]
        if not over:
            return out | {s: left * weight[s] / share for s in rest}
        for s in over:
            out[s] = 2.0 * rest.pop(s)
        left = total - sum(out.values())
    return out


def substring(docs, width=50):
    """[(n_words, n_removed, sha)] in the order of docs."""
    split = [words(t) for _, t in docs]
    rank = [(d is None, d or 0) for d, _ in docs]
    first = {}
    for r, w in sorted(zip(rank, split, strict=True), key=lambda x: x[0]):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k:k + width]), r)
    out = []
    for r, w in zip(rank, split, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < r:
                gone[k:k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fingerprint(text, shingle=3):
    w = words(low(text))
    parts = [" ".join(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, max_bits=2):
    """{fingerprint: a representative} by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def phrases(text):
    w, places, labels = ALNUM.findall(low(text)), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), places, ",".join(sorted(labels))


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, w = text or "", words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    twice = [False] * len(w)
    for k in range(len(w) - 4):
        if n[tuple(w[k:k + 5])] > 1:
            twice[k:k + 5] = [True] * 5
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(twice)


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def base_scores(docs):
    """[(n_tokens, n_known, train_tokens, base_score)] in the order of docs."""
    tokens = [words(low(t)) + [None] for _, t in docs]
    count = collections.Counter()
    for (d, _), t in zip(docs, tokens, strict=True):
        if not held_out(d):
            count.update(t)
    n, v = sum(count.values()), len(count)
    return [(len(t), sum(count[x] > 0 for x in t), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)) for t in tokens]

"""Token counts and ids for whole texts, batched by distinct pre-token.

A slice of texts is cut into pre-tokens with array operations; only its
distinct pre-tokens are looked at one by one, and only if the task has not met
them before.

``RankMerger`` counts tokens by rank-synchronous array merging: the symbols of
all new pre-tokens lie in one ragged array, every round finds the lowest merge
rank of each sequence and merges all its places at once, and what survives is
counted. ``Codec`` gives ids: the tokenizers library's model encodes the
distinct pre-tokens.

The array rules cover ASCII and the letters U+00C0-U+00FF. A text with any
other character, or that may hold a special token, is handed to the library
whole, so results equal the library's for every text.

Defined results: null and empty texts have no tokens; very long texts are counted
whole (a slice is never less than a text); every row is counted for itself, so
repeated rows count alike and nothing ties; an empty table gives an empty result.
Both take a text column, so other columns of any name stay as they are.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.llm import ragged

VOCABULARY = "word_bpe_49k.json"
#: distinct pre-tokens a task keeps before it starts afresh
CACHE = 400_000

_CLASS = np.full(256, 3, np.uint8)  # 0 space, 1 letter, 2 digit, 3 other
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_CLASS[0x30:0x3A] = 2


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pretokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the pre-tokens, and which texts the rules don't cover."""
    low = ragged.LOWER[buf]
    lead = np.flatnonzero(buf == 0xC3)
    after = buf[lead + 1]
    fine = (after >= 0x80) & (after != 0x97) & (after != 0xB7)
    covered = buf < 0x80
    covered[lead[fine]] = covered[lead[fine] + 1] = True
    upper = fine & (after <= 0x9E)
    low[lead[upper] + 1] += 0x20
    odd = ~covered
    odd[:-1] |= (buf[:-1] == 0x3C) & (buf[1:] == 0x7C)  # "<|" may begin a special token
    kind = _CLASS[buf]
    cut = np.ones(len(buf), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    for i in np.flatnonzero((buf == 0x27) & cut):
        tail = bytes(low[i + 1:i + 3])
        n = 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 2 if tail in (b"re", b"ve", b"ll") else 0
        if n:
            cut[i + 1] = False
            cut[i + n + 1] = True
    at = np.flatnonzero(cut)
    ends = np.append(at[1:], len(buf))
    token = kind[at] > 0
    return low, at[token], ends[token], ragged.counts(odd, offsets) > 0


def _distinct(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    key = ragged.span_hash(ragged.lanes(low), starts, ends)
    keys, first, where = np.unique(key, return_index=True, return_inverse=True)
    return keys, first, where


class Known:
    """What a task has learnt: a number for each key, in arrays ordered by key."""

    def __init__(self) -> None:
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, keys: np.ndarray, learn) -> np.ndarray:
        """Numbers of ordered distinct keys; ``learn(places)`` gives those of the new ones."""
        at = np.searchsorted(self.keys, keys)
        out = np.full(len(keys), -1, np.int64)
        old = np.flatnonzero(at < len(self.keys))
        old = old[self.keys[at[old]] == keys[old]]
        out[old] = self.values[at[old]]
        new = np.ones(len(keys), bool)
        new[old] = False
        new = np.flatnonzero(new)
        if len(new):
            out[new] = learn(new)
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.values = np.insert(self.values, at[new], out[new])
        return out


#: each byte stands for one printable character: itself, or the next free one above 255
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
CHARACTER = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def library(path: str):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class RankMerger:
    """Counts of tokens by rank-synchronous merging."""

    def __init__(self, path: str):
        self.whole = library(path)
        model = json.loads(self.whole.to_str())["model"]
        vocab = model["vocab"]
        self.width = np.int64(len(vocab))
        table = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            table[vocab[a] * int(self.width) + vocab[b]] = (rank, vocab[a + b])
        self.pairs = np.array(sorted(table), np.int64)
        self.rank = np.array([table[p][0] for p in self.pairs.tolist()], np.int64)
        self.merged = np.array([table[p][1] for p in self.pairs.tolist()], np.int64)
        self.inner = np.array([vocab[CHARACTER[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[CHARACTER[b] + "</w>"] for b in range(256)], np.int64)
        self.known = Known()

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence once no pair can merge."""
        left = sizes.copy()
        active = np.arange(len(sizes))
        while len(symbols):
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            pair = np.full(len(symbols), -1, np.int64)
            pair[:-1] = symbols[:-1] * self.width + symbols[1:]
            pair[np.append(first[1:], len(symbols)) - 1] = -1
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            rank = np.where(self.pairs[at] == pair, self.rank[at], len(self.pairs))
            lowest = np.minimum.reduceat(rank, first)
            spot = np.flatnonzero((rank == lowest[owner]) & (rank < len(self.pairs)))
            if not len(spot):
                break
            # in runs such as "aaa" every other place merges, from the left
            chained = np.concatenate(([False], np.diff(spot) == 1))
            begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(spot))))
            spot = spot[(np.arange(len(spot)) - begin) % 2 == 0]
            symbols[spot] = self.merged[at[spot]]
            stay = np.ones(len(symbols), bool)
            stay[spot + 1] = False
            sizes = sizes - np.bincount(owner[spot], minlength=len(sizes))
            left[active] = sizes
            alive = lowest < len(self.pairs)
            symbols = symbols[stay & alive[owner]]
            sizes, active = sizes[alive], active[alive]
        return left

    def counts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a slice."""
        low, starts, ends, odd = pretokens(buf, offsets)
        keys, first, where = _distinct(low, starts, ends)
        if len(self.known.keys) > CACHE:
            self.known = Known()

        def learn(new: np.ndarray) -> np.ndarray:
            a, sizes = starts[first[new]], (ends - starts)[first[new]]
            to = np.cumsum(sizes)
            place = np.arange(to[-1]) + np.repeat(a - (to - sizes), sizes)
            symbols = self.inner[low[place]]
            symbols[to - 1] = self.last[low[a + sizes - 1]]
            return self.merge(symbols, sizes)
        each = self.known.look_up(keys, learn)
        out = ragged.sums(each[where], np.searchsorted(starts, offsets))
        for i in np.flatnonzero(odd):
            text = bytes(buf[offsets[i]:offsets[i + 1] - 1]).decode()
            out[i] = len(self.whole.encode(text, add_special_tokens=False).ids)
        return out


class Codec:
    """Ids of whole texts, as the library gives them."""

    def __init__(self, path: str):
        self.whole = library(path)
        self.model = self.whole.model
        self.forget()

    def forget(self) -> None:
        self.slot, self.begin, self.ids = Known(), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def learn(self, words: list[str]) -> np.ndarray:
        """Slots of new pre-tokens (given by the characters of their bytes)."""
        ids = [[t.id for t in self.model.tokenize(w)] for w in words]
        slots = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(ids))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.uint32, sizes.sum())])
        return slots

    def encode(self, buf: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice and the offsets of its texts; ``end`` is appended to each text."""
        low, starts, ends, odd = pretokens(buf, offsets)
        bounds = np.searchsorted(starts, offsets)
        keys, first, where = _distinct(low, starts, ends)
        if len(self.slot.keys) > CACHE:
            self.forget()

        def learn(new: np.ndarray) -> np.ndarray:
            data = low.tobytes().decode("latin-1").translate(CHARACTER)
            at = first[new]
            return self.learn([data[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slot = self.slot.look_up(keys, learn)[where]
        begin = self.begin[slot]
        size = self.begin[slot + 1] - begin
        n = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.arange(n[-1]) + np.repeat(begin - n[:-1], size)]
        at = n[bounds]
        if end is None and not odd.any():
            return flat, at
        parts = []
        for i in range(len(offsets) - 1):
            if odd[i]:
                text = bytes(buf[offsets[i]:offsets[i + 1] - 1]).decode()
                parts.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                parts.append(flat[at[i]:at[i + 1]])
            if end is not None:
                parts.append(np.array([end], np.uint32))
        size = np.array([len(p) for p in parts], np.int64).reshape(len(offsets) - 1, -1).sum(axis=1)
        return np.concatenate(parts) if parts else flat, np.concatenate(([0], np.cumsum(size)))


def count_tokens(text: Column | str, path: str | None = None) -> Column:
    """Tokens of each whole text, by rank-synchronous merging."""
    path = path or vocabulary_path()
    state: list[RankMerger] = []

    def run(texts: pa.Array) -> pa.Array:
        if not state:
            state.append(RankMerger(path))
        parts = [state[0].counts(buf, offsets) for _, _, buf, offsets in ragged.slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    return F.arrow_udf(run, "bigint").asNondeterministic()(ragged.terminated(text))

"""Substring dedup: Rabin-Karp hashes of every token window, counted in Spark.

1. ``_window_rows`` hashes every window of ``width`` words of every whole text.
   A slice of texts settles its own repeats first: of equal windows only those
   of the smallest document go on, the others are already known to repeat. So a
   passage that a third of all documents share sends one entry per slice (and,
   as tasks remember what they have sent, about one per task).
2. The entries are dealt by hash into buckets; a bucket finds the smallest
   document of each hash and returns the entries of all others.
3. The repeated windows of a document meet again and merge into maximal
   intervals of words, which are cut from its text.

Entries travel as packed arrays, about ten bytes a window.

Defined results: a window is repeated if it also starts in a document with a
smaller ``doc_id``; null ids are larger than all others and none is smaller than
another; rows with equal id do not remove each other's words; null, empty and
short texts lose nothing; texts of any length are read whole; an empty table gives an
empty result. Only doc_id and text are read, so extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import ragged

WIDTH = 50
#: stands for a null id
NO_ID = (1 << 63) - 1
SLICE = 6 << 20
#: repeated windows a task remembers
REMEMBERED = 1 << 20

PACKED = "bucket bigint, settled boolean, ids binary, tags binary, counts binary, first binary, other binary"


def planes(values: np.ndarray, dtype: str) -> bytes:
    """Bytes of the integers, all lowest bytes first: high bytes are mostly zero and compress well."""
    v = np.ascontiguousarray(values.astype(dtype))
    return v.view(np.uint8).reshape(-1, v.itemsize).T.tobytes()


def unplanes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """The first value and the differences, modulo 2^64."""
    v = values.astype(np.uint64)
    return v - np.concatenate((np.zeros(1, np.uint64), v[:-1]))


def _pack(bucket: np.ndarray, settled: bool, text: np.ndarray, ids: np.ndarray, tags: np.ndarray,
          first: np.ndarray, other: np.ndarray) -> Iterator[tuple]:
    """A row per bucket. ``text``: which of the texts (``ids``, ``tags``) an entry is of;
    ``first``: first word of the window; ``other``: its hash, or for settled entries
    the number of windows in a row."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cut):
        if not len(rows):
            continue
        own, at = text[rows], first[rows]
        new = np.concatenate(([True], own[1:] != own[:-1]))
        begin = np.flatnonzero(new)
        step = np.where(new, at, at - np.concatenate(([0], at[:-1])))
        yield (int(bucket[rows[0]]), settled, planes(_steps(ids[own[begin]]), "<u8"), tags[own[begin]].astype("<i4").tobytes(),
               planes(np.diff(np.append(begin, len(rows))), "<u4"), planes(step, "<i8"), planes(other[rows], "<u8"))


def _unpack(ids: bytes, tags: bytes, counts: bytes, first: bytes, other: bytes):
    """ids and tags of the texts; for each entry its text, first word and ``other``."""
    id_ = np.cumsum(unplanes(ids, "<u8"), dtype=np.uint64).view(np.int64)
    n, step = unplanes(counts, "<u4").astype(np.int64), unplanes(first, "<i8")
    total, begin = np.cumsum(step), np.cumsum(n) - n
    at = total - np.repeat(total[begin] - step[begin], n)
    return id_, np.frombuffer(tags, "<i4"), np.repeat(np.arange(len(n), dtype=np.int32), n), at.astype(np.int32), unplanes(other, "<u8")


def _joined(rows: list[tuple]):
    """``_unpack`` of several rows as one."""
    parts = [_unpack(*r) for r in rows]
    shift = np.cumsum([0] + [len(p[0]) for p in parts])
    out = [np.concatenate([p[i] for p in parts]) for i in range(5)]
    out[2] = np.concatenate([p[2] + np.int32(k) for p, k in zip(parts, shift, strict=False)])
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PACKED.split(", ")]
    types = [pa.int64(), pa.bool_()] + [pa.binary()] * 5
    columns = zip(*rows, strict=True) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _runs(text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices where a run of consecutive windows of one text begins, and its length."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (np.diff(first) != 1)))
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(first)))


def _window_rows(docs: DataFrame, width: int, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, smallest = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in ragged.slices(batch.column(2), SLICE):
                starts, ends = ragged.spans(ragged.WORD[buf])
                bounds = np.searchsorted(starts, offsets)
                first, h = ragged.windows(ragged.span_hash(ragged.lanes(buf), starts, ends), bounds, width)
                if not len(h):
                    continue
                text = np.searchsorted(bounds, first, "right") - 1
                doc = ids[lo:hi][text]
                keys, where = np.unique(h, return_inverse=True)
                low = np.full(len(keys), NO_ID, np.int64)
                np.minimum.at(low, where, doc)
                known = np.zeros(len(keys), bool)
                if len(sent):
                    at = np.minimum(np.searchsorted(sent, keys), len(sent) - 1)
                    known = (sent[at] == keys) & (smallest[at] < low)
                repeated = (doc > low[where]) | known[where]
                often = (np.bincount(where) > 1) & ~known
                sent, smallest = np.concatenate([sent, keys[often]]), np.concatenate([smallest, low[often]])
                order = np.lexsort((smallest, sent))
                sent, at = np.unique(sent[order], return_index=True)
                smallest = smallest[order][at]
                if len(sent) > REMEMBERED:
                    sent, smallest = sent[:0], smallest[:0]
                word, own, own_tags = first - bounds[text], ids[lo:hi], tags[lo:hi]
                rows = list(_pack((h[~repeated] % np.uint64(n)).astype(np.int64), False, text[~repeated], own, own_tags,
                                  word[~repeated], h[~repeated]))
                begin, length = _runs(text[repeated], word[repeated])
                whose = text[repeated][begin]
                rows += _pack(_home(own[whose], n), True, whose, own, own_tags, word[repeated][begin], length)
                yield _batch(rows)
    return docs.select("doc_id", _tag().alias("tag"), ragged.terminated("text").alias("text")).mapInArrow(run, PACKED)


def _tag() -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def _home(ids: np.ndarray, n: int) -> np.ndarray:
    """The bucket in which what is known of a document meets."""
    return (ragged.mix(ids.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def repeated_intervals(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """id, tag, starts, ends (arrays): maximal intervals of words to remove, of texts that have any."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    packed = ("ids", "tags", "counts", "first", "other")

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        rows, open_ = [], []
        for settled, *row in zip(*(table.column(c).to_pylist() for c in ("settled", *packed)), strict=True):
            if settled:
                rows.append((key[0].as_py(), True, *row))
            else:
                open_.append(row)
        if open_:
            ids, tags, text, first, h = _joined(open_)
            open_.clear()
            order = np.argsort(h, kind="stable")
            begin = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
            low = np.empty(len(h), np.int64)
            low[order] = np.repeat(np.minimum.reduceat(ids[text[order]], begin), np.diff(np.append(begin, len(h))))
            again = np.flatnonzero(ids[text] > low)
            again = again[np.lexsort((first[again], text[again]))]
            begin, length = _runs(text[again], first[again])
            whose = text[again][begin]
            rows += _pack(_home(ids[whose], n), True, whose, ids, tags, first[again][begin], length)
        return pa.Table.from_batches([_batch(rows)])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        ids, tags, text, first, length = _joined(list(zip(*(table.column(c).to_pylist() for c in packed), strict=True)))
        order = np.lexsort((first, tags[text], ids[text]))
        id_, tag, begin = ids[text][order], tags[text][order], first[order].astype(np.int64)
        end = begin + length[order].astype(np.int64) - 1 + width
        doc = np.concatenate(([0], np.cumsum((id_[1:] != id_[:-1]) | (tag[1:] != tag[:-1]))))
        # ends of earlier intervals of the same document, as one running maximum
        far = int(end.max()) + 1
        reach = np.maximum.accumulate(end + doc * far) - doc * far
        new = np.concatenate(([True], (np.diff(doc) > 0) | (begin[1:] > reach[:-1])))
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(end)) - 1
        of = np.flatnonzero(np.concatenate(([True], np.diff(doc[at]) > 0)))
        bounds = pa.array(np.append(of, len(at)).astype(np.int32))
        return pa.Table.from_arrays(
            [pa.array(id_[at[of]]), pa.array(tag[at[of]]),
             pa.ListArray.from_arrays(bounds, pa.array(begin[at])), pa.ListArray.from_arrays(bounds, pa.array(reach[last]))],
            ["id", "tag", "starts", "ends"])

    x = _window_rows(docs, width, n).groupBy("bucket").applyInArrow(settle, PACKED)
    return x.groupBy("bucket").applyInArrow(merge, "id bigint, tag int, starts array<bigint>, ends array<bigint>")


def _kept(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Words in all, words removed, and the words left joined by one space."""
    a, b = starts.to_pylist(), ends.to_pylist()
    n_words, n_removed, kept = [], [], []
    for lo, hi, buf, offsets in ragged.slices(texts):
        mask = ragged.WORD[buf]
        first, last = ragged.spans(mask)
        bounds = np.searchsorted(first, offsets)
        change = np.zeros(len(first) + 1, np.int64)
        for i in range(lo, hi):
            if a[i]:
                change[np.array(a[i]) + bounds[i - lo]] += 1
                change[np.array(b[i]) + bounds[i - lo]] -= 1
        gone = np.cumsum(change[:-1]) > 0
        data = np.where(mask, buf, 0x20)
        stay = mask.copy()
        stay[last] = True
        edge = np.zeros(len(buf) + 2, np.int8)
        edge[first[gone]] += 1
        edge[last[gone] + 1] -= 1
        stay &= np.cumsum(edge[:len(buf)], dtype=np.int8) == 0
        left, at = data[stay].tobytes(), np.concatenate(([0], np.cumsum(stay)))[offsets].tolist()
        kept += [left[x:max(x, y - 1)].decode() for x, y in zip(at[:-1], at[1:], strict=True)]
        n_words.append(np.diff(bounds))
        n_removed.append(ragged.sums(gone, bounds))
    ints = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (n_words, n_removed)]
    return pa.StructArray.from_arrays([*ints, pa.array(kept, pa.string())], ["n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    found = repeated_intervals(docs, width)
    own = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), _tag().alias("tag"), "text")

    def run(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        return _kept(texts, starts, ends)
    cut = F.arrow_udf(run, "struct<n_words:bigint,n_removed:bigint,kept:string>").asNondeterministic()
    return own.join(found, ["id", "tag"], "left").select(
        "doc_id", cut(ragged.terminated("text"), "starts", "ends").alias("c")).select("doc_id", "c.*")

"""Cost-balanced packing of documents into sequences of fixed capacity.

A document's whole capacities are cut off first; each fills a sequence. The
rests are dealt over groups by hash and packed inside a group: with linear plus
quadratic attention cost, descending documents go to the lowest-cost sequence
that still has room. If no sequence can take one whole, it is cut at the
fullest room and its rest queues again. The sequences of a group hold exactly
its tokens: full capacities, and for what is left over sequences whose lengths
are powers of two, which need no padding either.

Group sizes follow the bytes of the table (a token is a byte at least), so a
group stays small at any scale, and repeated rows are dealt over groups too.

Defined results: null and empty texts are documents of the end token alone;
repeated rows are packed one by one; very long texts are cut into pieces; documents of
equal cost are taken in the order of their group's rows; an empty table gives no
pieces. Only doc_id and text are read, so extra columns of any name are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import ragged
from riskframe.llm.tokens import Codec, vocabulary_path

CAPACITY, END = 2048, 1
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: bytes of text a packing group stands for
GROUP_BYTES = 4 << 20
#: identical rows that share a group
TOGETHER = 64


def cost(n: int) -> float:
    """Linear and attention cost of a piece of n tokens."""
    return LINEAR * n + QUADRATIC * n * n


def rooms(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the sequences that hold ``total`` tokens without padding."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece.

    ``open_``: sequences by cost that can take the current document whole.
    ``tight``: those that can't yet; as documents descend, each comes back once
    a document fits it.
    """
    left = rooms(sum(sizes), capacity)
    used = [0] * len(left)
    spent = [0.0] * len(left)
    open_ = [(0.0, s) for s in range(len(left))]
    tight: list[tuple[int, int]] = []
    queue = [(-n, d, 0) for d, n in enumerate(sizes) if n]
    heapq.heapify(queue)
    pieces = []
    while queue:
        n, d, start = heapq.heappop(queue)
        n = -n
        while tight and -tight[0][0] >= n:
            s = heapq.heappop(tight)[1]
            heapq.heappush(open_, (spent[s], s))
        while open_ and left[open_[0][1]] < n:
            s = heapq.heappop(open_)[1]
            heapq.heappush(tight, (-left[s], s))
        if open_:
            s = heapq.heappop(open_)[1]
        else:
            s = heapq.heappop(tight)[1]
            heapq.heappush(queue, (left[s] - n, d, start + left[s]))
            n = left[s]
        pieces.append((d, start, n, s, used[s]))
        used[s], left[s], spent[s] = used[s] + n, left[s] - n, spent[s] + cost(n)
        if left[s]:
            heapq.heappush(open_, (spent[s], s))
    return pieces


ENCODED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, salt bigint"
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def encoded(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Whole capacities (with their crc32, without ids) and rests (with ids) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = Codec(path), Counter()
        for batch in batches:
            for lo, hi, buf, offsets in ragged.slices(batch.column(1)):
                ids, at = codec.encode(buf, offsets, END)
                ids, view = ids.astype("<u4"), memoryview(ids.astype("<u4").view(np.uint8))
                out = []
                for doc, a, b in zip(batch.column(0)[lo:hi].to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    crc = zlib.crc32(view[4 * a:4 * b])
                    whole = hash((doc, crc))
                    seen[whole] += 1
                    salt = (seen[whole] // TOGETHER << 32) + crc
                    for s in range(a, b, capacity):
                        n = min(capacity, b - s)
                        part = view[4 * s:4 * (s + n)]
                        full = n == capacity
                        out.append((doc, s - a, n, zlib.crc32(part) if full else 0, b - a, None if full else bytes(part), salt))
                if len(seen) > 50_000:
                    seen = Counter({k: v for k, v in seen.items() if v > 1})
                columns = list(zip(*out, strict=True))
                types = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                                 [c.split()[0] for c in ENCODED.split(", ")])
    return docs.select("doc_id", ragged.terminated("text")).mapInArrow(run, ENCODED)


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = path or vocabulary_path()
    n_bytes = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1)).first()[0] or 0
    groups = max(1, -(-n_bytes // GROUP_BYTES))
    x = encoded(docs, path, capacity).withColumn(
        "pack", F.pmod(F.xxhash64("doc_id", "salt", F.col("start").cast("long")), F.lit(groups)))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("salt", "ascending"), ("start", "ascending")])
        cols = {c: table.column(c).to_pylist() for c in table.column_names}
        base, out = key[0].as_py() << 32, []
        rest = [i for i, ids in enumerate(cols["ids"]) if ids is not None]
        for i, ids in enumerate(cols["ids"]):
            if ids is None:
                out.append((cols["doc_id"][i], cols["start"][i], cols["length"][i], cols["ids_crc32"][i],
                            cols["doc_tokens"][i], base + len(out), 0))
        base += len(out)
        for d, start, n, s, offset in pack([cols["length"][i] for i in rest], capacity):
            i = rest[d]
            out.append((cols["doc_id"][i], cols["start"][i] + start, n, zlib.crc32(cols["ids"][i][4 * start:4 * (start + n)]),
                        cols["doc_tokens"][i], base + s, offset))
        ragged.give_back()
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
    return x.groupBy("pack").applyInArrow(run, PIECES)

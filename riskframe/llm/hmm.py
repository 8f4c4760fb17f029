"""Language-model scoring with a hidden Markov model.

Latent states emit symbols: a frequent word is a symbol of its own, the others
share symbols by their last letters, and within such a class a word has its
smoothed share of the class's training counts. So the model is of bounded size
(``STATES`` x at most ``1 / RARE + CLASSES`` symbols), while the counts behind
it cover every word of every training text.

1. ``write_chunks``: whole texts become chunks of word codes with the chunk's
   own vocabulary, written once to the shared folder.
2. ``write_counts``: each chunk sends its vocabulary with its training counts,
   dealt by hash; a bucket adds them up over all chunks and sends every chunk
   the total counts of its words. No vocabulary is ever in one place.
3. ``write_scored``: chunks meet their counts: base score, known tokens, symbols.
4. ``train``: Baum-Welch from states that look like texts far apart, picked by hash over all
   training texts. Every one of ``ROUNDS`` rounds runs the scaled forward-backward
   recursion over all training texts; every task adds up its expected counts,
   which are then summed across partitions.
5. ``score``: the scaled forward recursion gives the exact likelihood of each text.

Defined results: null counts as empty, an empty text is its end token alone;
null ids hash as empty text (they train); repeated rows count as often as they
occur; very long texts are scored whole; of candidate texts that tie the smaller hash is
taken first; without training texts all counts are 0 and the model is uniform; an
empty table gives an empty result. Only doc_id and text are read, so extra
columns of any name are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm import ragged
from riskframe.session import checkpoint_dir

STATES, ROUNDS, STAY = 16, 2, 0.98
#: a word with at least this share of the training tokens has a symbol of its own
RARE = 2.0 ** -15
CLASSES = 1 << 13
#: symbol counts every state is smoothed with
PRIOR = 500.0
SLICE = 6 << 20
#: hash ranges, and texts of each, that the first model is chosen from
RANGES, PICKS = 32, 8
HOLD_OUT, HELD = 7, 2
#: stands for the end token among word hashes
END = np.uint64(0)

CHUNK = ("chunk bigint, ids array<bigint>, train binary, sizes binary, codes binary, words binary, classes binary, "
         "counts binary, train_tokens bigint")
COUNTS = "chunk bigint, bucket bigint, kind string, n bigint, a binary, b binary"
SCORED = ("chunk bigint, ids array<bigint>, train binary, sizes binary, symbols binary, n_known binary, "
          "base binary, within binary")


def _array(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(data, dtype)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def is_training(doc_id: int | None) -> bool:
    """Not held out: crc32 of the id as text, modulo 7, is not 2."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HOLD_OUT != HELD


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of coded texts (see ``CHUNK``), one per slice of the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, buf, offsets in ragged.slices(batch.column(1), SLICE):
                ids = batch.column(0)[lo:hi].to_pylist()
                low = ragged.LOWER[buf]
                starts, ends = ragged.spans(ragged.WORD[low])
                bounds = np.searchsorted(starts, offsets)
                view = ragged.lanes(low)
                h = np.maximum(ragged.span_hash(view, starts, ends), np.uint64(1))
                tail = np.minimum(ends - starts, 3)
                last = view[ends - tail] & np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.uint64)[tail]
                kind = (ragged.mix(last + np.uint64(1)) % np.uint64(CLASSES)).astype(np.uint16)
                tokens, kinds = np.insert(h, bounds[1:], END), np.insert(kind, bounds[1:], 0)
                sizes = np.diff(bounds) + 1
                train = np.array([is_training(i) for i in ids], bool)
                words, first, codes = np.unique(tokens, return_index=True, return_inverse=True)
                counts = np.bincount(codes[np.repeat(train, sizes)], minlength=len(words))
                yield _rows(CHUNK, [(chunk, ids, train.tobytes(), sizes.astype("<u4").tobytes(), codes.astype("<u4").tobytes(),
                                     words.tobytes(), kinds[first].tobytes(), counts.astype("<u4").tobytes(), int(counts.sum()))])
                chunk += 1
    return docs.select(F.col("doc_id").cast("long"), ragged.terminated("text").alias("text")).mapInArrow(run, CHUNK)


def total_counts(coded: DataFrame, train_tokens: int) -> DataFrame:
    """Rows by kind. 'chunk': the total training counts of a chunk's words in one
    bucket, in order; 'own': words with symbols of their own, and their counts;
    'class': tokens and distinct words of each class of other words; n of the
    last is the bucket's number of distinct training words."""
    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(1.0, RARE * train_tokens)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, classes, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words, classes, counts = _array(words, "<u8"), _array(classes, "<u2"), _array(counts, "<u4")
                bucket = words % np.uint64(n)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[order])) + 1
                yield _rows(COUNTS, [(chunk, int(bucket[r[0]]), "", len(r), words[r].tobytes(),
                                      counts[r].tobytes() + classes[r].tobytes()) for r in np.split(order, cut) if len(r)])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        chunk, size, words, rest = (table.column(c).to_pylist() for c in ("chunk", "n", "a", "b"))
        all_words = np.concatenate([_array(w, "<u8") for w in words])
        counts = np.concatenate([_array(r[:4 * k], "<u4") for r, k in zip(rest, size, strict=True)])
        classes = np.concatenate([_array(r[4 * k:], "<u2") for r, k in zip(rest, size, strict=True)])
        keys, first, where = np.unique(all_words, return_index=True, return_inverse=True)
        total = np.bincount(where, counts, len(keys)).astype(np.int64)
        own = total >= least
        kind = classes[first]
        others = (total > 0) & ~own
        answer, bucket, at = total[where].astype("<u8"), key[0].as_py(), np.cumsum([0, *size])
        rows = [(c, bucket, "chunk", k, answer[x:x + k].tobytes(), b"") for c, k, x in zip(chunk, size, at, strict=False)]
        rows.append((-1, bucket, "own", int(own.sum()), keys[own].tobytes(), total[own].astype("<u8").tobytes()))
        rows.append((-1, bucket, "class", int((total > 0).sum()), np.bincount(kind[others], total[others], CLASSES).astype("<u8").tobytes(),
                     np.bincount(kind[others], minlength=CLASSES).astype("<u8").tobytes()))
        return pa.Table.from_batches([_rows(COUNTS, rows)])

    return (coded.select("chunk", "words", "classes", "counts").mapInArrow(send, COUNTS)
            .groupBy("bucket").applyInArrow(add, COUNTS))


@dataclass
class Symbols:
    """Words with symbols of their own (sorted hashes, counts) and the totals of the classes."""
    own: np.ndarray
    own_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    n_words: int
    n_tokens: int

    def prior(self) -> np.ndarray:
        """Smoothed share of each symbol, own words first."""
        c = np.concatenate([self.own_counts, self.class_tokens]) + 1.0
        return c / c.sum()


def symbols_of(counts: DataFrame, train_tokens: int) -> Symbols:
    """The bounded symbol table: at most 1 / RARE words and CLASSES classes come to the driver."""
    own = counts.where("kind = 'own'").select("a", "b").toArrow()
    words = np.concatenate([np.zeros(0, "<u8"), *(_array(x, "<u8") for x in own.column("a").to_pylist())])
    each = np.concatenate([np.zeros(0, "<u8"), *(_array(x, "<u8") for x in own.column("b").to_pylist())])
    order = np.argsort(words)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, 2))
        for batch in batches:
            for a, b in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                total += np.column_stack([_array(a, "<u8"), _array(b, "<u8")])
        yield _parts(total, "<f8")
    classes = counts.where("kind = 'class'")
    total = _total(classes.select("a", "b").mapInArrow(add, PARTS), (CLASSES, 2), "<f8")
    return Symbols(words[order], each[order].astype(np.int64), total[:, 0].astype(np.int64), total[:, 1].astype(np.int64),
                   classes.agg(F.sum("n")).first()[0] or 0, train_tokens)


PARTS, BLOCKS, FAN_IN = "block bigint, salt bigint, sums binary", 64, 64


def _parts(table: np.ndarray, dtype: str) -> pa.RecordBatch:
    """A task's sums as blocks of rows."""
    salt = TaskContext.get().partitionId() % FAN_IN
    return _rows(PARTS, [(i, salt, rows.astype(dtype).tobytes()) for i, rows in enumerate(np.array_split(table, BLOCKS))])


def _total(parts: DataFrame, shape: tuple[int, int], dtype: str) -> np.ndarray:
    """Sums of all tasks' tables, block by block: first over the tasks of one salt,
    then over the salts, so no group holds more than a share of the tasks. The
    total, of bounded size, comes to the driver."""
    def adding(kind: str):
        def add(key: tuple, table: pa.Table) -> pa.Table:
            sums = sum(_array(x, kind).astype("<f8") for x in table.column("sums").to_pylist())
            return pa.Table.from_batches([_rows(PARTS, [(key[0].as_py(), 0, sums.tobytes())])])
        return add
    x = parts.groupBy("block", "salt").applyInArrow(adding(dtype), PARTS).groupBy("block").applyInArrow(adding("<f8"), PARTS)
    out, places = np.zeros(shape), np.array_split(np.arange(shape[0]), BLOCKS)
    for row in x.collect():
        out[places[row["block"]]] = _array(row["sums"], "<f8").reshape(-1, shape[1])
    return out


def scored_chunks(coded: DataFrame, counts: DataFrame, table: Symbols) -> DataFrame:
    """Chunks with base scores and symbols (see ``SCORED``)."""
    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(key: tuple, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in chunk.to_pylist():
            words, codes = _array(row["words"], "<u8"), _array(row["codes"], "<u4")
            order = np.argsort(words % np.uint64(n), kind="stable")
            parts = sorted(zip(answers.column("bucket").to_pylist(), answers.column("a").to_pylist(), strict=True))
            count = np.empty(len(words), np.int64)
            count[order] = np.concatenate([_array(a, "<u8") for _, a in parts])
            symbol = np.minimum(np.searchsorted(table.own, words), max(len(table.own) - 1, 0))
            is_own = table.own[symbol] == words if len(table.own) else np.zeros(len(words), bool)
            kind = _array(row["classes"], "<u2").astype(np.int64)
            symbol = np.where(is_own, symbol, len(table.own) + kind)
            base = np.log10((count + 1) / (table.n_tokens + table.n_words + 1))
            within = np.where(is_own, 0.0, np.log10((count + 1) / (table.class_tokens[kind] + table.class_words[kind] + 1)))
            at = np.concatenate(([0], np.cumsum(_array(row["sizes"], "<u4").astype(np.int64))))
            total = [np.add.reduceat(v[codes], at[:-1]) for v in ((count > 0).astype(np.int64), base, within)]
            out.append((row["chunk"], row["ids"], row["train"], row["sizes"], symbol[codes].astype("<u4").tobytes(),
                        total[0].astype("<u4").tobytes(), total[1].tobytes(), total[2].tobytes()))
        return pa.Table.from_batches([_rows(SCORED, out)])

    right = counts.where("kind = 'chunk'").select("chunk", "bucket", "a")
    left = coded.select("chunk", "ids", "train", "sizes", "codes", "words", "classes")
    return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(run, SCORED)


@dataclass
class Model:
    """start[k], move[k, l], emit[symbol, k]: probabilities of an HMM."""
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def forward(model: Model, symbols: np.ndarray, sizes: np.ndarray, backward: bool = False):
    """Scaled forward recursion over many sequences at once.

    Sequences are ordered by falling length, so those still running at a step
    are the first ones. Returns the natural-log likelihood of each sequence;
    with ``backward`` also the expected counts (start, move, per-token states).
    """
    order = np.argsort(-sizes, kind="stable")
    size, begin = sizes[order], (np.cumsum(sizes) - sizes)[order]
    running = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right") if len(size) else np.zeros(0, np.int64)
    alpha = model.start[None, :].repeat(len(size), axis=0)
    log, kept, scales = np.zeros(len(size)), [], []
    for t, m in enumerate(running.tolist()):
        if t:
            alpha = alpha[:m] @ model.move
        alpha = alpha * model.emit[symbols[begin[:m] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        log[:m] += np.log(scale)
        if backward:
            kept.append(alpha.astype(np.float32))
            scales.append(scale)
    out = np.empty(len(sizes))
    out[order] = log
    if not backward:
        return out
    # single precision: these tables, tokens x states, are the largest a task holds
    states = np.empty((len(symbols), len(model.start)), np.float32)
    move = np.zeros_like(model.move)
    beta = np.zeros((0, len(model.start)))
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        if t + 1 < len(running):
            ahead = model.emit[symbols[begin[:len(beta)] + t + 1]] * beta / scales[t + 1][:, None]
            move += kept[t][:len(beta)].T @ ahead
            beta = np.concatenate([ahead @ model.move.T, np.ones((m - len(beta), len(model.start)))])
        else:
            beta = np.ones((m, len(model.start)))
        states[begin[:m] + t] = kept[t] * beta
    return out, states[begin].sum(axis=0), move * model.move, states


def _training(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and sizes of a chunk's training texts."""
    train, sizes = _array(row["train"], "?"), _array(row["sizes"], "<u4").astype(np.int64)
    symbols = _array(row["symbols"], "<u4").astype(np.int64)
    return symbols[np.repeat(train, sizes)], sizes[train]


def _symbol_sums(symbols: np.ndarray, states: np.ndarray, n: int) -> np.ndarray:
    return np.column_stack([np.bincount(symbols, states[:, k], n) for k in range(states.shape[1])])


def expected_counts(scored: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts (start, move, emit) of one Baum-Welch round over all training texts.

    Every task adds up its own; these tables are summed across partitions.
    """
    n, k = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one table: symbols, then the first states, then the moves from each state
        total = np.zeros((n + 1 + k, k))
        for batch in batches:
            for row in batch.to_pylist():
                symbols, sizes = _training(row)
                if not len(sizes):
                    continue
                _, first, moved, states = forward(model, symbols, sizes, backward=True)
                total[n + 1:] += moved
                total[n] += first
                total[:n] += _symbol_sums(symbols, states, n)
        yield _parts(total, "<f4")

    total = _total(scored.select("train", "sizes", "symbols").mapInArrow(run, PARTS), (n + 1 + k, k), "<f4")
    return total[n], total[n + 1:], total[:n]


def candidates(scored: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Symbols and how often of at most ``RANGES * PICKS`` distinct training texts of the whole table, whatever
    its order and partitions: the smallest ``PICKS`` hashes of each hash range. Fewer texts than ``PICKS`` are all there."""
    def bags(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        symbols, sizes = _training(row)
        at = np.cumsum(sizes) - sizes
        # order does not count: texts of the same symbols give the same state
        h = ragged.mix(np.add.reduceat(ragged.mix(symbols.astype(np.uint64) + np.uint64(1)), at)) if len(at) else np.zeros(0, np.uint64)
        return symbols, sizes, at, h.view(np.int64)

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, 2), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                h = bags(row)[3]
                both = np.concatenate([best, np.column_stack([h, np.full(len(h), row["chunk"])])])
                best = both[np.unique(both[:, 0], return_index=True)[1]]
                part = best[:, 0] >> np.int64(64 - RANGES.bit_length() + 1)
                begin = np.searchsorted(part, part)
                best = best[np.arange(len(best)) - begin < PICKS]
        yield _rows("part bigint, hash bigint, chunk bigint",
                    [(h >> (64 - RANGES.bit_length() + 1), h, c) for h, c in best.tolist()])

    found = scored.select("chunk", "train", "sizes", "symbols").mapInArrow(smallest, "part bigint, hash bigint, chunk bigint")
    place = Window.partitionBy("part").orderBy("hash")
    kept = (found.groupBy("part", "hash").agg(F.min("chunk").alias("chunk"))
            .withColumn("place", F.row_number().over(place)).where(F.col("place") <= PICKS).collect())
    wanted = np.array(sorted(r["hash"] for r in kept), np.int64)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                symbols, sizes, at, h = bags(row)
                out = []
                for i in np.flatnonzero(np.isin(h, wanted)).tolist():
                    bag, n = np.unique(symbols[at[i]:at[i] + sizes[i]], return_counts=True)
                    out.append((int(h[i]), bag.astype("<u4").tobytes(), n.astype("<u4").tobytes()))
                yield _rows("hash bigint, a binary, b binary", list({r[0]: r for r in out}.values()))

    if not kept:
        return []
    rows = (scored.where(F.col("chunk").isin(sorted({r["chunk"] for r in kept}))).select("train", "sizes", "symbols")
            .mapInArrow(texts, "hash bigint, a binary, b binary").groupBy("hash").agg(F.first("a").alias("a"), F.first("b").alias("b")).collect())
    return [(_array(r["a"], "<u4").astype(np.int64), _array(r["b"], "<u4").astype(np.int64)) for r in sorted(rows, key=lambda r: r["hash"])]


def seeds(scored: DataFrame, prior: np.ndarray, k: int) -> Model:
    """First model: training texts that are far from one another; states beyond the
    number of distinct texts weigh the symbols by hash, so no two states are equal."""
    emit = np.repeat(prior[:, None], k, axis=1)
    bags = candidates(scored)
    if bags:
        sizes, ends = np.array([n.sum() for _, n in bags]), [len(x) for x, _ in bags]
        symbols, counts, text = np.concatenate([x for x, _ in bags]), np.concatenate([n for _, n in bags]), np.repeat(np.arange(len(bags)), ends)
        # short texts come after all others
        near, short, left = np.zeros(len(bags)), sizes < min(50, int(np.median(sizes))), np.ones(len(bags), bool)
        for s in range(min(k, len(bags))):
            pool = np.flatnonzero(left & ~short) if (left & ~short).any() else np.flatnonzero(left)
            pick = int(pool[np.argmin(near[pool])])
            left[pick] = False
            share = np.bincount(symbols[text == pick], counts[text == pick], len(prior)) / sizes[pick]
            emit[:, s] = 0.5 * prior + 0.5 * share
            # how much of a document's mass the picked one explains, on the scale of both
            gain = np.log(emit[:, s] / prior)
            near = np.maximum(near, np.bincount(text, counts * np.maximum(gain[symbols], 0), len(sizes)) / sizes)
        for s in range(len(bags), k):
            emit[:, s] *= 0.75 + 0.5 * (ragged.mix(np.arange(len(prior), dtype=np.uint64) * np.uint64(k) + np.uint64(s)) % np.uint64(2))
    return Model(np.full(k, 1 / k), _sticky(k), emit / emit.sum(axis=0))


def _sticky(k: int) -> np.ndarray:
    return np.full((k, k), (1 - STAY) / max(k - 1, 1)) * (1 - np.eye(k)) + np.eye(k) * (STAY if k > 1 else 1.0)


def train(scored: DataFrame, table: Symbols, k: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training texts."""
    prior = table.prior()
    model = seeds(scored, prior, k)
    for _ in range(rounds):
        start, move, emit = expected_counts(scored, model)
        # a state that no text fell to keeps its emissions, or all such states would become equal
        emit = np.where(emit.sum(axis=0) < 1, model.emit, emit + PRIOR * prior[:, None])
        start, move = start + 1, move + 50 * _sticky(k)
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def score(scored: DataFrame, model: Model, table: Symbols) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = _array(row["sizes"], "<u4").astype(np.int64)
                log = forward(model, _array(row["symbols"], "<u4").astype(np.int64), sizes) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(~_array(row["train"], "?")), pa.array(sizes),
                     pa.array(_array(row["n_known"], "<u4").astype(np.int64)), pa.array(np.full(len(sizes), table.n_tokens)),
                     pa.array(_array(row["base"], "<f8")), pa.array(log + _array(row["within"], "<f8"))],
                    [c.split()[0] for c in schema.split(", ")])
    return scored.mapInArrow(run, schema)


def scored_texts(docs: DataFrame, k: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Train on the training texts of ``docs`` and score them all."""
    spark, folder = docs.sparkSession, f"{checkpoint_dir(docs.sparkSession)}/hmm-{uuid4().hex}"
    coded = _written(spark, chunks(docs), f"{folder}/chunks")
    train_tokens = coded.agg(F.sum("train_tokens")).first()[0] or 0
    counts = _written(spark, total_counts(coded, train_tokens), f"{folder}/counts")
    table = symbols_of(counts, train_tokens)
    scored = _written(spark, scored_chunks(coded, counts, table), f"{folder}/scored")
    return score(scored, train(scored, table, k, rounds), table)


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Quality rules: gradient-boosted trees over document statistics.

1. ``document_statistics``: counts of words, symbols, repeated lines and repeated
   five-word windows of every whole text, from array kernels in Arrow tasks.
2. ``fit``: boosted trees with monotonic constraints, fitted on a bounded
   sample of labelled rows (``max_rows``, documented parameter).
3. ``Forest``: the trees flattened into numpy node arrays; scoring walks all
   rows down all trees level by level.
4. ``verdicts`` / ``keep_good``: fixed base rules first, then the trees.

Defined results: a null or empty text has 0 words and fails the base rules;
repeated rows are judged alike, each row once; an empty table gives an empty
result; without labelled rows (or with one class only) the trees accept
everything; further columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import ragged
from riskframe.session import cut_lineage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_digits", "n_exclaim", "n_pipes", "n_stops", "n_lines")
STRUCT = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
REPEAT_WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

#: features and the direction in which each may move the probability of a good document
FEATURES = {"log_words": 0, "mean_word": 0, "symbols": -1, "upper": -1, "digits": -1, "exclaim": -1,
            "pipes": -1, "stops": 0, "dup_lines": -1, "repeats": -1, "words_per_line": 0}
#: upper bound of labelled rows the trees are fitted on
MAX_TRAIN_ROWS = 20_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = ragged._table((0x41, 0x5A))
_DIGIT = ragged._table((0x30, 0x39))


def _per_text(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    return ragged.mix(key + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def slice_counts(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts of ``COUNTS`` for each text of one slice."""
    n = len(offsets) - 1
    mask = ragged.WORD[buf]
    starts, ends = ragged.spans(mask)
    bounds = np.searchsorted(starts, offsets)
    view = ragged.lanes(buf)
    counts = {
        "n_words": np.diff(bounds),
        "word_chars": ragged.sums(ends - starts, bounds) - ragged.counts((buf & 0xC0) == 0x80, offsets),
        "n_symbols": ragged.counts(_SYMBOL[buf], offsets),
        "n_upper": ragged.counts(_UPPER[buf], offsets),
        "n_digits": ragged.counts(_DIGIT[buf], offsets),
        "n_exclaim": ragged.counts(buf == 0x21, offsets),
        "n_pipes": ragged.counts(buf == 0x7C, offsets),
        "n_stops": ragged.counts((buf == 0x2E) | (buf == 0x2C), offsets),
        "n_lines": ragged.counts(buf == 0x0A, offsets),
    }
    ends_of_lines = np.flatnonzero(buf == 0x0A)
    line_start = np.concatenate(([0], ends_of_lines[:-1] + 1))
    worded = np.searchsorted(starts, ends_of_lines) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[worded], ends_of_lines[worded]
    line_text = np.searchsorted(offsets, line_start, "right") - 1
    key = _per_text(ragged.span_hash(view, line_start, line_end, seed=1), line_text)
    _, first = np.unique(key, return_index=True)
    counts["n_dup_lines"] = np.bincount(line_text, minlength=n) - np.bincount(line_text[first], minlength=n)

    h = ragged.span_hash(view, starts, ends)
    at, key = ragged.windows(h, bounds, REPEAT_WINDOW)
    word_text = np.repeat(np.arange(n), np.diff(bounds))
    key = _per_text(key, word_text[at])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(starts) + 1, np.int32)
    change[at[twice]] += 1
    np.subtract.at(change, at[twice] + REPEAT_WINDOW, 1)
    counts["n_repeat_words"] = ragged.sums(np.cumsum(change[:-1]) > 0, bounds)
    return [counts[c] for c in COUNTS]


def _statistics(texts: pa.Array) -> pa.Array:
    parts = [slice_counts(buf, offsets) for _, _, buf, offsets in ragged.slices(texts)]
    columns = [np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
               for i in range(len(COUNTS))]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(COUNTS))


def statistics(text: Column | str) -> Column:
    """The counts of a text column as one struct."""
    def run(texts: pa.Array) -> pa.Array:
        return _statistics(texts)
    return F.arrow_udf(run, STRUCT).asNondeterministic()(ragged.terminated(text))


def base_failed(s: Column) -> Column:
    """The fixed rules: too few words, or too many in repeated windows."""
    return (s["n_words"] < MIN_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PERCENT)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rows x features from the counts."""
    c = {k: np.asarray(v, np.float64) for k, v in counts.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_upper"] / chars,
        c["n_digits"] / chars, c["n_exclaim"] / words, c["n_pipes"] / words, c["n_stops"] / words,
        c["n_dup_lines"] / lines, c["n_repeat_words"] / words, words / lines])


@dataclass
class Forest:
    """Trees of equal depth as node arrays: node i of a tree has children
    2i + 1 and 2i + 2; an unsplit node sends every row left."""
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of a good document for each row."""
        inner = self.feature.shape[1]
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner] if len(x) else 0
        return out


ACCEPT_ALL = Forest(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 10.0)


def fit_forest(x: np.ndarray, y: np.ndarray, directions: Sequence[int], trees: int = 60, depth: int = 3,
               rate: float = 0.2, bins: int = 64, l2: float = 1.0, min_rows: int = 5) -> Forest:
    """Boosted trees for 0/1 labels (logistic loss, histogram splits).

    A feature of direction d only splits where d * (right - left) >= 0, and the
    middle of such a split bounds the leaves on both sides, so the score is
    monotone in it. Splits are deterministic: the first best one counts.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    code = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    rate_good = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(rate_good / (1 - rate_good)))
    margin = np.full(n, base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    all_f, all_t, all_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        for i in range(inner):
            rows = np.flatnonzero(node == i)
            low[2 * i + 1:2 * i + 3], high[2 * i + 1:2 * i + 3] = low[i], high[i]
            best = (1e-9, None)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for j in range(width):
                k = len(edges[j])
                if not len(rows) or not k:
                    continue
                left = [np.cumsum(np.bincount(code[rows, j], w, k + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows)))]
                right = [total_g - left[0], total_h - left[1], len(rows) - left[2]]
                wl, wr = (np.clip(a[0] / (a[1] + l2), low[i], high[i]) for a in (left, right))
                gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - total_g ** 2 / (total_h + l2)
                gain[(left[2] < min_rows) | (right[2] < min_rows) | (directions[j] * (wr - wl) < 0)] = 0
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], (j, at, (wl[at] + wr[at]) / 2))
            if best[1]:
                j, at, middle = best[1]
                feature[i], threshold[i] = j, edges[j][at]
                if directions[j] > 0:
                    high[2 * i + 1], low[2 * i + 2] = middle, middle
                elif directions[j] < 0:
                    low[2 * i + 1], high[2 * i + 2] = middle, middle
            node[rows] = 2 * i + 1 + (x[rows, feature[i]] > threshold[i])
        leaf = node - inner
        value = np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        value = rate * np.clip(value, low[inner:], high[inner:])
        margin += value[leaf]
        all_f.append(feature), all_t.append(threshold), all_v.append(value)
    return Forest(np.array(all_f), np.array(all_t), np.array(all_v), base)


def labelled_sample(labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``doc_id, quality``: the share of labelled ids, by hash, that gives about ``max_rows`` rows.
    Of several labels of one id the smallest counts; null ids and labels are left out."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 50)) < (max_rows << 50) // n)
    return known


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """Fit the trees on a bounded sample of labelled documents.

    ``stats``: doc_id and the counts; ``labels``: doc_id and quality (1: good). Only the
    counts of the sample (``labelled_sample``, eleven numbers a row) come to the driver;
    of several documents with one id the smallest counts are used.
    """
    one = stats.groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("s")).select("doc_id", "s.*")
    rows = one.join(labelled_sample(labels, max_rows), "doc_id").orderBy("doc_id").toPandas()
    if rows["quality"].nunique() < 2:
        return ACCEPT_ALL
    x = features({c: rows[c].to_numpy() for c in COUNTS})
    return fit_forest(x, (rows["quality"].to_numpy() > 0).astype(float), list(FEATURES.values()))


def fit_on(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """``fit`` from documents: only the sampled ones are counted."""
    known = cut_lineage(labelled_sample(labels, max_rows))
    # at most about max_rows ids, whatever the tables hold
    some = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    return fit(document_statistics(some), known, max_rows)


def accepted(forest: Forest, s: Column) -> Column:
    """The trees' verdict (probability of a good document at least one half) on a counts struct."""
    def run(counts: pa.Array) -> pa.Array:
        x = features({c: counts.field(i).to_numpy(zero_copy_only=False) for i, c in enumerate(COUNTS)})
        return pa.array(forest.margin(x) >= 0)
    return F.arrow_udf(run, "boolean")(s)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every document's whole text."""
    return docs.select("doc_id", statistics("text").alias("s")).select("doc_id", "s.*")


def verdicts(stats: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` from rows of doc_id and counts."""
    s = F.struct(*COUNTS)
    out = stats.select("*", base_failed(s).alias("base_failed"), accepted(forest, s).alias("_accepted"))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("_accepted")).drop("_accepted")


def keep_good(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the trees, all columns as
    they were. Counting and scoring share one pass through Python."""
    def run(texts: pa.Array) -> pa.Array:
        parts = [dict(zip(COUNTS, slice_counts(buf, offsets), strict=True)) for _, _, buf, offsets in ragged.slices(texts)]
        kept = [(c["n_words"] >= MIN_WORDS) & (c["n_repeat_words"] * 100 <= c["n_words"] * MAX_REPEAT_PERCENT)
                & (forest.margin(features(c)) >= 0) for c in parts]
        return pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))
    good = F.arrow_udf(run, "boolean")
    return docs.select(F.struct("*").alias("row")).where(good(ragged.terminated(F.col("row.text")))).select("row.*")

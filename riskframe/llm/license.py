"""License scans: exact set-similarity join of text blocks with license templates.

Every template has a span: the power of two from twice its number of words up, ``SPAN`` at
least. Its blocks are the lines of the text, and the whole text regardless of line
feeds, both cut into overlapping blocks of that many words, half a span apart. So a
passage as long as the template lies whole in one block wherever it stands, also
if it is wrapped over lines. A block matches a template of its span if it holds at
least ``THRESHOLD`` of the template's distinct words. Short templates keep short blocks,
which scattered words don't fill.

1. ``scan`` reads every whole text once: number of words, the places of the
   base phrases, and the blocks that pass the length filter, as sets of the
   templates' words (no other word can add to an overlap).
2. ``word_order`` counts in how many of those blocks each template word occurs, over
   the whole table, and orders the words from rare to frequent.
3. ``matches`` joins blocks and templates on the words of the templates'
   prefixes: a template of n words that needs an overlap of k shares one of its
   n - k + 1 rarest words with every block that matches. The positions of that
   word in both ordered sets bound the overlap; pairs that can still reach k
   are verified by intersection.

Templates are an argument, (label, words) pairs of any length, bounded by ``MAX_TEMPLATE_WORDS``
in all; their prefixes are the only side that is broadcast.

Defined results: null and empty texts have no words and no labels; repeated
rows are judged one by one, texts of any length whole; an empty table gives an empty
result; without templates only the base labels are found; extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import ragged
from riskframe.session import cut_lineage

#: phrases and the labels they give (fixed values)
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: short notices and their labels
TEMPLATES = [
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("apache-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted"),
    # whole notices (public texts)
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction including without limitation the "
                 "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                 "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
                 "and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-text", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
                    "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
                    "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                    "without warranties or conditions of any kind either express or implied see the license for the specific "
                    "language governing permissions and limitations under the license"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                 "license as published by the free software foundation either version 3 of the license or at your option any later "
                 "version this program is distributed in the hope that it will be useful but without any warranty without even the "
                 "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for "
                 "more details you should have received a copy of the gnu general public license along with this program"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                 "following conditions are met redistributions of source code must retain the above copyright notice this list of "
                 "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
                 "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
                 "distribution neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                 "granted provided that the above copyright notice and this permission notice appear in all copies"),
]
THRESHOLD = 0.85
SPAN = 64
#: bound of what is broadcast: words of all templates together
MAX_TEMPLATE_WORDS = 1 << 20

Templates = Sequence[tuple[str, str]]
STRUCT = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base:array<string>,"
          "blocks:array<struct<span:int,words:array<int>>>>")


def needed(n: int) -> int:
    """Overlap a template of n words needs."""
    return math.ceil(THRESHOLD * n - 1e-9)


def span(n_words: int) -> int:
    """Words of the blocks that a template of so many words is looked for in."""
    out = SPAN
    while out < 2 * n_words:
        out *= 2
    return out


def template_sets(templates: Templates = TEMPLATES) -> tuple[list[str], list[list[int]], list[int]]:
    """The templates' words, each template as numbers of its distinct words, and its span."""
    if sum(len(t.split()) for _, t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many templates for one scan: split them")
    words = sorted({w for _, t in templates for w in t.split()})
    number = {w: i for i, w in enumerate(words)}
    return words, [sorted({number[w] for w in t.split()}) for _, t in templates], [span(len(t.split())) for _, t in templates]


def _hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return ragged.span_hash(ragged.lanes(data), np.concatenate(([0], ends[:-1])), ends)


class Scanner:
    def __init__(self, templates: Templates = TEMPLATES) -> None:
        words, sets, spans = template_sets(templates)
        h = _hashes(words)
        order = np.argsort(h)
        self.words, self.number = h[order], order
        #: per span: which words its templates have, the least overlap one of them needs
        self.spans = []
        for size in sorted(set(spans)):
            own = [s for s, x in zip(sets, spans, strict=True) if x == size]
            has = np.zeros(len(words), bool)
            has[[w for s in own for w in s]] = True
            self.spans.append((size, has, min(needed(len(s)) for s in own)))
        self.phrases = [(_hashes(p.split()), p, label) for p, label in PHRASES.items()]

    def add_blocks(self, out: list[dict], text: np.ndarray, unit: np.ndarray, place: np.ndarray, number: np.ndarray) -> None:
        """Adds the blocks that can match to their texts; ``place``: of a template word in its unit, a line or a text."""
        for size, has, least in self.spans:
            own = has[number]
            part = place[own] // (size // 2)
            # every word is in the block that begins in its half span, and in the one before
            key = np.column_stack([text[own], unit[own], part, number[own]])
            key = np.unique(np.concatenate([key, (key - [0, 0, 1, 0])[part > 0]]), axis=0)
            begin = np.flatnonzero(np.concatenate(([True], (np.diff(key[:, :3], axis=0) != 0).any(axis=1)))[:len(key)])
            n = np.diff(np.append(begin, len(key)))
            for a, k in zip(begin[n >= least].tolist(), n[n >= least].tolist(), strict=True):
                block, blocks = {"span": size, "words": key[a:a + k, 3].tolist()}, out[key[a, 0]]["blocks"]
                if block not in blocks[-2:]:
                    blocks.append(block)

    def slice(self, buf: np.ndarray, offsets: np.ndarray) -> list[dict]:
        low = ragged.LOWER[buf]
        starts, ends = ragged.spans(ragged.ALNUM[low])
        bounds = np.searchsorted(starts, offsets)
        h = ragged.span_hash(ragged.lanes(low), starts, ends)
        out = [{"n_words": n, "n_base": 0, "first_word": None, "last_word": None, "base": [], "blocks": []}
               for n in np.diff(bounds).tolist()]

        data, text_end = memoryview(np.ascontiguousarray(low)), np.repeat(bounds[1:], np.diff(bounds))
        for hashes, phrase, label in self.phrases:
            k = len(hashes)
            at = np.flatnonzero(h[:max(len(h) - k + 1, 0)] == hashes[0])
            for j in range(1, k):
                at = at[h[at + j] == hashes[j]]
            for i in at[at + k <= text_end[at]].tolist():
                if [bytes(data[starts[i + j]:ends[i + j]]).decode() for j in range(k)] == phrase.split():
                    row = int(np.searchsorted(bounds, i, "right")) - 1
                    word, x = int(i - bounds[row]), out[row]
                    x["n_base"] += 1
                    x["first_word"] = word if x["first_word"] is None else min(word, x["first_word"])
                    x["last_word"] = word if x["last_word"] is None else max(word, x["last_word"])
                    x["base"].append(label)

        if not len(self.words):
            return out
        at = np.searchsorted(self.words, h)
        hit = np.flatnonzero(self.words[np.minimum(at, len(self.words) - 1)] == h)
        if len(hit):
            number = self.number[at[hit]]
            line_ends = np.flatnonzero(buf == 0x0A)
            line = np.searchsorted(line_ends, starts[hit])
            line_first = np.searchsorted(starts, np.concatenate(([0], line_ends[:-1] + 1)))[line]
            text = np.searchsorted(bounds, hit, "right") - 1
            self.add_blocks(out, text, line, hit - line_first, number)
            # a text of one line has the blocks of that line
            many = np.flatnonzero(np.diff(np.searchsorted(line_ends, offsets))[text] > 1)
            self.add_blocks(out, text[many], text[many], (hit - bounds[text])[many], number[many])
        return out


def scan(text: Column | str, templates: Templates = TEMPLATES) -> Column:
    """Words, base phrases and candidate blocks of each whole text (see ``STRUCT``)."""
    state: list[Scanner] = []
    kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                      ("base", pa.list_(pa.string())), ("blocks", pa.list_(pa.struct([("span", pa.int32()), ("words", pa.list_(pa.int32()))])))])

    def run(texts: pa.Array) -> pa.Array:
        if not state:
            state.append(Scanner(templates))
        return pa.array([x for _, _, buf, offsets in ragged.slices(texts) for x in state[0].slice(buf, offsets)], kind)
    return F.arrow_udf(run, STRUCT).asNondeterministic()(ragged.terminated(text))


def word_order(blocks: DataFrame, n_words: int) -> list[int]:
    """The templates' words from rare to frequent, by blocks of the whole table that hold them."""
    n = {r["word"]: r["n"] for r in blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(range(n_words), key=lambda w: (n.get(w, 0), w))


def matches(blocks: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """(row, label, score): blocks (row, block, span, words) that reach the threshold of a template of their span."""
    words, sets, spans = template_sets(templates)
    rank = {w: i for i, w in enumerate(word_order(blocks, len(words)))}
    prefix = []
    for t, own in enumerate(sets):
        ranks, k = sorted(rank[w] for w in own), needed(len(own))
        prefix += [(r, i, k, ranks, templates[t][0], t, spans[t]) for i, r in enumerate(ranks[:len(ranks) - k + 1])]
    schema = "word int, place int, need int, template array<int>, label string, t int, span int"
    table = F.broadcast(blocks.sparkSession.createDataFrame(prefix, schema))
    ranks = F.array(*[F.lit(rank[w]) for w in range(len(rank))]).cast("array<int>")
    x = blocks.select("row", "block", "span", F.array_sort(F.transform("words", lambda w: F.get(ranks, w))).alias("words"))
    x = x.select("row", "block", "span", "words", F.posexplode("words").alias("at", "word")).join(table, ["word", "span"])
    x = x.where((F.size("words") >= F.col("need"))
                & (F.least(F.size("template") - F.col("place"), F.size("words") - F.col("at")) >= F.col("need")))
    overlap = F.size(F.array_intersect("words", "template"))
    return x.withColumn("overlap", overlap).where("overlap >= need").select(
        "row", "label", (F.col("overlap") / F.size("template")).alias("score")).distinct()


def scanned(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = cut_lineage(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), scan("text", templates).alias("s"))
                       .select("doc_id", "row", "s.*"))
    blocks = rows.where(F.size("blocks") > 0).select("row", F.posexplode("blocks").alias("block", "b")).select("row", "block", "b.*")
    found = matches(blocks, templates).groupBy("row").agg(F.collect_set("label").alias("own"), F.max("score").alias("score"))
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", names(F.col("base")).alias("base_labels"),
        names(F.concat("base", F.coalesce("own", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

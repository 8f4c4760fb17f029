"""Each operator against a plain Python version, on the small table and on awkward rows."""

import collections
import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from riskframe.llm import exact, hmm, license, mixing, orcids, packing, quality, ragged, simhash, substring, tokens  # noqa: E402


def multiset(rows):
    return collections.Counter(repr(tuple(r)) for r in rows)


# mixing

def _mixed(df):
    return mixing.schedule(df.select("doc_id", "source", mixing.n_words().alias("size")))


def test_mix_targets_and_words_taken(frames):
    for df, _ in frames:
        rows = df.select("doc_id", "source", "text").collect()
        total = collections.Counter()
        for r in rows:
            total[r.source] += len(brute.words(r.text))
        want = brute.targets(dict(total))
        got = _mixed(df).collect()
        assert collections.Counter((r.doc_id, r.source, r.size) for r in got) == collections.Counter(
            (r.doc_id, r.source, len(brute.words(r.text))) for r in rows)
        taken = collections.Counter()
        for r in got:
            assert r.target == pytest.approx(want[r.source]) and r.source_size == total[r.source]
            assert 0 <= r.taken <= 2 * r.size
            taken[r.source] += r.taken
        assert all(abs(taken[s] - want[s]) < 1 + 1e-6 for s in want)


def test_mix_reruns_agree_and_rows_carry_the_words(awkward):
    assert multiset(_mixed(awkward).collect()) == multiset(_mixed(awkward.repartition(3)).collect())
    out = mixing.mix(awkward.withColumns({"size": F.lit(1), "finish": F.lit("x"), "row": F.lit(2)}))
    assert out.columns == [*awkward.columns, "size", "finish", "row"]
    words = collections.Counter()
    for r in out.collect():
        words[r.doc_id] += len(brute.words(r.text))
    plan = collections.Counter()
    for r in _mixed(awkward).collect():
        plan[r.doc_id] += r.taken
    assert words == +plan


def test_mix_is_sorted_by_virtual_time(small):
    """In any prefix of the mix every running source has words by weight."""
    rows = mixing.mix(small).select("source", "text").collect()
    seen = collections.Counter()
    for r in rows[:len(rows) // 4]:
        seen[r.source] += len(brute.words(r.text))
    by = sorted({r.source for r in rows})
    heavy, light = (np.mean([seen[s] for s in by[k::3]]) for k in (0, 2))
    assert heavy > 2.5 * light


def test_mix_without_words(empty, awkward):
    assert _mixed(empty).collect() == [] and mixing.mix(empty).collect() == []
    none = _mixed(awkward.where("text is null")).collect()
    assert [(r.size, r.taken, r.target) for r in none] == [(0, 0, 0.0)]


# packing

def test_rooms_need_no_padding():
    for total in (0, 1, 2, 2047, 2048, 2049, 5000, 123_457):
        assert sum(packing.rooms(total)) == total
        assert all(r == 2048 or r & (r - 1) == 0 for r in packing.rooms(total))


def test_pack_costs_are_balanced():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 400, 500).tolist()
    cost = collections.Counter()
    for _, _, n, s, _ in packing.pack(sizes):
        cost[s] += packing.cost(n)
    full = [c for s, c in cost.items() if s < sum(sizes) // 2048]
    assert max(full) < 1.1 * min(full)


def test_packed_pieces_cover_every_id_once(frames):
    for df, rows in frames:
        ids = {(d, t): i + [1] for (d, t), i in zip(rows, brute.ids_of([t for _, t in rows]), strict=True)}
        want = collections.Counter()
        for key in rows:
            want[key[0], len(ids[key])] += 1
        pieces = packing.packed(df.select("doc_id", "text")).collect()
        by_doc = collections.defaultdict(list)
        for (d, _), i in ids.items():
            by_doc[d].append(i)
        left, sequence = collections.Counter(), collections.defaultdict(list)
        for p in pieces:
            assert 1 <= p.length <= 2048
            assert any(len(i) == p.doc_tokens and brute.crc(i[p.start:p.start + p.length]) == p.ids_crc32 for i in by_doc[p.doc_id])
            left[p.doc_id, p.doc_tokens] += p.length
            sequence[p.sequence_id].append((p.offset, p.length))
        assert left == collections.Counter({(d, n): n * k for (d, n), k in want.items()})
        for parts in sequence.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end == 2048 or end & (end - 1) == 0


def test_packed_empty(empty):
    assert packing.packed(empty).collect() == []


# hidden Markov model

def _slow_forward(model, symbols):
    a = model.start * model.emit[symbols[0]]
    for s in symbols[1:]:
        a = (a @ model.move) * model.emit[s]
    return np.log(a.sum())


def _toy_model(k=3, n=7, seed=2):
    rng = np.random.default_rng(seed)
    part = lambda *s, axis: (lambda x: x / x.sum(axis=axis, keepdims=True))(rng.random(s) + 0.1)
    return hmm.Model(part(k, axis=0), part(k, k, axis=1), part(n, k, axis=0))


def test_forward_is_the_exact_likelihood_and_sums_to_one():
    model, rng = _toy_model(), np.random.default_rng(3)
    sizes = np.array([4, 1, 9, 9, 2])
    symbols = rng.integers(0, 7, sizes.sum())
    got, at = hmm.forward(model, symbols, sizes), np.cumsum(sizes) - sizes
    assert np.allclose(got, [_slow_forward(model, symbols[a:a + n]) for a, n in zip(at, sizes, strict=True)])
    every = np.array(np.meshgrid(*[range(7)] * 3)).reshape(3, -1).T
    assert np.exp(hmm.forward(model, every.ravel(), np.full(343, 3))).sum() == pytest.approx(1)


def test_expected_counts_are_those_of_all_paths():
    model = _toy_model(k=2, n=3)
    symbols = np.array([0, 2, 1, 1])
    paths = np.array(np.meshgrid(*[range(2)] * 4)).reshape(4, -1).T
    weight = np.array([model.start[p[0]] * np.prod([model.emit[s, k] for s, k in zip(symbols, p, strict=True)])
                       * np.prod([model.move[a, b] for a, b in zip(p[:-1], p[1:], strict=True)]) for p in paths])
    weight /= weight.sum()
    _, start, move, states = hmm.forward(model, symbols, np.array([4]), backward=True)
    assert np.allclose(states, [[weight[paths[:, t] == k].sum() for k in range(2)] for t in range(4)])
    assert np.allclose(start, states[0])
    assert np.allclose(move, [[sum(w * ((p[:-1] == a) & (p[1:] == b)).sum() for w, p in zip(weight, paths, strict=True))
                               for b in range(2)] for a in range(2)])


def test_training_raises_the_likelihood(spark, small):
    coded = hmm.chunks(small).cache()
    n = coded.agg(F.sum("train_tokens")).first()[0]
    counts = hmm.total_counts(coded, n).cache()
    table = hmm.symbols_of(counts, n)
    scored = hmm.scored_chunks(coded, counts, table).cache()
    total = [hmm.score(scored, hmm.train(scored, table, rounds=r), table).where("not held_out").agg(F.sum("score")).first()[0] for r in (0, 2)]
    assert total[1] > total[0]


def test_base_scores_and_counts(frames):
    for df, rows in frames:
        want = collections.Counter((d, brute.held_out(d), a, b, c, round(s, 6)) for (d, _), (a, b, c, s) in zip(rows, brute.base_scores(rows), strict=True))
        got = hmm.scored_texts(df.select("doc_id", "text")).collect()
        assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_held_out_texts_score_above_the_base(small):
    row = hmm.scored_texts(small.select("doc_id", "text")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def _scored(df):
    coded = hmm.chunks(df).cache()
    n = coded.agg(F.sum("train_tokens")).first()[0]
    counts = hmm.total_counts(coded, n).cache()
    table = hmm.symbols_of(counts, n)
    return hmm.scored_chunks(coded, counts, table).cache(), table


def _distinct(model):
    return len({c.tobytes() for c in np.round(model.emit.T / model.emit.max(), 12)})


def test_hmm_seeds_come_from_the_whole_table(spark):
    """Partitions in another order, with one, no or all training texts in the first, give the same first model."""
    train, held = [i for i in range(600) if hmm.is_training(i)], [i for i in range(600) if not hmm.is_training(i)]
    text = {i: " ".join(f"s{i % 12}w{(i * 7 + j * j) % 50}" for j in range(60 + i % 5)) for i in range(600)}
    models = []
    for first in (train[:1], held[:1], train[:300], [i for i in train if i % 12 == 0]):
        parts = [first, [i for i in range(600) if i not in first]]
        rdd = spark.sparkContext.parallelize([[(i, text[i]) for i in p] for p in parts], 2).flatMap(lambda p: p)
        scored, table = _scored(spark.createDataFrame(rdd, "doc_id long, text string"))
        models.append(hmm.seeds(scored, table.prior(), hmm.STATES))
    assert all(np.allclose(m.emit, models[0].emit) for m in models) and _distinct(models[0]) == hmm.STATES
    # texts of twelve kinds: no two states are seeded by one kind
    own = models[0].emit / table.prior()[:, None]
    assert len({int(i) for i in own.argmax(axis=0)}) == hmm.STATES


@pytest.mark.parametrize("n", [1, 2, 5])
def test_hmm_states_stay_distinct_with_few_texts(spark, n):
    rows = [(i, " ".join(f"t{i}w{j % 40}" for j in range(200))) for i in [i for i in range(50) if hmm.is_training(i)][:n]] * 2
    scored, table = _scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    assert _distinct(hmm.seeds(scored, table.prior(), hmm.STATES)) == hmm.STATES
    assert _distinct(hmm.train(scored, table)) == hmm.STATES


def test_hmm_without_rows_or_training_texts(empty, small):
    assert hmm.scored_texts(empty.select("doc_id", "text")).collect() == []
    held = small.where("pmod(crc32(cast(doc_id as string)), 7) = 2").select("doc_id", "text")
    rows = hmm.scored_texts(held).collect()
    assert len(rows) == held.count() and all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in rows)


# substring dedup

def test_substring_removals(frames):
    for df, rows in frames:
        want = collections.Counter((d, *x) for (d, _), x in zip(rows, brute.substring(rows), strict=True))
        got = substring.without_repeats(df.select("doc_id", "text")).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got) == want


def test_substring_intervals_are_maximal(spark):
    a, b = [f"w{i}" for i in range(200)], [f"v{i}" for i in range(30)]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b + a[20:90] + b + a[100:149] + a[:50])), (3, " ".join(a[:49]))], "doc_id long, text string")
    rows = substring.repeated_intervals(df).collect()
    assert [(r.id, r.starts, r.ends) for r in rows] == [(2, [30, 179], [100, 229])]


def test_substring_tasks_remember_what_they_sent(spark, monkeypatch):
    monkeypatch.setattr(substring, "SLICE", 2000)
    passage = " ".join(f"p{i}" for i in range(80))
    docs = [(i, f"a{i} b{i} {passage} c{i}") for i in range(200)]
    got = substring.without_repeats(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 80 if i else 0 for i in range(200)}


def test_substring_empty(empty):
    assert substring.without_repeats(empty).collect() == []


# exact dedup

def test_exact_groups(frames):
    for df, rows in frames:
        group = collections.defaultdict(list)
        for d, t in rows:
            group[brute.low(t)].append(d)
        got = exact.exact_groups(df).collect()
        kept = collections.Counter()
        for (d, t), n in collections.Counter((d, brute.low(t)) for d, t in rows).items():
            sha = hashlib.sha256(t.encode()).hexdigest()
            best = max(group[t], key=lambda x: -1 if x is None else x)
            mine = [r for r in got if r.doc_id == d and r.text_sha256 == sha]
            assert len(mine) == n and all(r.keep_id == best and r.group_size == len(group[t]) for r in mine)
            kept[sha] += sum(r.kept for r in mine)
        assert set(kept.values()) == {1}


def test_exact_keep_one_keeps_columns(awkward, empty):
    wide = awkward.withColumns({"digest": F.lit(1), "run": F.lit(2), "id": F.lit("x"), "nth": F.lit(0), "keep": F.lit(None)})
    out = exact.keep_one(wide)
    assert out.columns == wide.columns
    rows = out.collect()
    assert len(rows) == len({brute.low(r.text) for r in wide.collect()}) == len({brute.low(r.text) for r in rows})
    assert exact.keep_one(empty).collect() == [] and exact.exact_groups(empty).collect() == []


# SimHash

def test_xxh64_of_all_lengths():
    import xxhash
    data = np.random.default_rng(0).integers(0, 256, 4000).astype(np.uint8)
    starts = np.arange(0, 2000, 7)
    ends = starts + np.arange(len(starts)) % 80
    got = simhash.xxh64(data, ragged.lanes(data), starts, ends)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:b].tobytes(), seed=42) for a, b in zip(starts, ends, strict=True)]


def test_fingerprints_and_components(frames):
    for df, rows in frames:
        fps = [brute.fingerprint(t) for _, t in rows]
        root = brute.components(fps)
        low = {}
        for (d, _), f in zip(rows, fps, strict=True):
            if d is not None:
                low[root[f]] = min(d, low.get(root[f], d))
        want = collections.Counter((d, f, low.get(root[f])) for (d, _), f in zip(rows, fps, strict=True))
        assert collections.Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in simhash.near_groups(df).collect()) == want
        wide = df.withColumns({"fp": F.lit(1), "id": F.lit(2), "root": F.lit("x"), "own": F.lit(0), "row": F.lit(1)})
        out = simhash.keep_one(wide)
        assert out.columns == wide.columns
        kept = collections.Counter(root[brute.fingerprint(r.text)] for r in out.collect())
        assert set(kept) == set(root.values()) and set(kept.values()) == {1}


@pytest.mark.parametrize("split", [simhash.SPLIT, 4])
def test_links_find_every_close_pair(spark, monkeypatch, split):
    """A dense ball, a chain at two bits a step, and scattered points; hot groups are split again."""
    monkeypatch.setattr(simhash, "SPLIT", split)
    rng = np.random.default_rng(4)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)}
    chain = int(rng.integers(0, 1 << 62))
    for step in range(20):
        chain ^= (1 << (3 * step % 64)) | (1 << ((3 * step + 7) % 64))
        fps.add(chain)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 200)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    got = {r.u: r.v for r in simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()}
    groups = collections.defaultdict(set)
    for f, r in brute.components(fps).items():
        groups[r].add(f - (1 << 64) if f >> 63 else f)
    mine = collections.defaultdict(set)
    for (f,) in signed:
        mine[got.get(f, f)].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_simhash_empty(empty):
    assert simhash.near_groups(empty).collect() == [] and simhash.keep_one(empty).collect() == []


# license scans

def test_license_base_and_labels(frames):
    for df, rows in frames:
        want = collections.Counter()
        for d, t in rows:
            n, places, labels = brute.phrases(t)
            want[d, n, len(places), min(places, default=None), max(places, default=None), labels] += 1
        got = license.scanned(df).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
        for r in got:
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
            assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_license_join_equals_all_pairs(spark):
    """Blocks around the threshold, against every template."""
    rng = np.random.default_rng(7)
    vocabulary, sets, spans = license.template_sets()
    blocks = []
    for i in range(400):
        t = rng.integers(len(sets))
        base = list(sets[t])
        keep = [w for w in base if rng.random() < 0.9] + rng.choice(len(vocabulary), rng.integers(0, 6)).tolist()
        blocks.append((i, 0, spans[t], sorted(set(map(int, keep)))))
    got = license.matches(spark.createDataFrame(blocks, "row long, block int, span int, words array<int>"))
    want = {(i, license.TEMPLATES[t][0], len(set(w) & set(s)) / len(s)) for i, _, x, w in blocks for t, s in enumerate(sets)
            if spans[t] == x and len(set(w) & set(s)) >= license.needed(len(s))}
    assert {(r.row, r.label, r.score) for r in got.collect()} == want and want


def test_license_in_a_long_line(spark, empty):
    notice, words = license.TEMPLATES[1][1], [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[:i]) + " " + notice.upper() + " " + " ".join(words)) for i in range(0, 130, 13)] + [(999, " ".join(words))]
    got = license.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in got} == {d: "" if d == 999 else "apache-notice" for d, _ in rows}
    assert license.scanned(empty).collect() == []


@pytest.mark.parametrize("n", [21, 50, 64, 100, 400])
def test_license_templates_of_any_length(spark, n):
    """A template of n words at every offset within its span, in one line and wrapped."""
    rng = np.random.default_rng(n)
    own = [f"t{i}" for i in rng.integers(0, 2 * n, n)]
    templates, other = [("long", " ".join(own)), ("short", "alpha beta gamma")], [f"w{i}" for i in range(license.span(n) + 3)]
    rows, step = [], 1 if n <= 50 else 7
    for i in range(0, license.span(n) + 1, step):
        rows.append((i, " ".join([*other[:i], *own, *other[:i % 5]])))
        rows.append((10_000 + i, " ".join(other[:i]) + "\n" + "\n".join(" ".join(x) for x in np.array_split(np.array(own), 9)) + "\nend"))
    # below the threshold: the words are there, but spread too far
    far = " ".join(w + " x" * (2 * license.span(n) // n + 2) for w in own)
    rows += [(-1, far), (-2, " ".join(own[:n // 2]))]
    got = license.scanned(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()
    assert {r.doc_id: r.labels for r in got} == {d: "" if d < 0 else "long" for d, _ in rows}
    assert all(r.score == 1.0 for r in got if r.doc_id >= 0)


def test_license_without_templates(spark):
    got = license.scanned(spark.createDataFrame([(1, "Apache License")], "doc_id long, text string"), []).collect()
    assert [(r.labels, r.score) for r in got] == [("apache", 0.0)]


def test_license_wrapped_over_lines(spark):
    """A notice over two and three lines, at the start of a text and at every place of a block."""
    rows, want = [], {}
    for t in (1, 3, 5, 8):
        label, notice = license.TEMPLATES[t]
        w = notice.split()
        for n in (2, 3):
            lines = [" * " + " ".join(x) for x in np.array_split(np.array(w), n)]
            for before in (0, 1, 17, 31, 32, 40, 63, 64, 95):
                head = [" ".join(f"w{i}" for i in range(before))] if before else []
                d = len(rows)
                rows.append((d, "\r\n".join([*head, *lines, "and so on"]).upper()))
                want[d] = label
    # the halves of a notice far apart, or in two documents, are none
    w = license.TEMPLATES[3][1].split()
    far = "\n".join(["x " * 40] * 3)
    rows += [(1000, " ".join(w[:8]) + "\n" + far + "\n" + " ".join(w[8:])), (1001, " ".join(w[:8])), (1002, " ".join(w[8:]))]
    got = {r.doc_id: r for r in license.scanned(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert all(label in got[d].labels.split(",") and got[d].score == 1.0 for d, label in want.items())
    assert all(got[d].labels == "" and got[d].score == 0 for d in (1000, 1001, 1002))


# token counts and ids

def test_token_counts_equal_the_library(frames):
    for df, rows in frames:
        got = df.select("doc_id", tokens.count_tokens("text").alias("n")).collect()
        assert collections.Counter((r.doc_id, r.n) for r in got) == collections.Counter(
            (d, len(i)) for (d, _), i in zip(rows, brute.ids_of([t for _, t in rows]), strict=True))


def test_tokens_of_random_strings():
    rng = np.random.default_rng(11)
    alphabet = [chr(c) for c in range(128)] + list("''''''''sstmdrevll  \n") + list("éÉßÿÀ×÷ªµ·ĂŃɐΣςİḰ 中🙂")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(3000)]
    import pyarrow as pa
    array = pa.array([t + "\n" for t in texts])
    want = [i for i in brute.ids_of(texts)]
    merger, codec = tokens.RankMerger(tokens.vocabulary_path()), tokens.Codec(tokens.vocabulary_path())
    for lo, hi, buf, offsets in ragged.slices(array, 5000):
        assert merger.counts(buf, offsets).tolist() == [len(i) for i in want[lo:hi]]
        ids, at = codec.encode(buf, offsets, 1)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [i + [1] for i in want[lo:hi]]


def test_orc_files_round_trip(spark, frames, empty):
    for df, rows in frames:
        folder = orcids.write(df.select("doc_id", "text"))
        back = orcids.read(spark, folder)
        ids = [i + [1] for i in brute.ids_of([t for _, t in rows])]
        want = sorted(((d is not None, d or 0), i) for (d, _), i in zip(rows, ids, strict=True))
        got = sorted(back.collect(), key=lambda r: r.start)
        assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[0] for w in want]
        assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids) for r in got) == want
        assert [r.start for r in got] == np.cumsum([0] + [len(r.ids) for r in got])[:-1].tolist()
        sums = back.select("n_tokens", "ids", orcids.crc32("ids").alias("c")).collect()
        assert all(r.n_tokens == len(r.ids) and r.c == brute.crc(r.ids) for r in sums)
    assert orcids.read(spark, orcids.write(empty.select("doc_id", "text"))).collect() == []


def test_orc_reads_are_pruned(spark, small):
    folder = orcids.write(small.select("doc_id", "text"))
    plan = orcids.read(spark, folder).where("doc_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan
    plan = spark.read.schema(orcids.SCHEMA).orc(folder).agg(F.sum("n_tokens"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n_tokens:bigint>" in plan


# quality rules

def test_statistics(frames):
    for df, rows in frames:
        got = quality.document_statistics(df).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == \
            collections.Counter((d, *brute.statistics(t)) for d, t in rows)


def test_forest_is_monotone_and_learns():
    rng = np.random.default_rng(9)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.random(3000)) < 0.6).astype(float)
    forest = quality.fit_forest(x[:2000], y[:2000], [-1, 0, 0])
    assert ((forest.margin(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.9
    for row in x[:200]:
        line = np.repeat(row[None, :], 50, axis=0)
        line[:, 0] = np.linspace(0, 1, 50)
        assert (np.diff(forest.margin(line)) <= 1e-12).all()


def test_quality_held_out_accuracy(spark):
    stats = quality.document_statistics(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    forest = quality.fit(stats, labels.where("doc_id % 2 = 0"))
    rows = quality.verdicts(stats, forest).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.97


def test_quality_samples_labels_by_bound(small, spark):
    stats, labels = quality.document_statistics(small), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert isinstance(quality.fit(stats, labels, max_rows=30), quality.Forest)


def test_quality_keep_good(awkward, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    forest = quality.fit(quality.document_statistics(awkward), none)
    wide = awkward.withColumns({"s": F.lit(1), "n_words": F.lit(2), "kept": F.lit("x")})
    out = quality.keep_good(wide, forest)
    assert out.columns == wide.columns
    good = lambda t: (lambda s: s[0] >= 10 and s[4] * 100 <= 20 * s[0])(brute.statistics(t))
    assert multiset(out.collect()) == multiset(r for r in wide.collect() if good(r.text))
    assert quality.keep_good(empty, forest).collect() == []


def test_crc_of_ranges():
    ids = np.array([1, 70_000, 3], np.uint32)
    assert ragged.crc32s(ids, np.array([0, 2, 2, 3])).tolist() == [
        zlib.crc32(ids[:2].tobytes()), 0, zlib.crc32(ids[2:].tobytes())]


def test_xxh64_of_spans_of_every_length():
    import xxhash
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 60_000).astype(np.uint8)
    size = np.concatenate([np.arange(0, 300), np.arange(simhash.LONG - 40, simhash.LONG + 40), [9000]])
    starts = rng.integers(0, 50_000, len(size))
    got = simhash.xxh64(buf, ragged.lanes(buf), starts, starts + size)
    data = buf.tobytes()
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:a + n], seed=simhash.SEED) for a, n in zip(starts, size)]

"""Hard negatives, url filters and the Merkle manifest against plain Python versions."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import merkle, negatives, urls
from riskframe.llm.catalog import LISTED_WORDS, QUERIES, URL_RULES

SF001 = "/root/testdata/sf0.001"


def multiset(rows):
    return collections.Counter(repr(tuple(r)) for r in rows)


# hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, score int"


def _relabelled():
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


def _mined(df, is_anchor=None, **kw):
    return negatives.hard_negatives(df, F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor, label=_relabelled(), **kw)


def _brute_negatives(rows, every=100, k=5, low=80, high=100):
    used = {}
    for vec_id, vec, label, *_ in rows:
        if vec_id is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        item = (label, [math.floor(256 * float(np.float32(x))) for x in vec])
        used[vec_id] = min(used.get(vec_id, item), item)
    out = []
    for a, (own, u) in used.items():
        if a % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(u, v)), i, lab) for i, (lab, v) in used.items() if i != a)
        for p, i, _ in [r for r in ranked if r[2] == own][:k]:
            inside = [(n, j) for n, j, lab in ranked if lab != own and low * -p <= 100 * -n <= high * -p][:k]
            out += [(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(inside, 1)]
    return out


def _vectors(n, seed, dims=20):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centre)
        rows.append((i, [0.5 * x + rng.gauss(0, 0.3) for x in c], rng.randrange(4), "x", 1))
    return rows


def test_negatives_equal_brute_force(spark):
    rows = _vectors(700, 1)
    rows += [(5000 + i, rows[3][1], i % 3, None, None) for i in range(60)]        # one common vector, many ties
    got = _mined(spark.createDataFrame(rows, VECTORS))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = _brute_negatives(rows)
    assert len(want) > 100 and multiset(got.collect()) == multiset(want)


def test_negatives_in_many_small_blocks(spark, monkeypatch):
    """Blocks of rows and of anchors don't change the result."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 11)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    rows = _vectors(300, 2, dims=9)
    got = _mined(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, n_positives=3, n_negatives=4, low=50, high=90)
    want = [r for r in _brute_negatives(rows, every=20, k=4, low=50, high=90)]
    firsts = {}
    for r in sorted(want, key=lambda r: -r[4]):
        firsts.setdefault(r[0], {})[r[1]] = None
    assert multiset(got.select("anchor_id", "positive_id", "rank", "negative_id").collect()) <= multiset(r[:4] for r in want)
    full = _mined(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, n_positives=4, n_negatives=4, low=50, high=90)
    assert multiset(full.collect()) == multiset(want)


def test_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0], 1, None, None), (100, None, 1, None, None), (200, [1.0, None], 1, None, None),
            (300, [nan, 1.0], 1, None, None), (400, [inf, 1.0], 1, None, None), (500, [1.0, 1.0], None, None, None),
            (600, [], 1, None, None), (700, [0.5, 0.25, -0.5], 0, "x", 2), (700, [0.5, 0.25, -0.5], 0, "x", 2),
            (700, [0.25], 3, "y", 3), (0, [1.0, 0.5], 1, None, None), (1, [1.0, 0.5], 2, None, None), (2, [1.0, 0.5], 2, None, None),
            (3, [0.9, 0.5], 3, None, None), (4, [0.7, 0.5, 9.0], 3, None, None), (5, [0.9, 0.5], 2, None, None),
            (800, [-1.0, -1.0], 5, None, None), (801, [1.0, 1.0], 5, None, None), (802, [1.0, 1.0], 6, None, None),
            (900, [0.0, 0.0], 8, None, None), (901, [1.0, 1.0], 8, None, None)]
    df = spark.createDataFrame(rows, VECTORS)
    want = _brute_negatives(rows)
    assert want and multiset(_mined(df.repartition(7)).collect()) == multiset(want)
    assert _mined(df.limit(0)).count() == 0
    assert _mined(df.where("vec_id = 700")).count() == 0
    with pytest.raises(Exception, match="out of range"):
        _mined(spark.createDataFrame([(0, [1e30], 1, None, None), (1, [1.0], 1, None, None)], VECTORS)).collect()


def test_vertical_scan_keeps_exact_sums_and_the_best():
    rng = np.random.default_rng(0)
    x = rng.integers(-90, 90, (40, 500)).astype(float)
    for _ in range(20):
        a = rng.integers(-90, 90, 40).astype(float)
        alive = rng.random(500) < 0.7
        left, sums = negatives.vertical_scan(x, x.min(axis=1), x.max(axis=1), a, alive, negatives._of_top(5))
        scores = a @ x
        assert (sums == scores[left]).all()
        assert set(np.argsort(-np.where(alive, scores, -np.inf), kind="stable")[:5]) <= set(left)
        assert len(left) < 250          # bounds did drop rows


# url filters

def _brute_url(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best


def _parents(host):
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def _brute_verdicts(rows, blocked):
    out = []
    for page_id, url in rows:
        host, path, rule = _brute_url(url)
        hit = any(d in blocked and len(d) <= 253 for d in _parents(host))
        out.append((page_id, host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if hit else "allow"))
    return out


ODD_URLS = [None, "", "no scheme", "http://", "://", "http:///x", "HTTP://A.Example.NET/EN/x", "http://a.example.net/en/x?y#z",
            "http://example.net", "http://example.net/", "http://xexample.net/en/", "http://net/en", "http://example.com/de/?q",
            "http://example.com/d", "http://example.com?x://y/z", "http://b.org/fr/1", "http://b.org/fr", "http://É.org/fr/",
            "https://user@host.example.com:80/de/", "a://b://c", "http://a\nb.net/\nx", "http://x.spam.example.com/", "http://spam.example.com./",
            "http://" + "a." * 40_000 + "bad.example.com/x", "http://" + "q" * 300 + ".bad.example.com/x", "http://sub.BAD.example.com",
            "http://notbad.example.com/", "http://bad.example.com.evil/", "http://" + "z" * 241 + ".example.com/", "http://" + "z" * 242 + ".example.com/"]


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(3)
    rows = list(enumerate(ODD_URLS)) + [(None, "http://bad.example.com/"), (7, "http://bad.example.com/"), (7, "http://bad.example.com/")]
    rows += [(100 + i, f"http://h{rng.randrange(300)}.{rng.choice(['bad.example.com', 'good.example.com', 'example.net', 'org', 'x.de'])}/{rng.choice(['en', 'de', 'fr'])}/")
             for i in range(1500)]
    return rows


def test_urls_equal_brute_force(spark, pages):
    rng = random.Random(4)
    blocked = {"bad.example.com", "x.de", "spam.example.com.", "z" * 241 + ".example.com", "z" * 242 + ".example.com", "nowhere.example"}
    blocked |= {f"h{i}.good.example.com" for i in rng.sample(range(300), 120)}
    df = spark.createDataFrame(pages, "page_id bigint, url string").withColumns({"verdict": F.lit("x"), "host": F.lit(1), "hit": F.lit(2), "rule_hit": F.lit(3)})
    listed = spark.createDataFrame([(d,) for d in sorted(blocked)] + [(None,), ("BAD.example.com",)], "domain string")
    want = multiset(_brute_verdicts(pages, blocked))
    for max_bytes in (urls.MAX_BYTES, 8):           # the cascade, and the join beyond its bound
        got = urls.judged(df.repartition(3), URL_RULES, listed, max_bytes=max_bytes)
        assert multiset(got.select("page_id", "host", "path", "rule", "verdict").collect()) == want
    nothing = urls.judged(df, URL_RULES, listed.limit(0))
    assert multiset(nothing.select("page_id", "host", "path", "rule", "verdict").collect()) == multiset(_brute_verdicts(pages, set()))
    assert urls.judged(df.limit(0), URL_RULES, listed).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    """Small filters have false positives at every level; the cascade has none."""
    universe = spark.range(60_000).select(*urls.key(F.concat(F.lit("d"), F.col("id"))), (F.col("id") % 7 == 0).alias("listed")).cache()
    cascade = urls.build(universe)
    assert len(cascade.levels) >= 4 and cascade.n_bytes() < 60_000
    got = universe.withColumn("got", cascade.listed(F.array(F.struct("a", "b"))))
    assert got.where("got <> listed").count() == 0
    assert urls.build(universe, max_bytes=1000) is None
    assert urls.build(universe.where("listed = false")).levels == []
    only = urls.build(universe.where("listed"))
    assert universe.where("listed").where(~only.listed(F.array(F.struct("a", "b")))).count() == 0
    # keys that can't be told apart: no cascade
    twins = universe.limit(1).select("a", "b", F.explode(F.array(F.lit(True), F.lit(False))).alias("listed"))
    assert urls.build(twins) is None


def test_url_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url").collect()]
    names = {d for _, u in rows for d in _parents(_brute_url(u)[0])}
    blocked = {d for d in names if set(d.split(".")[0].split("-")) & set(LISTED_WORDS)}
    assert multiset(QUERIES["op12_urls"](spark, SF001).collect()) == multiset(_brute_verdicts(rows, blocked))


# Merkle manifest

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _brute_leaf(row):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _tree(nodes):
    """The top of a list of digests, and for each its (left, right) siblings upwards."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [list(range(i, min(i + 3, len(nodes)))) for i in range(0, len(nodes), 3)]
        for run in runs:
            for j in run:
                sides = "".join(nodes[x] for x in run if x < j), "".join(nodes[x] for x in run if x > j)
                for leaf in groups[j]:
                    paths[leaf].append(sides)
        groups = [[leaf for j in run for leaf in groups[j]] for run in runs]
        nodes = [_h(*[nodes[j] for j in run]) for run in runs]
    return nodes[0], paths


def _brute_merkle(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, _brute_leaf(r)))
        trees[s] = (own, *_tree([_brute_leaf(r) for r in own]))
    root, upper = _tree([trees[s][1] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        own, top, paths = trees[s]
        for r, path in zip(own, paths):
            h = _brute_leaf(r)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            folded = _brute_leaf((*r[:4], None if r[4] is None else r[4].replace("\n", ""))) if changed else h
            for left, right in path + above:
                folded = _h(left, folded, right)
            out.append((r[0], h, top, root, _h(*[a + b for a, b in path + above]), folded, folded == root))
    return out


def _proved(df):
    out = merkle.proofs(df, F.replace("text", F.lit("\n"), F.lit("")), F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256), "folded_root", "verified")


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_merkle_equals_brute_force(awkward, small):
    for df in (awkward, small, awkward.withColumns({"row": F.lit(1), "tree": F.lit("x"), "pos": F.lit(0), "leaf": F.lit("y")})):
        got = _proved(df)
        assert multiset(got.collect()) == multiset(_brute_merkle(_rows(df)))
    assert not all(r.verified for r in got.collect())


@pytest.mark.parametrize("sources,each", [(1, 1), (1, 28), (40, 2), (5, 100), (1, 800)])
def test_merkle_of_all_shapes(spark, sources, each):
    rows = [(i, f"s{i % sources}", "en", 1, f"text {i}\nend") for i in range(sources * each)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert multiset(_proved(df).collect()) == multiset(_brute_merkle(rows))


def test_merkle_of_repeated_rows_and_of_none(spark, empty, monkeypatch):
    monkeypatch.setattr(merkle, "EXPAND", 7)
    monkeypatch.setattr(merkle, "PER_KEY", 5)         # several salts per node
    rows = [(3, "a", None, None, "same")] * 100 + [(None, None, None, None, None)] * 30 + [(i, "a", "x", 2, "t") for i in range(40)]
    df = spark.createDataFrame(rows, empty.schema.fieldNames() and "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert multiset(_proved(df.repartition(4)).collect()) == multiset(_brute_merkle(rows))
    assert _proved(empty).count() == 0


def test_merkle_query_detects_tampering(spark):
    rows = QUERIES["op13_merkle"](spark, SF001).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in rows:
        touched = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (docs[r.doc_id] or "")
        assert r.verified == (not touched)

"""The registered queries and the pipeline, stage by stage, against plain Python."""

import collections
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from riskframe.llm import quality  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(n for n in entry.LLM_QUERIES if n not in ("pipeline", "op11_negatives", "op12_urls")))
def test_queries_cover_the_whole_table(spark, name):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert entry.queries()[name](spark, SMALL).select(F.countDistinct("doc_id")).first()[0] == n


def test_stages(spark, awkward):
    """Every stage on what the stage before kept, awkward rows included."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(awkward.withColumn("doc_id", F.col("doc_id") + 100_000))
    clash = ["row", "size", "queue", "finish", "words", "fp", "id", "digest", "run", "nth", "keys", "n"]
    docs = docs.withColumns({c: F.lit("extra") for c in clash})
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    forest = quality.fit(quality.document_statistics(docs), labels)
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, SMALL).cache()
        after = docs.collect()
        if name != "pack_sequences":
            assert docs.columns == [*awkward.columns, *clash]
        if name == "quality_rules":
            counts = {c: [] for c in quality.COUNTS}
            kept = quality.verdicts(quality.document_statistics(spark.createDataFrame(before).select("doc_id", "text")), forest)
            assert collections.Counter(r.doc_id for r in kept.where("kept").collect()) == collections.Counter(r.doc_id for r in after)
            assert counts
        if name == "exact_dedup":
            best = {}
            for r in before:
                best[brute.low(r.text)] = max(best.get(brute.low(r.text), -1), -1 if r.doc_id is None else r.doc_id)
            assert {brute.low(r.text): -1 if r.doc_id is None else r.doc_id for r in after} == best and len(after) == len(best)
        if name == "simhash_dedup":
            root = brute.components([brute.fingerprint(r.text) for r in before])
            assert collections.Counter(root[brute.fingerprint(r.text)] for r in after) == collections.Counter(set(root.values()))
        if name == "source_mix":
            size = collections.Counter()
            for r in before:
                size[r.source] += len(brute.words(r.text))
            taken = collections.Counter()
            for r in after:
                taken[r.source] += len(brute.words(r.text))
            assert all(abs(taken[s] - t) < 2 for s, t in brute.targets(dict(size)).items())
        if name == "pack_sequences":
            ids = brute.ids_of([r.text for r in before])
            assert sum(r.length for r in after) == sum(len(i) + 1 for i in ids)


def test_ties_are_settled_alike_on_every_run(spark):
    """Rows equal in text and id that differ elsewhere: whatever the partitions, the same one stays."""
    rows = [(1, "a common text of some words here", s, "en", n) for s in "abc" for n in range(4)] + [(None, "null id", s, None, None) for s in "xyz"]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    for keep in (corpus_pipeline.exact_dedup, corpus_pipeline.simhash_dedup):
        kept = [sorted(map(repr, keep(spark, df.repartition(n), SMALL).collect())) for n in (1, 3, 7)]
        assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2


def test_label_sample_is_bounded(spark):
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert quality.labelled_sample(labels, 60_000).count() == 50_000
    assert 1700 < quality.labelled_sample(labels, 2000).count() < 2300


def test_pipeline_runs_on_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

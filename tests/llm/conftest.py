import random

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, long = text(60), text(30_000)
    texts = [None, "", "   \n\t ", "One", "one", "ONE", "two words", long, long, long.upper().replace("É", "é"), passage,
             f"{text(20)} {passage} {text(20)}", f"{passage}\n{passage}", f"{text(30)} {passage}", "é É ß ÿ × ÷ İstanbul ＡＢＣ 中文  x y",
             "it's we're I'd they'll ''s 'tis x'sabc don't'", "<|endoftext|> and <|startoftext|> <| x |>", "a\x00b\x1cc\x0bd\x85e",
             "tab\tline\r\nfeed\x0c", "*** $$$ %%% ### &&& || <>" * 20, "same line here\nsame line here\n\n\nsame line here",
             "Released under the MIT License.", "x GNU  general PUBLIC-license, v3", "cc by cc-by\nCC BY-NC 4.0", "a" * 70_000,
             "aaaaaaaaaaaaaaab!!!!!!!!!!?? 12345 x1y2"]
    texts += [text(rng.randint(1, 400)) for _ in range(40)]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", "", None, "ü"]), None if t is None else len(t)) for i, t in enumerate(texts)]
    near = text(200).split()
    for i in range(8):
        copy = list(near)
        copy[rng.randrange(200)] = "changed"
        rows.append((1000 + i, " ".join(copy), "en", "a", None))
    rows += [rows[11], rows[11], (None, passage, None, None, None), (None, passage, None, None, None), (None, text(90), None, "a", 1)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def frames(awkward, small):
    """Both tables, each with its rows as (doc_id, text)."""
    return [(df, [(r.doc_id, r.text) for r in df.collect()]) for df in (awkward, small)]

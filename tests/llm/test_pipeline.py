"""The corpus pipeline, stage by stage, against brute force on small documents."""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
from cases import documents, edge_rows, prose, save  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from occuflow.llm import secret_scan  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from test_operators import brute_groups, check_packing, near_rows, shingles  # noqa: E402

STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = edge_rows() + [(i, t, "s") for i, t in near_rows(4, 5)]
    rows += [(5000 + i, prose(900 + i, 60) + (" vile rotten words" if i % 2 else ""), "q") for i in range(60)]
    rows += [(6000, prose(1, 5) + " password=abcdefghijklmno tail", "q")]
    labels = [(5000 + i, 1, i % 2) for i in range(40)]
    return save(spark, tmp_path_factory.mktemp("pipe"), rows, labels)


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]


def test_toxicity_drops_toxic_rows_and_keeps_the_others_as_they_are(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = STAGE["toxicity"](spark, docs, folder)
    assert got.columns == docs.columns
    want = docs.filter("text IS NULL OR text NOT LIKE '%vile rotten words'")
    assert rows_of(got) == rows_of(want)


def test_one_row_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = STAGE["near_duplicates"](spark, docs, folder)
    assert got.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    empty = [d for (d, _), s in zip(rows, sets) if not s]
    want = Counter(min(g, key=lambda d: (d is None, d or 0)) for k, g in groups.items() if sets[k]) + Counter(empty)
    assert Counter(r["doc_id"] for r in got.collect()) == want
    assert sum(brute_groups(rows).values()) > sum(want.values())


def test_secrets_are_marked_and_no_row_goes(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = STAGE["secrets"](spark, docs, folder)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    encoder = secret_scan.load_encoder("byte_bpe_50k.tiktoken")
    want = Counter()
    for r in docs.collect():
        _, spans = secret_scan.scan_text(r["text"] or "", encoder)
        text = secret_scan.redact_text(r["text"], spans) if spans else r["text"]
        want[r["doc_id"], text, r["lang"], r["source"], len(text) if spans else r["n_chars"]] += 1
    assert rows_of(got) == want
    assert got.filter("doc_id = 6000 AND text LIKE '%[SECRET] tail'").count() == 1


def test_mixing_repeats_rows_as_the_operator_says(spark, folder):
    from occuflow.llm import mixing

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = STAGE["mixing"](spark, docs, folder)
    assert got.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["text"], r["source"]] += len(r["placements"])
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in got.collect()) == +want
    assert max(want.values()) > 1


def test_packing_of_repeated_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.union(docs.filter("source = 'a'"))
    check_packing(STAGE["packing"](spark, docs, folder).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_extra_columns_with_clashing_names_pass_through(spark, folder):
    docs = (spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id >= 5000")
            .withColumn("toxic", F.lit("x")).withColumn("size", F.lit(1)).withColumn("placements", F.lit(2))
            .withColumn("secret_spans", F.lit("s")).withColumn("__cls", F.lit(7)).withColumn("a.b", F.lit(3)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.filter("toxic <> 'x' OR size <> 1 OR `a.b` <> 3").count() == 0


def test_empty_documents_and_labels(spark, tmp_path):
    where = save(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, where).collect() == []


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert rows_of(corpus_pipeline.run(spark, SF_SMALL)) == rows_of(docs)
    assert documents(spark, []).count() == 0

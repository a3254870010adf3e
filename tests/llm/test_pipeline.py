import collections

import pytest

import corpus_pipeline
from hearthline.llm import jaccard_join, mixing, toxicity
from hearthline.llm.catalog import TEXT_ORACLES, TEXT_QUERIES
from hearthline.session import written

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], SMALL), name))
    assert all(d.columns == columns for d in seen[:-1])
    start, calm, single, clean, mixed, packed = seen
    ids = lambda d: collections.Counter(r.doc_id for r in d.select("doc_id").collect())
    scorer = toxicity.fit(start, spark.read.parquet(f"{SMALL}/labels.parquet").where(f"NOT {toxicity.HELD_OUT}"))
    assert ids(calm) == ids(toxicity.score(start, scorer).where("score < 0.7"))
    assert ids(single) == ids(jaccard_join.jaccard_components(calm, 5, 80).where("doc_id = component_id"))
    assert ids(clean) == ids(single)
    uses = {r.doc_id: len(r.uses) for r in mixing.mix_sources(clean, sources="source").collect()}
    assert ids(mixed) == collections.Counter({k: n for k, n in uses.items() if n})
    whole = collections.Counter()
    for r in packed.collect():
        whole[r.doc_id] += r.length / r.doc_tokens
    assert {k: round(v) for k, v in whole.items()} == dict(ids(mixed))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
    assert docs.count() == 0


def test_every_operator_is_registered():
    assert [sum(q.startswith(f"op{n}_") for q in TEXT_QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(TEXT_ORACLES) <= set(TEXT_QUERIES) and "pipeline" in TEXT_QUERIES


@pytest.mark.parametrize("column", ["score", "pii", "uses", "members", "component_id"])
def test_extra_columns_stay(spark, column):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    if column == "pii":
        return  # a column of that name is replaced, as documented
    docs = docs.selectExpr("*", f"doc_id AS {column}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert column in docs.columns
    assert all(r.doc_id == r[column] for r in docs.collect())

"""The pipeline's stages one by one against the operators' brute-force decisions, and as a whole."""

import time

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_operators import brute_hits, brute_near, pairs, words
from tidelog.llm import mixing, near_copies, simhash, toxicity
from tidelog.llm.common import held


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "tokens"]
    clean = named["toxicity"](spark, docs, SF)
    bad = {r.doc_id for r in toxicity.predict(docs, toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("toxic").collect()}
    rows = pairs(clean)
    assert {i for i, _ in rows} == {i for i, _ in pairs(docs)} - bad and clean.columns == docs.columns
    first = {i for i, least in brute_near(rows).items() if i == least}
    unique = named["near_duplicates"](spark, clean, SF)
    rows = pairs(unique)
    assert sorted(i for i, _ in rows) == sorted(first) and unique.columns == docs.columns
    items = [(str(r.item_id), words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    fresh = named["decontamination"](spark, unique, SF)
    assert sorted(i for i, _ in pairs(fresh)) == sorted(i for i, t in rows if not brute_hits(t, items)[1]) and fresh.columns == docs.columns
    mixed = named["mixing"](spark, fresh, SF)
    assert sorted(i for i, _ in pairs(mixed)) == sorted(r.doc_id for r in mixing.mix(fresh, rate=corpus_pipeline.RATE).where("sampled").collect()) and mixed.columns == docs.columns
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(i for i, _ in pairs(mixed))


@pytest.mark.parametrize("stage", ["toxicity", "sketches", "fingerprints"])
def test_workers_hold_nothing_of_an_earlier_stage(spark, stage):
    """All waiting workers get a task of each job, as there are fewer of them than tasks and the longest waiting one is next."""

    def fill(batches):
        held("encoder of an earlier stage", lambda: bytes(1_000))
        time.sleep(0.05)
        yield from batches

    def tell(batches):
        from sys import modules

        time.sleep(0.05)
        yield from (pa.RecordBatch.from_arrays([pa.array([len(modules["tidelog_worker_state"].held) if "tidelog_worker_state" in modules else 0])], ["id"]) for _ in batches)

    tasks = spark.range(0, 32, 1, 32)
    tasks.mapInArrow(fill, "id long").collect()
    assert sum(r.id for r in tasks.mapInArrow(tell, "id long").collect()) > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(64).repartition(32)
    if stage == "toxicity":
        toxicity.predict(docs, toxicity.Chain.fit([], {"toxic": np.empty(0)}, np.empty(0))).collect()
    elif stage == "sketches":
        near_copies.sketches(near_copies._named(docs, "text", "doc_id")).collect()
    else:
        simhash.fingerprint_table(docs).collect()
    assert sum(r.id for r in tasks.mapInArrow(tell, "id long").collect()) == 0

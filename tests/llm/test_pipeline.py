from __future__ import annotations

from collections import Counter

import corpus_pipeline
import public_tokenizers
from test_minhash import brute_components
from tokenizers import Tokenizer

from millrace.llm import toxicity
from millrace.llm.queries import table

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    left = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, SF)
        seen.append(left.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert left.columns == docs.columns
            left = spark.createDataFrame(seen[-1], docs.schema)
    clean, single, apart, mixed, packed = seen
    everything = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in clean}
    # clean documents are kept; ten examples are few, so not every toxic one is known here
    toxic = [i for i in everything if labels.get(i) == 1]
    assert all(labels[i] == 1 for i in everything if i in labels and i not in kept)
    assert sum(i not in kept for i in toxic) >= len(toxic) / 2
    first = {}
    for r in sorted(clean, key=lambda r: r.doc_id):
        first.setdefault(r.text, r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(first.values())
    groups = brute_components([(r.doc_id, r.text) for r in single])
    assert sorted(r.doc_id for r in apart) == sorted(set(groups.values()))
    # rates follow the domains, so rows come more often, once or not at all, but no other rows
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in apart}
    budget = corpus_pipeline.MIX_BUDGET * sum(len((r.text or "").split()) for r in apart)
    assert abs(sum(len((r.text or "").split()) for r in mixed) - budget) < 0.25 * budget
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed:
        want[r.doc_id] += len(slow.encode(r.text, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.length
    assert got == want


def test_whole_run_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_nothing_in_nothing_out(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_nothing_to_learn_drops_nothing(spark):
    rows = table(spark, SF, "documents").limit(5).collect()
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), none)
    assert toxicity.score(docs, model).where("predicted = 0").count() == 5

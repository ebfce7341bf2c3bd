import corpus_pipeline
from tests.conftest import SF001
from txflow.llm.common import saved

from .test_packing import ids_of, pieces
from .test_secrets import brute as secrets_of
from .test_simhash import slow_components, slow_fingerprint


def masked(text):
    out, at = [], 0
    for start, _, end in secrets_of(text)[1]:
        if start >= at:
            out.append(text[at:start] + "[SECRET]")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_run_matches_the_stages_by_hand(spark):
    got = corpus_pipeline.run(spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    # the language model has its own accuracy test; its rejects are taken from the stage
    told = corpus_pipeline.language_id(spark, docs, SF001).collect()
    assert len(told) >= 0.99 * docs.count() and {r["doc_id"] for r in told} <= {r["doc_id"] for r in docs.collect()}
    comps = slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in told])
    kept = [(r["doc_id"], masked(r["text"])) for r, c in zip(told, comps) if r["doc_id"] == c]
    assert len(kept) < len(told)
    want = sorted((d, *p) for (d, _), ids in zip(kept, ids_of([t for _, t in kept])) for p in pieces(ids))
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        names = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = saved(stage(spark, docs, SF001), f"test-stage-{i}")
            assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == names
        docs.collect()

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF001
from txflow.llm import simhash
from txflow.llm.components import connected_components
from txflow.llm.queries import op3_simhash
from txflow.llm.simhash import keep_one, links, near_duplicates


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, bits=4):
    """(id, fingerprint) -> component id of each, by comparing all pairs."""
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                up[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [least.get(top(i)) for i in range(len(rows))]


def expected(docs):
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs]
    return sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, slow_components(rows))), key=repr)


def test_query_matches_brute_force(spark):
    got = sorted((tuple(r) for r in op3_simhash(spark, SF001).collect()), key=repr)
    assert got == expected(spark.read.parquet(f"{SF001}/documents.parquet").collect())


def test_odd_documents(odd_docs, no_docs):
    got = near_duplicates(odd_docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(odd_docs.collect())
    assert near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("segments", [2, 3, 4])
def test_links_join_what_all_pairs_join(spark, monkeypatch, segments):
    monkeypatch.setattr(simhash, "BLOCK", 8)   # so that buckets are split
    rng = random.Random(segments)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    values = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(25)}
    values |= {rng.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    found = links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, segments).collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 4 for r in found)
    comps = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(found, "a long, b long")).collect()}
    want = slow_components(list(enumerate(values)))
    groups, wanted = {}, {}
    for i, v in enumerate(signed):
        groups.setdefault(comps.get(v, v), []).append(i)
        wanted.setdefault(want[i], []).append(i)
    assert sorted(groups.values()) == sorted(wanted.values())


def test_components_of_chains_stars_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (None, 1), (7000, 7001), (7001, 7000)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    parts = {}
    for r in got:
        parts.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, parts.values())) == [list(range(301)), list(range(1000, 1200)), [7000, 7001]]
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(odd_docs, no_docs):
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and keep_one(no_docs).count() == 0
    rows = odd_docs.collect()
    comps = {d: c for d, _, c in expected(rows) if d is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(d for d, c in comps.items() if d == c)
    # a text that only rows without an id have stays once
    bare = odd_docs.filter("doc_id is null").withColumn("text", F.lit("only rows without an id hold this"))
    assert keep_one(odd_docs.unionByName(bare)).filter("doc_id is null").count() == ids.count(None) + 1


@pytest.mark.parametrize("rows, want", [
    ([(1, "A"), (1, "B"), (2, "B")], [(1, "A"), (1, "B")]),
    ([(1, "A"), (2, "A"), (2, "B")], [(1, "A"), (2, "B")]),
    ([(1, "A"), (2, "B"), (2, "A")], [(1, "A"), (2, "B")]),
    ([(2, "A"), (1, "B"), (2, "B"), (None, "A"), (None, "C"), (None, "C")], [(1, "B"), (2, "A"), (None, "C")]),
    ([(3, "A"), (3, "A"), (3, "A"), (4, "B")], [(3, "A"), (4, "B")]),
])
def test_keep_one_loses_no_text_of_an_id_that_repeats(spark, rows, want):
    """Every text stays once, whatever the order of the rows, also where an id stands on several."""
    texts = {x: " ".join(f"{x}word{i}" for i in range(40)) for x in "ABC"}
    schema = "doc_id long, text string, lang string, root int"
    for given in (rows, rows[::-1]):
        kept = keep_one(spark.createDataFrame([(i, texts[x], "en", 1) for i, x in given], schema)).collect()
        assert sorted(((r["doc_id"], r["text"][0]) for r in kept), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("wide_from", [1, 10_000])
def test_the_segments_chosen_by_size_find_the_same_components(spark, monkeypatch, wide_from):
    """``links`` takes two segments from WIDE_FROM fingerprints on and three below: the components are those of all pairs."""
    monkeypatch.setattr(simhash, "WIDE_FROM", wide_from)
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(8)]
    values = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(20)})
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    found = links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4).collect()
    comps = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(
        [(r["a"], r["b"]) for r in found], "a long, b long")).collect()}
    want = slow_components(list(enumerate(values)))
    groups, wanted = {}, {}
    for i, v in enumerate(signed):
        groups.setdefault(comps.get(v, v), []).append(i)
        wanted.setdefault(want[i], []).append(i)
    assert sorted(groups.values()) == sorted(wanted.values())

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.conftest import SF001
from tests.llm.conftest import plain
from txflow.llm import ppm
from txflow.llm.ppm import score_documents


def out_of(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def brute(rows, order):
    """PPM with method C and exclusion, context by context in dictionaries."""
    follow = defaultdict(Counter)
    coded = {}
    for _, text in rows:
        data = list(lowered(text).encode())
        coded[text] = [None] * order + data + ["end"]
    for i, text in rows:
        if not out_of(i):
            x = coded[text]
            for at in range(order, len(x)):
                for j in range(order + 1):
                    follow[tuple(x[at - j:at])][x[at]] += 1
    words = Counter()
    for i, text in rows:
        if not out_of(i):
            words.update(re.findall(r"[^\x20\x09-\x0D]+", lowered(text)))
            words["<end>", 0] += 1
    total = sum(words.values())

    def logp(x, at):
        p, gone = 0.0, set()
        for j in range(order, -1, -1):
            seen = follow.get(tuple(x[at - j:at]))
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in gone}
            parts = sum(left.values()) + len(left)
            if x[at] in left:
                return p + math.log10(left[x[at]] / parts)
            if parts:
                p += math.log10(len(left) / parts)
            gone |= set(seen)
        return p - math.log10(max(1, 257 - len(gone)))

    scores = {}
    for _, text in rows:
        if text not in scores:
            x = coded[text]
            scores[text] = sum(logp(x, at) for at in range(order, len(x)))
    out = []
    for i, text in rows:
        tokens = [*re.findall(r"[^\x20\x09-\x0D]+", lowered(text)), ("<end>", 0)]
        base = sum(math.log10((words[t] + 1) / (total + len(words) + 1)) for t in tokens)
        out.append((i, out_of(i), len(tokens), sum(words[t] > 0 for t in tokens), total, base, scores[text]))
    return out


def check(df, rows, **kw):
    got = plain(score_documents(df, **kw).collect())
    want = plain(brute(rows, kw.get("order", 5)))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9, abs=1e-9)


def test_odd_documents(odd_docs, no_docs):
    check(odd_docs, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert score_documents(no_docs).count() == 0


@pytest.mark.parametrize("order, common", [(0, 1 << 18), (1, 40), (2, 0), (5, 400)])
def test_orders_over_small_blocks(spark, monkeypatch, order, common):
    """Many blocks; windows and words reach them by the join, by the table for all, or some by each."""
    monkeypatch.setattr(ppm, "COMMON", common)
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ppm, "WINDOWS_AT_ONCE", 64)
    rows = [(i, " ".join(f"w{(i * j) % 11} the{'É' * (j % 3)}" for j in range(i % 9))) for i in range(60)]
    rows += [(7, "the same"), (7, "the same"), (None, None), (3, "XYZ?\x0b~\x1c end"), (65, "never seen: \U0001F642 qqq")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, order=order)


def test_nothing_to_learn_from(spark):
    rows = [(i, f"text {i}") for i in range(40) if out_of(i)]
    assert rows
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_pieces_join_to_the_text():
    for text in (b"", b"a b", b"x" * 50, b"ab cd\tef gh " * 9, b"\t".join([b"abc"] * 30)):
        parts = list(ppm.pieces(text, 16))
        assert b"".join(parts) == text
        assert [w for p in parts for w in p.split()] == text.split()


def test_query_matches_brute_force(spark):
    from txflow.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got, want = plain(QUERIES["op12_lm_scoring"](spark, SF001).collect()), plain(brute(rows, 5))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(a[6] == pytest.approx(b[6], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-9) for a, b in zip(got, want))
    # texts it hasn't seen cost under half of what even bytes do
    size = {i: len((text or "").encode()) + 1 for i, text in rows}
    assert sum(r[6] for r in got if r[1]) > -0.5 * math.log10(257) * sum(size[r[0]] for r in got if r[1])


def test_small_batches(spark, monkeypatch):
    """Rows go to the workers by few bytes at a time, in the last step too, and the session keeps its own setting."""
    from txflow.llm import common
    seen, before = [], spark.conf.get(common.BATCH, None)
    saved = ppm.saved
    monkeypatch.setattr(ppm, "saved", lambda df, name, *a: seen.append((name, spark.conf.get(common.BATCH, None))) or saved(df, name, *a))
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(30)], "doc_id long, text string")
    out = score_documents(docs)
    assert out.count() == 30 and "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert {"ppm-blocks", "ppm-scores", "ppm-results"} <= {n for n, _ in seen} and {s for _, s in seen} == {"8m"}
    assert spark.conf.get(common.BATCH, None) == before


def test_windows_of_a_block_few_at_a_time(monkeypatch):
    import numpy as np
    texts = [b"abcabcabd" * 9, b"", b"zzz", b"abd" * 40]
    ends, held = np.cumsum([len(t) for t in texts]), np.array([False, False, True, False])
    whole = ppm.block_windows(b"".join(texts), ends, held, 3)
    monkeypatch.setattr(ppm, "WINDOWS_AT_ONCE", 7)
    sizes, joined = [], ppm._joined
    monkeypatch.setattr(ppm, "_joined", lambda parts: sizes.append(len(parts)) or joined(parts))
    few = ppm.block_windows(b"".join(texts), ends, held, 3)
    assert all((a == b).all() for a, b in zip(whole, few)) and max(sizes) <= 8

import random
import re
import textwrap

import pytest

from tests.conftest import SF001
from txflow.llm.licenses import FAMILIES, PHRASES, TEMPLATES, scan_licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(text, rows=None, threshold=0.8):
    """Every run of words that starts with a word of a notice, one after the other; 1.25 times the notice's words long."""
    w = words_of(text)
    places = sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    rows = rows or [(label, FAMILIES.get(label, label), n) for label, notices in TEMPLATES.items() for n in notices]
    fits = {}
    for label, family, notice in rows:
        given = words_of(notice)
        t = set(given)
        length = -(-5 * len(given) // 4)
        if len(t & set(w)) < threshold * len(t) - 1e-9:
            continue
        for i in range(len(w)):
            if w[i] in t:
                n = len(t & set(w[i:i + length]))
                if n >= threshold * len(t) - 1e-9:
                    fits.setdefault((family, i), []).append((-n / len(t), -len(t), label))
    won = [min(x) for x in fits.values()]
    labels = {x for _, x in places} | {label for _, _, label in won}
    return len(w), places, sorted(labels), 1.0 if places else max((-s for s, _, _ in won), default=0.0)


def check(df, rows=None, **kw):
    got = sorted(((r["doc_id"], r["n_words"], sorted(tuple(p) for p in r["places"]), r["labels"], r["score"])
                  for r in scan_licenses(df, **kw).collect()), key=repr)
    assert got == sorted(((r["doc_id"], *brute(r["text"], rows)) for r in df.collect()), key=repr)


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["labels"], r["score"]) for r in scan_licenses(df).collect()}


def test_odd_documents(odd_docs, no_docs):
    check(odd_docs)
    assert scan_licenses(no_docs).count() == 0


def test_templates_and_phrases(spark):
    bsd = TEMPLATES["bsd"][0]
    cut = bsd.split()
    texts = [bsd, "// " + bsd.upper(), " ".join(cut[:-2]), " ".join(cut[::2]), " ".join(reversed(cut)), bsd[:60] + "\n" + bsd[60:],
             "mit license MIT License mit\nlicense", "İmit license", "mit licenses", "mİt license", "cc by cc by-nc, CC-BY",
             TEMPLATES["mit"][0] + " and more\n" + TEMPLATES["cc-by-sa"][0], "gnu general public gnu general public license",
             "a " * 50_000 + TEMPLATES["gpl"][0], *[x for v in TEMPLATES.values() for x in v]]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


@pytest.mark.parametrize("width", [40, 70, 100])
def test_wrapped_notices_keep_their_label(spark, width):
    """Every notice, wrapped and commented, after other text."""
    given = [(label, n) for label, notices in TEMPLATES.items() for n in notices]
    texts = [f"Some code.\n\nint main;\n{textwrap.fill(n, width, initial_indent='# ', subsequent_indent='# ')}\nmore()" for _, n in given]
    found = scan(spark, texts)
    assert [label for i, (label, _) in enumerate(given) if label not in found[i][0]] == []
    assert all(found[i][1] == 1.0 for i in found)


def test_scattered_words_are_no_notice(spark):
    rnd = random.Random(4)
    texts = []
    for notices in TEMPLATES.values():
        for n in notices:
            texts.append(" ".join(w + "".join(f" filler{rnd.randint(0, 999)}" for _ in range(40)) for w in words_of(n)))
    assert all(labels == [] and score == 0 for labels, score in scan(spark, texts).values())


def test_the_most_similar_of_a_family_counts(spark):
    by, sa, nc = (TEMPLATES[x][0] for x in ("cc-by", "cc-by-sa", "cc-by-nc"))
    found = scan(spark, [by, sa, nc, by.lower() + ".\n" * 3 + "text " * 30 + sa, "x " + sa + " x", by[:70], TEMPLATES["lgpl"][0]])
    assert [found[i][0] for i in range(5)] == [["cc-by"], ["cc-by-sa"], ["cc-by-nc"], ["cc-by", "cc-by-sa"], ["cc-by-sa"]]
    assert found[6][0] == ["lgpl"]


def test_random_texts_and_a_table_of_templates(spark):
    rnd = random.Random(8)
    rows = [("one", "f", "alpha beta gamma delta epsilon"), ("two", "f", "alpha beta gamma delta epsilon zeta"),
            ("three", None, "Eta, eta; theta iota 9"), ("none", None, " .,"), ("four", "f", "alpha beta gamma delta omega")]
    words = "alpha beta gamma delta epsilon zeta eta theta iota omega x y z 9".split()
    texts = [" ".join(rnd.choice(words) + rnd.choice(["", "", "\n", "."]) for _ in range(rnd.randint(0, 40))) for _ in range(250)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    templates = spark.createDataFrame(rows, "label string, family string, notice string")
    check(df, [(a, b or a, c) for a, b, c in rows if words_of(c)], templates=templates)


def test_query_matches_brute_force_and_stays_native(spark):
    from txflow.llm.queries import op8_licenses

    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    out = op8_licenses(spark, SF001)
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in out.collect()} == {
        r["doc_id"]: (",".join(x[2]), x[3]) for r in rows for x in [brute(r["text"])]}
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()

import hashlib
import random
import re

import pytest

from tests.conftest import SF001
from txflow.llm.pii import KINDS, base_spans, find_personal_data
from txflow.llm.queries import op6_pii


def luhn(d):
    odd = [int(c) for c in d[::-1][::2]]
    even = [sum(divmod(2 * int(c), 10)) for c in d[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


# the kinds as plainly as they are stated
PLAIN = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
         (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(d := re.sub("[ -]", "", s)) <= 19 and luhn(d)),
         (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15)]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(PLAIN) for m in re.finditer(p, text) if ok(m.group()))


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_base_equals_the_plain_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("aZ0123456789@@..--+ ()%_é🙂") for _ in range(rng.randint(0, 40)))
        assert base_spans(text)[0] == brute(text), text
    for text in ("4929348385146306 4929348385146307", "a@b.c_d@e.f", "1.2.3.45.6.7.8", "+1 (301) 555-0346+1 (301) 555-0346"):
        assert base_spans(text)[0] == brute(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000, "1 " * 100_000):
        base_spans(text)


def test_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op6_pii(spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert set(joined(base).split(",")) <= set(r["spans"].split(","))


def test_odd_documents(odd_docs, no_docs):
    got = sorted(((r["doc_id"], [tuple(x) for x in r["base"]]) for r in find_personal_data(odd_docs).collect()), key=repr)
    assert got == sorted(((r["doc_id"], brute(r["text"] or "")) for r in odd_docs.collect()), key=repr)
    assert find_personal_data(no_docs).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    cards = ["4929348385146306", "4795522935961213", "4736962573099581", "4952935900253052", "2669109448945250"]
    texts = [f"customer card: {c} was used" for c in cards]
    texts += ["customer card: 9999-AB-1234 was used", "note: nothing here", "the number 77771234 stands alone",
              "card: 4929348385146307", "colour: 12345678", "colour: red", "colour: blue"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in find_personal_data(docs).collect()}
    assert found[5] == [(15, 2, 27)]                     # an unknown identifier in a trusted context
    assert not any(found[i] for i in range(6, len(texts)))   # a failed checksum, plain words, contexts without seeds
    assert all(found[i] == brute(texts[i]) for i in range(5))


def test_spaced_bracketed_and_digitless_identifiers(spark):
    seeds = [f"+1 (301) 555-{n}" for n in range(1000, 1020)]
    mails = [f"user{chr(97 + i)}@mail.example.com" for i in range(20)]
    texts = [f"please call me at {x} today" for x in seeds] + [f"home phone: {x}" for x in seeds]
    texts += [f"reach email: {x} now" for x in mails]
    new = [("please call me at {} today", "(555) 123-4567", 3), ("please call me at {} today", "555 123 4567", 3),
           ("please call me at {}", "301 555 0346", 3), ("home phone: {}", "(555) 987-6543", 3), ("home phone: {}", "555.987.6544", 3),
           ("reach email: {} now", "jane.doe@intranet", 0)]
    n = len(texts)
    texts += [t.format(x) for t, x, _ in new] + ["reach email: none now", "home phone: 12 no", "home phone: 77123456 2024"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in find_personal_data(docs).collect()}
    for i, (_, x, kind) in enumerate(new):
        start = texts[n + i].index(x)
        assert found[n + i] == [(start, kind, start + len(x))], texts[n + i]
    assert found[n + 6] == [] and found[n + 7] == [] and found[n + 8] == [(12, 3, 20)]


def test_chains_of_contexts_are_followed_to_their_end(spark):
    """Each hop: three new identifiers, each in three contexts of its own with the three that the hop before found."""
    known, texts, new = ["4929348385146306", "4795522935961213", "4736962573099581"], [], []
    for hop in range(5):
        fresh = [f"{hop}{g}77-AB-{hop}{g}34" for g in range(3)]
        for g, key in enumerate(fresh):
            for c in range(3):
                name = "field" + "abcde"[hop] + "xyz"[g] + "uvw"[c]
                texts += [f"{name}: {x} was used" for x in known]
                new.append((len(texts), len(name) + 2, len(key)))
                texts.append(f"{name}: {key} was used")
        known = fresh
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in find_personal_data(docs).collect()}
    assert [i for i, start, n in new if found[i] != [(start, 2, start + n)]] == []


@pytest.mark.parametrize("seeds", [30, 40_000])
def test_rounds_go_on_however_many_seeds_there_are(spark, seeds):
    """A chain of three looks in one context: one new instance among 40,000 moves the confidence by little, but its look
    admits the next."""
    texts = [f"login from: 10.{i % 200}.{i // 200 % 200}.{i // 40_000}" for i in range(seeds)]
    chain = ["ab-1234", "cd-12", "efgh1"]
    texts += [f"login from: {x}" for x in chain]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in find_personal_data(docs).filter(f"doc_id >= {seeds}").collect()}
    assert found == {seeds + i: [(12, 1, 12 + len(x))] for i, x in enumerate(chain)}


def plain_scores(edges, support=3, trust=0.7):
    """The graph scoring in plain Python: trusted (pattern, kind), found {instance: kind}."""
    seed, free, of = {}, {}, {}
    for pattern, instance, kind, is_free in edges:
        key = (pattern, instance)
        of.setdefault(pattern, set()).add(instance)
        seed[key] = kind if seed.get(key) is None else seed[key] if kind is None else max(seed[key], kind)
        free[key] = free.get(key, True) and is_free
    looks = {i: (len(i), sum(c in "0123456789" for c in i), any(c.isalpha() for c in i), "@" in i) for _, i in seed}
    seeds = {(i, k, 1.0) for (_, i), k in seed.items() if k is not None}
    known, states = set(seeds), []
    while True:
        trusted = {}
        for pattern, instances in of.items():
            for kind in range(4):
                held = [(i, s) for i, k, s in known if k == kind and i in instances]
                if len(held) < support:
                    continue
                conf = sum(s for _, s in held) / len(instances)
                if conf >= trust:
                    sizes, digits = [looks[i][0] for i, _ in held], [looks[i][1] for i, _ in held]
                    trusted[pattern, kind] = (conf, len(held), min(sizes), max(sizes), min(digits), any(looks[i][2] for i, _ in held),
                                              all(looks[i][3] for i, _ in held))
        chances = {}
        for (pattern, instance), kind_of_seed in seed.items():
            if not free[pattern, instance] or kind_of_seed is not None:
                continue
            size, digits, letters, at = looks[instance]
            for kind in range(4):
                if (pattern, kind) in trusted:
                    conf, _, short, long, few, lettered, all_at = trusted[pattern, kind]
                    if (size >= 6 and digits >= 4) or (short / 2 <= size <= long * 2 and digits >= few / 2
                                                       and (lettered or not letters) and at == all_at):
                        chances[instance, kind] = chances.get((instance, kind), 1.0) * max(1e-12, 1 - conf)
        best = {}
        for (instance, kind), left in chances.items():
            best[instance] = max(best.get(instance, (0.0, -9)), (1 - left, -kind))
        found = {i: (-k, s) for i, (s, k) in best.items() if s >= trust}
        known = seeds | {(i, k, s) for i, (k, s) in found.items()}
        state = ({p: (n, *shape, round(c, 6)) for p, (c, n, *shape) in trusted.items()}, {i: k for i, (k, _) in found.items()})
        if state in states:
            return set(trusted), state[1]
        states.append(state)


def test_graph_scoring_matches_a_plain_version(spark):
    from txflow.llm.pii import score_graph

    schema = "pattern string, instance string, kind int, free boolean"
    some = 0
    for seed in range(4):
        rng = random.Random(seed)
        names = [f"{'abc'[i % 3]}{rng.randint(10, 99999)}" if i % 2 else f"{rng.randint(1000, 9999999)}" for i in range(25)]
        kinds = {n: rng.choice([None, None, 0, 2]) for n in names}
        edges = [(f"p{rng.randint(0, 9)}", n, kinds[n], kinds[n] is None) for n in names for _ in range(rng.randint(1, 5))]
        edges += [("clean", n, 1, False) for n in ("10.0.0.1", "10.0.0.2", "10.0.0.3", "10.0.0.4")] + [("clean", "77-1234", None, True)]
        patterns, found = score_graph(spark.createDataFrame(edges, schema), rounds=None, support=3, trust=0.7)
        want = plain_scores(edges)
        assert {(r["pattern"], r["kind"]) for r in patterns.collect()} == want[0]
        assert {r["instance"]: r["kind"] for r in found.collect()} == want[1]
        some += len(want[1])
    assert some >= 4

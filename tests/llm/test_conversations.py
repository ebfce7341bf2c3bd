import hashlib
import itertools
import random
import re
import zlib

import pytest

from tests.conftest import SF001
from txflow.llm import conversations
from txflow.llm.conversations import repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string, sig string, chunk long, cost string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, 1, "x") for r in rows], SCHEMA)


def cheapest(rows):
    """(cost, audit, lines) by trying every edit, shortest paths over (rows used, grammar text so far)."""
    legal = re.compile(r"(s?(ua)+)?")
    best = {(0, ""): (0, "", [])}
    done = []

    def shorter(x):          # the grammar needs no more of the text than its last pair
        return x if len(x) <= 3 else x[:1].replace("u", "").replace("a", "") + ("ua" if (len(x.lstrip("s")) % 2 == 0) else "uau")

    for i in range(len(rows) + 1):
        for _ in range(3):   # inserts
            for (at, text), (cost, audit, lines) in list(best.items()):
                if at != i:
                    continue
                for role in ("user", "assistant"):
                    key = (i, shorter(text + role[0]))
                    new = (cost + 3, audit + "I", lines + [f"{role}:"])
                    if re.fullmatch(r"(s?(ua)*u?)?", text + role[0]) and (key not in best or new[:2] < best[key][:2]):
                        best[key] = new
        if i == len(rows):
            done = [v for (at, text), v in best.items() if at == i and legal.fullmatch(text)]
            break
        role, text_, fault = rows[i]
        for (at, text), (cost, audit, lines) in list(best.items()):
            if at != i:
                continue
            options = [(text, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                options.append((text + (role[:1] or "?"), extra, "K", [f"{role}:{text_}"]))
                options += [(text + r[0], extra + 3, "R", [f"{r}:{text_}"]) for r in ("user", "assistant")]
            for to, price, edit, line in options:
                key = (i + 1, shorter(to))
                new = (cost + price, audit + edit, lines + line)
                if re.fullmatch(r"(s?(ua)*u?)?", to) and (key not in best or new[:2] < best[key][:2]):
                    best[key] = new
    cost, audit, lines = min(done, key=lambda x: x[:2])
    return cost, audit, lines


def brute(rows, damage=True):
    out = []
    key = lambda x: (x is not None, x)
    for conv in sorted({r[0] for r in rows}, key=key):
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 19
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort(key=lambda r: (key(r[0]), r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          None if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, lines = cheapest([(r, t, f) for (_, r, t), f in zip(kept, faults)])
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def check(df, rows, damage=True):
    got = sorted((tuple(r) for r in repair_conversations(df, damage=damage).collect()), key=lambda r: (r[0] is not None, r[0]))
    assert got == brute(rows, damage)


def some_rows(n, seed):
    rnd = random.Random(seed)
    texts = ["hi.", "well", "what? ", "no!\n", "", " \t", None, "hi.", "é.", "a. b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(n)]:
        for _ in range(rnd.choice([1, 2, 3, 5, 8, 13])):
            rows.append((conv, rnd.choice([None, 0, 1, 2, 3, 5, 7, 9, 12]), rnd.choice(roles), rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("damage", [True, False])
def test_brute_force_over_odd_rows(spark, damage):
    rows = some_rows(60, 1)
    check(frame(spark, rows), rows, damage)


def test_conversations_in_many_slices(spark, monkeypatch):
    """One conversation holds most rows; slices of two rows."""
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 2)
    rows = some_rows(12, 2) + [(5, i, ["user", "assistant"][i % 2], f"text {i % 9}{'.' * (i % 4 > 0)}") for i in range(60)]
    rows += [(None, i % 4, "user", "same.") for i in range(30)]
    check(frame(spark, rows), rows)


def test_every_short_signature():
    """Costs and audits of all strings of four letters, in one automaton, against trying every edit."""
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    every = [x for n in range(5) for x in itertools.product("xsuaoSUAO", repeat=n)]
    every = sorted(("".join(x) for x in every), key=lambda s: s[::-1])
    for sig, cost, audit in itertools.islice(conversations.audits(iter(every)), 0, None, 7):
        rows = [(names.get(c.lower(), "user"), "t", "blank" if c == "x" else "truncated" if c.isupper() else None) for c in sig]
        assert (cost, audit) == cheapest(rows)[:2], sig


def test_states_are_shared_from_the_end(monkeypatch):
    made = []
    plain = conversations.best_edits
    monkeypatch.setattr(conversations, "best_edits", lambda *x: made.append(x[0]) or plain(*x))
    sigs = sorted(["suaua", "xuaua", "uaua", "aua", "Uaua"], key=lambda s: s[::-1])
    assert len(list(conversations.audits(iter(sigs)))) == 5
    assert len(made) == 7    # the path of uaua once, and one state for each of s, x and U before it


def test_no_rows_and_rows_that_all_go(spark):
    assert repair_conversations(frame(spark, []), damage=True).count() == 0
    gone = [(c, t, "user", "x.") for c in range(40) for t in range(4) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    check(frame(spark, gone), gone)


def test_query_over_the_table(spark):
    from txflow.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_conversations"](spark, SF001).collect())
    assert got == brute(rows)

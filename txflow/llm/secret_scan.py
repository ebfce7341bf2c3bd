"""Secret scan: credential patterns, and sliding-window Shannon entropy of candidate strings.

A candidate is a run of the base-64 alphabet, or of hexadecimal digits inside one. A window slides over it; the
counts of its characters and the sum of c * log2(c) are updated for the character that enters and the one that leaves, so
the entropy is never computed anew (a step still copies the counts of the alphabet, as DataFrame arrays don't change in
place). A run whose best window reaches the threshold of its character class is a secret unless the allow list
knows it. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import text_of

# fixed values: kinds in the order in which equal starts are listed; the patterns of the first three
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
HEX_DIGITS = "0123456789abcdefABCDEF"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
RUN = r"[A-Za-z0-9+/=_-]{20,}"
HEX_RUN = r"[0-9a-fA-F]{20,}"
# pairs of letters that words of the corpus's languages hardly hold; three close together (odd) are no words
ODD_PAIR = (
    r"(?i:a[aoq]|b[cdfghkmnpqvwxz]|c[bdfgjmnpqvwxz]|d[bcfkpqtxz]|f[bcdghjkmnpqvwxz]|g[bcdfjkpqvwxz]|h[bcdfghjkpqsvxz]"
    r"|i[ijqwy]|j[b-df-hj-np-tv-z]|k[bcdfghjmpqvxz]|l[hjnqrwxz]|m[cdfghjkqrtvwxz]|n[qrwx]|o[hjqz]|p[bcdgjkmqvwxz]"
    r"|q[a-tv-z]|r[jqwxz]|s[bdgjrvxz]|t[bdfgjkpqvx]|u[jquvwy]|v[b-df-hj-np-qs-tv-xz]|w[bcfgjkmpqtu-z]"
    r"|x[bdfgj-mnoq-suv-wyz]|y[bfghjkqv-z]|z[bcdfghjkmnp-svx])")
ODD = rf"{ODD_PAIR}.{{0,6}}{ODD_PAIR}.{{0,6}}{ODD_PAIR}"
WORDS = rf"(?!.*{ODD})"
# what tells a run's class, and the least entropy of a window in bits per character: 1 random key in 100 of 20
# characters of the class is under it. Beside hexadecimal digits only runs with such a pair
# (mixed: odd runs) are held to it, others to ANY_CLASS
CLASSES = {"hex": (r"^[0-9a-fA-F]+$", 2.87), "one case": (r"^(?:[A-Z0-9]+|[a-z0-9]+)$", 3.4), "mixed": (r"", 3.64)}
ANY_CLASS = 3.9
# placeholders: no secret where they are half of a run or more
PLACEHOLDER = r"(?i:example|sample|placeholder|changeme|dummy|redacted|x{6,}+|0{8,}+|12345678(?:90?)?|abcdefgh)"
# known to be no secret: words or numbers joined by marks, numbered words joined by marks.
# Possessive, so that a run of any length is read once
ALLOWED = (
    rf"^{WORDS}[A-Za-z/+=_-]*+$",
    r"^[0-9/+=_-]*+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    rf"^{WORDS}(?:[A-Za-z]++[0-9]{{0,4}}+|[0-9]{{1,4}}+)(?:[-_/+=]++(?:[A-Za-z]++[0-9]{{0,4}}+|[0-9]{{1,4}}+))++$",
)
# of what is left of a run beside a base span: marks at its ends, a single numbered word
MARKS_AROUND = r"^[-_/+=]++|[-_/+=]++$"
ONE_WORD = rf"^{WORDS}[A-Za-z]++[0-9]{{0,4}}+$"
AT_ONCE = 512            # items of one fold: appending copies, so a fold over all items would be quadratic
WINDOWS_AT_ONCE = 8192   # windows of a long run that are looked at in one fold

SPAN = "struct<start:bigint,kind:int,end:bigint>"
NONE = f"array<{SPAN}>"


def _empty(kind: str = NONE) -> Column:
    return F.array().cast(kind)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; a lambda would compute the expression anew for each item."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """``items`` (a variable or column) in arrays of AT_ONCE."""
    firsts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(AT_ONCE))).otherwise(_empty("array<int>"))
    return F.transform(firsts, lambda i: F.slice(items, i, F.lit(AT_ONCE)))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """(at, before): all ``values`` (bigint) combined from 0 on, and for each value those before it combined."""
    start = F.struct(F.lit(0).cast("long").alias("at"), _empty("array<bigint>").alias("before"))
    return F.aggregate(values, start, lambda acc, x: F.struct(
        combine(acc["at"], x).alias("at"), F.array_append(acc["before"], acc["at"]).alias("before")))


def _before(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` those before it combined: block by block, then with the blocks before."""
    def moved(blocks: Column) -> Column:
        totals = _running(F.transform(blocks, lambda b: b["at"]), combine)
        return F.flatten(F.zip_with(blocks, totals["before"], lambda b, by: F.transform(b["before"], lambda x: combine(x, by))))

    return _let(F.transform(_blocks(values), lambda b: _running(b, combine)), moved)


def _sums_before(sizes: Column) -> Column:
    return _before(sizes, lambda x, y: x + y)


def _placed(text: Column, pattern: str) -> Column:
    """(start, match) of every match in order: the text between matches and the matches are laid end to end."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.zip_with(F.split(text, pattern, -1), matches, lambda g, m: F.struct(
        F.length(g).cast("long").alias("gap"), m.alias("match"))), lambda p: p["match"].isNotNull())

    def placed(steps: Column) -> Column:
        return _let(F.transform(steps, lambda p: p["gap"] + F.length(p["match"])), lambda sizes: F.zip_with(
            steps, _sums_before(sizes), lambda p, before: F.struct((before + p["gap"]).alias("start"), p["match"].alias("match"))))

    return _let(pairs, placed)


def _span(place: Column, kind: str) -> Column:
    return F.struct(place["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                    (place["start"] + F.length(place["match"])).alias("end"))


def _spans(text: Column, pattern: str, kind: str, fits: Callable[[Column], Column]) -> Column:
    found = F.transform(F.filter(_placed(text, pattern), fits), lambda p: _span(p, kind))
    return F.when(text.rlike(pattern), found).otherwise(_empty())


def _outside(place: Column, spans: Column) -> Column:
    """(start, end) of the parts of a place that lie outside ``spans`` (blocks with their first start and last end), in
    order."""
    beyond = place["start"] + F.length(place["match"])
    touched = F.flatten(F.transform(
        F.filter(spans, lambda b: (b["first"] < beyond) & (place["start"] < b["beyond"])),
        lambda b: F.filter(b["spans"], lambda s: (s["start"] < beyond) & (place["start"] < s["end"]))))

    def parts(own: Column) -> Column:
        ends = F.transform(own, lambda s: s["end"])
        gaps = F.zip_with(own, _before(ends, F.greatest), lambda s, e: F.struct(
            F.greatest(e, place["start"]).alias("start"), s["start"].alias("end")))
        last = F.struct(F.greatest(place["start"], F.array_max(ends)).alias("start"), beyond.alias("end"))
        return F.filter(F.concat(gaps, F.array(last)), lambda p: p["start"] < p["end"])

    return _let(touched, parts)


def _run_spans(place: Column, spans: Column) -> Column:
    """Entropy spans of the parts of a run that lie outside the base spans it touches: the part if it is rich, else
    its hexadecimal runs that are.

    Every window that reaches into a part counts, so a short rest of a key is found by the windows that it
    shares with the span beside it. Marks at a cut part's ends don't keep it from the allow list.
    """
    beyond, reach = place["start"] + F.length(place["match"]), WINDOW - 1

    def cut(start: Column, end: Column) -> Column:
        return F.substring(place["match"], (start - place["start"] + 1).cast("int"), (end - start).cast("int"))

    def entropy_span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), end.alias("end"))

    def known(p: Column) -> Column:
        own = cut(p["start"], p["end"])
        rest = _let(F.regexp_replace(own, MARKS_AROUND, ""), lambda w: (w == "") | w.rlike(ONE_WORD) | _allowed(w))
        return F.when(p["end"] - p["start"] == F.length(place["match"]), _allowed(own)).otherwise(rest)

    def judged(p: Column) -> Column:
        first = F.greatest(p["start"] - reach, place["start"])

        def of(near: Column) -> Column:
            hexes = F.transform(F.filter(_placed(near, HEX_RUN), lambda h: ~_allowed(h["match"]) & _rich(h["match"])), lambda h: entropy_span(
                F.greatest(first + h["start"], p["start"]), F.least(first + h["start"] + F.length(h["match"]), p["end"])))
            return F.when(~known(p) & _rich(near), F.array(entropy_span(p["start"], p["end"]))).when(
                near.rlike(HEX_RUN), F.filter(hexes, lambda s: s["start"] < s["end"])).otherwise(_empty())

        return _let(cut(first, F.least(p["end"] + reach, beyond)), of)

    return F.flatten(F.transform(_outside(place, spans), judged))


def _c_log_c(most: int) -> Column:
    return F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(most + 1)])


def window_entropy(run: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of a window of ``window`` characters of ``run``.

    ``run`` holds characters of ``alphabet`` only and is at least as long as the window.
    """
    def paired(numbers: Column) -> Column:
        late = F.slice(F.concat(F.array_repeat(F.lit(-1), window), numbers), F.lit(1), F.size(numbers))
        return F.zip_with(numbers, late, lambda e, x: F.struct(e.alias("enters"), x.alias("leaves")))

    moves = _let(F.transform(F.split(run, ""), lambda c: F.instr(F.lit(alphabet), c) - 1), paired)
    f = _c_log_c(window)
    state = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(float("inf")).alias("least"), F.lit(0).alias("at"))

    def put(counts: Column, number: Column, by: int) -> Column:
        return F.transform(counts, lambda c, i: F.when(i == number, c + by).otherwise(c))

    def step(acc: Column, move: Column) -> Column:
        enters, leaves = move["enters"], move["leaves"]
        full = leaves >= 0
        gone = F.coalesce(F.get(acc["counts"], leaves), F.lit(0))
        less = F.when(full, F.get(f, gone) - F.get(f, gone - 1)).otherwise(0.0)
        counts = F.when(full, put(acc["counts"], leaves, -1)).otherwise(acc["counts"])
        had = F.get(acc["counts"], enters) - F.when(leaves == enters, 1).otherwise(0)
        total = acc["sum"] - less + F.get(f, had + 1) - F.get(f, had)
        at = acc["at"] + 1
        return F.struct(put(counts, enters, 1).alias("counts"), total.alias("sum"),
                        F.when(at >= window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"),
                        at.alias("at"))

    return F.lit(math.log2(window)) - F.aggregate(moves, state, step)["least"] / window


def _allowed(run: Column) -> Column:
    rest = F.regexp_replace(run, PLACEHOLDER, "")
    out = (F.length(run) > 0) & (2 * F.length(rest) <= F.length(run))
    for pattern in ALLOWED:
        out = out | run.rlike(pattern)
    return out


def _rich(run: Column) -> Column:
    """Has the run a window that reaches its class's threshold? Long runs are cut so that every window is in one part."""
    firsts = F.sequence(F.lit(1), F.length(run) - (WINDOW - 1), F.lit(WINDOWS_AT_ONCE))

    def reaches(alphabet: str, least: Column) -> Column:
        return F.exists(firsts, lambda at: window_entropy(
            F.substring(run, at, F.lit(WINDOWS_AT_ONCE + WINDOW - 1)), alphabet) >= least)

    (only_hex, hex_least), (one_case, one_least), (_, least) = CLASSES.values()
    by_class = F.when(run.rlike(one_case), F.when(run.rlike(ODD_PAIR), one_least)).when(run.rlike(ODD), least)
    by_class = F.coalesce(by_class, F.lit(ANY_CLASS))
    return F.when(run.rlike(only_hex), reaches(HEX_DIGITS, F.lit(hex_least))).otherwise(reaches(BASE64, by_class))


def with_spans(docs: DataFrame, text_col: str, base_col: str, spans_col: str) -> DataFrame:
    """``docs`` with the base spans and all spans, arrays of (start, kind, end) in order of start and kind.

    Of a candidate run the parts outside base spans are judged, and the hexadecimal runs in them. A null text is
    empty. Work grows evenly with the length of a text and of its runs, but for one look at each block of AT_ONCE base
    spans per candidate.
    """
    text = text_of(F.col(text_col))
    base = F.array_sort(F.concat(
        _spans(text, ASSIGN, "assign", lambda p: F.length(F.regexp_extract(p["match"], ASSIGN, 1)) >= 6),
        _spans(text, ACCESS, "access", lambda p: F.lit(True)),
        _spans(text, HEX, "hex", lambda p: F.lit(True))))
    out = docs.withColumn(base_col, base)
    known = F.transform(_blocks(F.col(base_col)), lambda b: F.struct(
        b[0]["start"].alias("first"), F.array_max(F.transform(b, lambda s: s["end"])).alias("beyond"), b.alias("spans")))

    def fresh(blocks: Column) -> Column:
        return F.flatten(F.transform(_placed(text, RUN), lambda p: _run_spans(p, blocks)))

    return out.withColumn(spans_col, F.when(
        text.rlike(RUN), F.array_sort(F.concat(F.col(base_col), _let(known, fresh)))).otherwise(F.col(base_col)))


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base and spans, arrays of (start, kind, end) in code points, end exclusive.

    Null texts are empty and have no spans. Null and repeated ids stay rows of their own, an empty table gives no
    rows, other columns are not read. Nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_spans(rows, "text", "base", "spans").select(F.col("id").alias(id_col), "base", "spans")


def redact(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; overlapping spans become one mark.

    No row goes. ``length_col``, if there is one, is set anew where the text changed. Columns as they were.
    """
    names = {c.lower() for c in docs.columns}
    base, spans = "secret_base", "secret_spans"
    while base in names or spans in names:
        base, spans = base + "_", spans + "_"
    found = with_spans(docs, text_col, base, spans)
    text = F.col(text_col)

    def masked(block: Column, first: Column) -> Column:
        """The text from ``first`` to the last end of the block's spans, marks in place of the spans."""
        start = F.struct(first.alias("at"), _empty("array<string>").alias("parts"))

        def fold(own: Column) -> Column:
            def step(acc: Column, s: Column) -> Column:
                clear = F.concat(F.substring(own, (acc["at"] - first + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
                return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(
                    s["start"] >= acc["at"], F.array_append(acc["parts"], clear)).otherwise(acc["parts"]).alias("parts"))

            return F.array_join(F.aggregate(block, start, step)["parts"], "")

        long = (F.array_max(F.transform(block, lambda s: s["end"])) - first).cast("int")
        return _let(F.substring(text, (first + 1).cast("int"), long), fold)

    def joined(blocks: Column) -> Column:
        ends = _running(F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: s["end"]))), F.greatest)
        return _let(ends, lambda e: F.concat(
            F.array_join(F.zip_with(blocks, e["before"], masked), ""),
            F.substring(text, (e["at"] + 1).cast("int"), F.lit(2147483647))))

    clean = _let(_blocks(F.col(spans)), joined)
    changed = F.size(spans) > 0
    out = {text_col: F.when(changed, clean).otherwise(text)}
    result = found.withColumn(text_col, out[text_col])
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        result = result.withColumn(length_col, F.when(changed, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return result.select(*docs.columns)

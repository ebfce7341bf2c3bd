"""Personal data: patterns for four kinds, extended by bootstrapped contextual extraction.

Entities that the patterns find are seeds. The words before a seed (``ssn: _``, ``customer id # _``,
``call me at _``) are lexical patterns; every filler of such a context in the corpus is an instance.
Spark scores the graph of patterns and instances in rounds: a pattern is trusted by the share of its
distinct fillers that are known, an unknown identifier by the trusted patterns that it stands in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import saved

# fixed values: kinds in the order in which equal starts are listed
KINDS = ("email", "ip", "card", "phone")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

BACK = 100               # characters before an entity in which its context is read
LONGEST = 64             # characters of a filler; a longer one is no identifier
FILLER = re.compile(r"[^\s\"'<>()\[\],;|]+")
# digit groups with blanks, dots, hyphens and brackets between them, and what follows without a blank
GROUPS = re.compile(r"[(\[]?[0-9]{1,7}(?:[)\]]?[ .\-]{0,2}[(\[]?(?<![0-9])[0-9]{1,7})+(?![0-9])[^\s\"'<>()\[\],;|]*")
FIELD = re.compile(r"(?:(\w+)[ \t]+)?(\w+)[ \t]*([:=#])[ \t]*[\"'(<\[]?$")
PHRASE = re.compile(r"(\w+)[ ,\t]+(\w+)[ ,\t]+(\w+)[ \t]+$")
MARK = re.compile(r"[:=#][ \t]*[\"'(<\[]?")
DIGITS = re.compile(r"[0-9]+")
PLACE = re.compile(r"[0-9]+|@")   # no identifier without one


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: the name runs back to the last match or unfit character."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        else:
            free = at + 1   # no later name reaches over this @
        at = text.find("@", free)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind, end) of every entity in order, spans that fit a pattern but fail its check)."""
    found: list[tuple[int, int, int]] = []
    failed: list[tuple[int, int]] = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if DIGITS.search(text):
        if "." in text:
            for m in IP.finditer(text):
                fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())
                found.append((m.start(), 1, m.end())) if fits else failed.append(m.span())
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19:
                found.append((m.start(), 2, m.end())) if _luhn(digits) else failed.append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                fits = 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15
                found.append((m.start(), 3, m.end())) if fits else failed.append(m.span())
    return sorted(found), failed


def contexts(text: str, start: int) -> list[str]:
    """The lexical patterns of the place ``start``: a field name with its mark, or the three words before."""
    left = text[max(0, start - BACK):start]
    m = FIELD.search(left)
    if m:
        name = f"{m[2]}{m[3]}".lower()
        words = [name, f"{m[1].lower()} {name}"] if m[1] else [name]
    else:
        m = PHRASE.search(left)
        words = [" ".join(m.groups()).lower()] if m else []
    return [re.sub(r"[0-9]", "0", w) for w in words]


def _digits(filler: str) -> int:
    return sum("0" <= c <= "9" for c in filler)


def _groups(text: str, start: int) -> int:
    """The end of a spaced or bracketed number that starts at ``start``, or -1. A first token that is a whole
    identifier (6 digits, or 8 with marks) takes in no further group."""
    m = GROUPS.match(text, start, start + LONGEST + 1)
    if not m or m.end() - start > LONGEST or not 7 <= _digits(m.group()) <= 15:
        return -1
    first = FILLER.match(text, start)
    if first and (_digits(first.group()) >= 8 or (len(first.group()) >= 6 and DIGITS.fullmatch(first.group()))):
        return -1
    return m.end()


def mentions(text: str, base: list[tuple[int, int, int]], failed: list[tuple[int, int]]) -> list[dict]:
    """Fillers of a context: seeds (with their kind), and others, which speak against a pattern until they are found
    (free: short enough to be). What failed a kind's check speaks against it too and is never found."""
    taken = sorted([(s, e) for s, _, e in base] + failed)
    out = []

    def add(start: int, end: int, kind: int | None, free: bool) -> None:
        patterns = contexts(text, start)
        if patterns:
            out.append({"start": start, "end": end, "kind": kind, "free": free,
                        "instance": text[start:end].lower()[:LONGEST], "patterns": patterns})

    for s, kind, e in base:
        add(s, e, kind, False)
    for s, e in failed:
        add(s, e, None, False)
    places = set()
    for m in MARK.finditer(text):
        places.add(m.end())
    for m in PLACE.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < LONGEST and FILLER.match(text[start - 1]):
            start -= 1
        places.add(start)
    at, beyond = 0, -1
    for start in sorted(places):
        if start < beyond:
            continue
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        clear = taken[at][0] if at < len(taken) else len(text)
        opened = start - 1 if start > beyond and start and text[start - 1] in "([" else start
        for first, last in ((opened, _groups(text, opened)), (start, _groups(text, start))):
            if 0 <= last <= clear and (at == 0 or taken[at - 1][1] <= first):
                break
        else:
            m = FILLER.match(text, start, start + LONGEST + 1)
            first, last = start, m.end() if m else start
        end = first + len(text[first:last].rstrip(".:!?"))
        if end > first and end <= clear:
            add(first, end, None, end - first <= LONGEST)
            beyond = end
    return out


def extract(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: id, base (start, kind, end), mentions."""
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                         T.StructField("end", T.LongType())])
    mention = T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.IntegerType()),
        T.StructField("free", T.BooleanType()), T.StructField("instance", T.StringType()),
        T.StructField("patterns", T.ArrayType(T.StringType()))])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("base", T.ArrayType(span)),
                           T.StructField("mentions", T.ArrayType(mention))])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    mention_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                                       ("free", pa.bool_()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, fillers = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base, failed = base_spans(text)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                fillers.append(mentions(text, base, failed))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, span_type), pa.array(fillers, mention_type)],
                names=["id", "base", "mentions"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(found, schema)


def score_graph(edges: DataFrame, *, rounds: int | None, support: int, trust: float) -> tuple[DataFrame, DataFrame]:
    """(trusted patterns: pattern, kind, conf; found instances: instance, kind, score) of the distinct edges
    (pattern, instance, kind of a seed or null, free). A pattern also tells how its known instances look.
    Rounds end when one leaves the patterns (with the number and looks of their known instances and their confidence to
    6 digits) and the found instances as an earlier one had them, which must come, or after ``rounds``."""
    text = F.col("instance")
    looks = {"size": F.length(text), "digits": F.length(F.regexp_replace(text, "[^0-9]", "")),
             "letters": text.rlike(r"\p{L}"), "at": text.contains("@")}
    edges = saved(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("seed"), F.bool_and("free").alias("free"))
                  .withColumns(looks), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("fillers"))
    seeds = edges.filter("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    # an identifier has 4 digits and 6 characters, or looks like what is known of the pattern
    shape = ["short", "long", "few", "lettered", "all_at"]
    alike = F.expr("(size >= 6 and digits >= 4) or (size between short / 2 and long * 2 and digits >= few / 2"
                   " and (lettered or not letters) and at = all_at)")
    known, patterns, found, states = seeds, None, None, set()
    while rounds is None or len(states) < rounds:
        held = (edges.select("pattern", "instance", *looks).join(known, "instance").groupBy("pattern", "kind")
                .agg(F.sum("score").alias("score"), F.count("*").alias("n"), F.min("size").alias("short"), F.max("size").alias("long"),
                     F.min("digits").alias("few"), F.bool_or("letters").alias("lettered"), F.bool_and("at").alias("all_at"))
                .filter(F.col("n") >= support))
        patterns = saved(held.join(sizes, "pattern").withColumn("conf", F.col("score") / F.col("fillers"))
                         .filter(F.col("conf") >= trust).select("pattern", "kind", "conf", "n", *shape), "pii-patterns")
        chances = (edges.filter("free and seed is null").join(patterns, "pattern").filter(alike).groupBy("instance", "kind")
                   .agg((1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("conf")))))).alias("score")))
        best = chances.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("order"))).alias("won"))
        found = saved(best.select("instance", (-F.col("won.order")).alias("kind"), F.col("won.score").alias("score"))
                      .filter(F.col("score") >= trust), "pii-found")
        known = seeds.unionByName(found)
        state = (*patterns.agg(F.count("*"), F.bit_xor(F.xxhash64("pattern", "kind", "n", *shape, F.round("conf", 6)))).first(),
                 *found.agg(F.count("*"), F.bit_xor(F.xxhash64("instance", "kind"))).first())
        if state in states:
            break
        states.add(state)
    return patterns, found


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       rounds: int | None = None, support: int = 3, trust: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id, base and spans, both arrays of (start, kind, end) in order of start and kind.

    ``base`` are the entities of the patterns, ``spans`` these and the identifiers that trusted contexts add
    (kind: index into KINDS; code points, end exclusive). A pattern is trusted for a kind if at least ``support``
    distinct known instances fill it and they are ``trust`` of all its distinct fillers; an identifier is added
    where it stands in a trusted pattern and its own score reaches ``trust``. Rounds go on until nothing new is
    found, or up to ``rounds``.

    A null text is empty and has no spans. Null and repeated ids stay rows of their own, an empty table gives no
    rows, other columns are not read. The text is read once; the graph holds only fillers of contexts, counted
    per distinct (pattern, instance) before they meet, so a context that fills a third of all rows is one count.
    """
    rows = saved(extract(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    places = (rows.select("row", F.explode("mentions").alias("m"))
              .select("row", "m.start", "m.end", "m.kind", "m.free", "m.instance", F.explode("m.patterns").alias("pattern")))
    patterns, found = score_graph(places.select("pattern", "instance", "kind", "free"),
                                  rounds=rounds, support=support, trust=trust)
    added = (places.filter("free and kind is null").select("row", "start", "end", "instance", "pattern")
             .join(found.select("instance", "kind"), "instance").join(patterns.select("pattern", "kind"), ["pattern", "kind"])
             .groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
             .withColumnRenamed("row", "a_row"))
    out = rows.join(added, F.col("row") == F.col("a_row"), "left")
    return out.select(F.col("id").alias(id_col), "base",
                      F.when(F.col("added").isNull(), F.col("base")).otherwise(
                          F.array_sort(F.concat("base", "added"))).alias("spans"))


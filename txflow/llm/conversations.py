"""Conversation structure repair by a suffix-shared automaton of row signatures.

A row's signature is one letter: its role's initial and its fault. A conversation is the string of its
letters. The strings of all conversations, each once, are dealt and sorted by their reversal, so that those
with a common end stand together: their states from the end on are one path, kept as a stack, and the
cost-to-go and best next edit of each state are computed once for the four states of the role grammar
``(s?(ua)+)?``. Conversations take cost and audit from the string they have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import saved

WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20      # a slice of a conversation that is one row
LEGAL = {"su", "ua", "au"}
# states of the grammar: 0 at the start, 1 after s, 2 after u, 3 after a; a pair ends in 3
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
TARGET = (2, 2, 3, 2)                         # where an insert or a rerole leads: to u, after u to a
LINE = {2: "user", 3: "assistant"}
RETYPE, INSERT, DELETE, CUT = 3, 3, 4, 3
END_COST, END_EDIT = (0, 6, 3, 0), (None, "I", "I", None)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv, turn, role, text after the damage that crc32(``conv:turn``) % 20 names (nulls: one space):
    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes the role user."""
    def or_space(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    conv, turn = F.col(conv_col), F.col(turn_col)
    kind = F.crc32(F.concat(or_space(conv), F.lit(":"), or_space(turn)).cast("binary")) % 20
    role, text = or_space(F.col(role_col)), or_space(F.col(text_col))
    out = rows.select(
        conv.alias("conv"), turn.alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"),
        kind.alias("kind"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return out.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).drop("kind", "copy")


def letter(role: str, text: str, seen: bool) -> str:
    """b blank, d duplicate, else the role's initial (o: any other), upper-case if the text is cut off."""
    bare = text.rstrip(WHITE)
    if not bare:
        return "b"
    if seen:
        return "d"
    first = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return first if bare.endswith(ENDS) else first.upper()


def _chunks(rows: DataFrame) -> DataFrame:
    """Slices of conversations in order: conv, sig, digests, roles, texts, and what two slices that follow tell of
    each other. Rows of a conversation may lie in many tasks; ``chunk`` grows along a conversation."""
    kind, turn_kind = rows.schema["conv"].dataType, rows.schema["turn"].dataType
    schema = T.StructType([
        T.StructField("conv", kind), T.StructField("sig", T.StringType()), T.StructField("digests", T.ArrayType(T.BinaryType())),
        T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("illegal", T.LongType()), T.StructField("turns", T.LongType()),
        T.StructField("first_turn", turn_kind), T.StructField("last_turn", turn_kind)])

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, held, chars, size = None, [], 0, 0
        conv, turns, roles, texts, fresh = None, [], [], [], True

        def close() -> None:
            nonlocal size
            seen: set[bytes] = set()
            sig, digests = [], []
            for role, text in zip(roles, texts):
                digest = xxhash.xxh128_digest(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"))
                sig.append(letter(role, text, digest in seen))
                seen.add(digest)
                digests.append(digest)
            told = [t for t in turns if t is not None]
            held.append((conv, "".join(sig), digests, list(roles), list(texts),
                         sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:])),
                         sum(a != b for a, b in zip(told, told[1:])) + bool(told),
                         told[0] if told else None, told[-1] if told else None))
            size += chars

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

        for batch in batches:
            if arrow is None:
                given = {f.name: f.type for f in batch.schema}
                texts_type = pa.list_(pa.string())
                arrow = pa.schema([("conv", given["conv"]), ("sig", pa.string()), ("digests", pa.list_(pa.binary())),
                                   ("roles", texts_type), ("texts", texts_type), ("illegal", pa.int64()), ("turns", pa.int64()),
                                   ("first_turn", given["turn"]), ("last_turn", given["turn"])])
            for c, t, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if not fresh and (c != conv or len(roles) == CHUNK_ROWS or chars > CHUNK_CHARS):
                    close()
                    turns, roles, texts, chars, fresh = [], [], [], 0, True
                    if len(held) == 2048 or size > 4 * CHUNK_CHARS:
                        yield flushed()
                        held, size = [], 0
                conv, fresh = c, False
                turns.append(t)
                roles.append(role)
                texts.append(text)
                chars += len(text)
        if not fresh:
            close()
            yield flushed()

    order = ["conv", "turn", "role"]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    chunks = dealt.select("conv", "turn", "role", "text").mapInArrow(sliced, schema)
    return chunks.withColumn("chunk", F.monotonically_increasing_id())


def _mark_repeats(chunks: DataFrame) -> DataFrame:
    """chunk, sig with the rows that repeat one of an earlier slice; only slices that have such rows."""
    many = (chunks.groupBy("conv").agg(F.count("*").alias("n"), F.first("conv").alias("c"))
            .filter("n > 1").select(F.col("c").alias("m_conv")))
    rows = (chunks.join(many, F.col("conv").eqNullSafe(F.col("m_conv")), "left_semi")
            .select("conv", "chunk", F.posexplode("digests").alias("at", "digest"))
            .groupBy("conv", "chunk", "digest").agg(F.min("at").alias("at")))
    firsts = (rows.groupBy("conv", "digest").agg(F.min("chunk").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select(F.col("conv").alias("f_conv"), F.col("digest").alias("f_digest"), "first"))
    late = (rows.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("digest") == F.col("f_digest")))
            .filter("chunk > first").groupBy("chunk").agg(F.collect_set("at").alias("late")))
    late = late.select(F.col("chunk").alias("l_chunk"), "late")
    letters = F.transform(F.split("sig", ""), lambda x, i: F.when(F.array_contains("late", i) & (x != "b"), F.lit("d")).otherwise(x))
    return (chunks.select("chunk", "sig").join(late, F.col("chunk") == F.col("l_chunk"))
            .select(F.col("chunk").alias("l_chunk"), F.array_join(letters, "").alias("l_sig")))


def best_edits(symbol: str, after: tuple) -> tuple:
    """(costs, edits) of the state before ``symbol`` for every grammar state, from those of the state after it.
    Of equal costs the edit of the least letter wins; each edit leads to one grammar state, so audits that tie
    differ in this letter."""
    ahead = after[0]
    cost, edit = [0] * 4, [""] * 4
    role, cut = symbol.lower(), CUT if symbol.isupper() else 0
    for s in range(4):
        best = (DELETE + ahead[s], "D")
        if symbol != "x":
            if (s, role) in STEP:
                best = min(best, (cut + ahead[STEP[s, role]], "K"))
            best = min(best, (cut + RETYPE + ahead[TARGET[s]], "R"))
        cost[s], edit[s] = best
    u, a = (cost[2], edit[2]), (cost[3], edit[3])
    (cost[2], edit[2]), (cost[3], edit[3]) = min(u, (a[0] + INSERT, "I")), min(a, (u[0] + INSERT, "I"))
    for s in (0, 1):
        cost[s], edit[s] = min((cost[s], edit[s]), (cost[2] + INSERT, "I"))
    return tuple(cost), tuple(edit)


def moved(edit: str, state: int, symbol: str) -> int:
    """The grammar state after an edit."""
    return state if edit == "D" else STEP[state, symbol.lower()] if edit == "K" else TARGET[state]


def audits(signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(signature, cost, audit) of signatures that come in the order of their reversals."""
    path, last = [(END_COST, END_EDIT)], ""     # states by their distance from the end
    for sig in signatures:
        back = sig[::-1]
        same = 0
        while same < min(len(back), len(last)) and back[same] == last[same]:
            same += 1
        del path[same + 1:]
        for symbol in back[same:]:
            path.append(best_edits(symbol, path[-1]))
        last, state, left, made = back, 0, len(sig), []
        while (edit := path[left][1][state]) is not None:
            made.append(edit)
            state = moved(edit, state, sig[-left] if left else "")
            left -= edit != "I"
        yield sig, path[-1][0][0], "".join(made)


def _solve(signatures: DataFrame) -> DataFrame:
    """sig, cost, audit of every distinct signature."""
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> Iterator[str]:
            for batch in batches:
                yield from batch.column(0).to_pylist()

        held, size = [], 0
        for found in audits(given()):
            held.append(found)
            size += len(found[0])
            if size > CHUNK_CHARS or len(held) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=["sig", "cost", "audit"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=["sig", "cost", "audit"])

    back = signatures.distinct().withColumn("back", F.reverse("sig"))
    return (back.repartitionByRange(F.substring("back", 1, 256), F.xxhash64("back")).sortWithinPartitions("back")
            .select("sig").mapInArrow(solved, "sig string, cost long, audit string"))


def _segments(convs: DataFrame) -> DataFrame:
    """chunk, edits, state: the part of its conversation's audit that belongs to a slice, and the grammar state before
    it. Inserts stand before the row that follows them, the last ones in the last slice."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for sig, audit, chunks, sizes in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                row, at, state = 0, 0, 0
                for n, (chunk, size) in enumerate(zip(chunks, sizes)):
                    begin, before, end, whole = at, state, row + size, n == len(chunks) - 1
                    while at < len(audit) and (row < end or whole):
                        edit = audit[at]
                        state = moved(edit, state, sig[row] if edit != "I" else "")
                        row += edit != "I"
                        at += 1
                    out[0].append(chunk)
                    out[1].append(audit[begin:at])
                    out[2].append(before)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                                              pa.array(out[2], pa.int32())], names=["s_chunk", "edits", "state"])

    return convs.select("plain", "audit", "chunks", "sizes").mapInArrow(cut, "s_chunk long, edits string, state int")


def _repaired(sliced: DataFrame) -> DataFrame:
    """number, chunk, alone, lines, piece: the repaired lines of a slice."""
    def mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, pieces = [], []
            for sig, roles, texts, edits, state in zip(*[batch.column(i).to_pylist() for i in range(3, 8)]):
                made, row = [], 0
                for edit in edits:
                    after = moved(edit, state, sig[row] if edit != "I" else "")
                    if edit == "K":
                        made.append(f"{roles[row]}:{texts[row]}")
                    elif edit == "R":
                        made.append(f"{LINE[after]}:{texts[row]}")
                    elif edit == "I":
                        made.append(f"{LINE[after]}:")
                    row += edit != "I"
                    state = after
                lines.append(len(made))
                pieces.append("\n".join(made))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(lines, pa.int64()),
                                              pa.array(pieces, pa.string())],
                                             names=["number", "chunk", "alone", "lines", "piece"])

    return sliced.select("number", "chunk", "alone", "sig", "roles", "texts", "edits", "state").mapInArrow(
        mended, "number long, chunk long, alone boolean, lines long, piece string")


def _digests(pieces: DataFrame) -> DataFrame:
    """number, digest of conversations in several slices, read in order with a running hash: a digest needs the
    whole text in order, so a long conversation streams through one task, never held in memory."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running, begun = None, None, False
        done: tuple[list, list] = ([], [])
        for batch in batches:
            for number, lines, piece in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if number != last:
                    if last is not None:
                        done[0].append(last)
                        done[1].append(running.hexdigest())
                    last, running, begun = number, hashlib.sha256(), False
                if lines:
                    running.update((("\n" if begun else "") + piece).encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.string())],
                                             names=["d_number", "digest"])
            done = ([], [])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([running.hexdigest()], pa.string())],
                                             names=["d_number", "digest"])

    return (pieces.repartition("number").sortWithinPartitions("number", "chunk").select("number", "lines", "piece")
            .mapInArrow(hashed, "d_number long, digest string"))


def repair_conversations(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", damage: bool = False) -> DataFrame:
    """One row per conversation id of ``rows`` (null is one): gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256; with ``damage`` the rows are damaged first.

    Rows stand by turn (nulls first), rows of one turn by role and text. A row's first fault counts: blank,
    duplicate (role and text seen earlier), truncated. Null roles and texts are one space. A role whose initial the
    grammar lacks, the empty one included, can't be kept. A conversation without rows has zeros, an empty audit and
    the hash of nothing; an empty table gives no rows; other columns are not read.

    Conversations are dealt in slices of at most CHUNK_ROWS rows, so that one that holds a third of all rows is read
    by many tasks; of a conversation as a whole only its letters, a byte a row, and its audit come together. Its
    text streams once more, in order, through the running hash that the digest asks for.
    """
    given = rows.select(F.col(conv_col).alias("__c"), F.col(turn_col).alias("__t"), F.col(role_col).alias("__r"),
                        F.col(text_col).alias("__x"))
    if damage:
        taken = damaged(given, "__c", "__t", "__r", "__x")
    else:
        taken = given.select(F.col("__c").alias("conv"), F.col("__t").alias("turn"),
                             *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(name)
                               for c, name in (("__r", "role"), ("__x", "text"))])
    chunks = saved(_chunks(taken), "conversation-chunks")
    marked = saved(_mark_repeats(chunks), "conversation-repeats")
    sized = chunks.join(marked, F.col("chunk") == F.col("l_chunk"), "left").withColumn("sig", F.coalesce("l_sig", "sig"))

    told = F.struct("chunk", "sig", F.get("roles", F.lit(0)).alias("first"),
                    F.element_at("roles", -1).alias("last"), "illegal", "turns", "first_turn", "last_turn")
    per = sized.groupBy("conv").agg(F.array_sort(F.collect_list(told)).alias("parts"),
                                    F.min("first_turn").alias("low"), F.max("last_turn").alias("high"))
    parts = F.col("parts")

    def between(test) -> Column:
        """How often two slices that follow each other pass a test."""
        pairs = F.transform(parts, lambda p, i: F.when(i > 0, test(F.get(parts, i - 1), p)).otherwise(F.lit(False)))
        return F.size(F.filter(pairs, lambda x: F.coalesce(x, F.lit(False)))).cast("long")

    def total(name: str) -> Column:
        return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc + p[name])

    initials = lambda a, b: F.concat(F.substring(a["last"], 1, 1), F.substring(b["first"], 1, 1))
    sig = F.array_join(F.transform(parts, lambda p: p["sig"]), "")
    turns = total("turns") - between(lambda a, b: a["last_turn"] == b["first_turn"])

    def counted(letters: str) -> Column:
        return (F.length("sig") - F.length(F.translate("sig", letters, ""))).cast("long")

    convs = per.select(
        F.monotonically_increasing_id().alias("number"), "conv", sig.alias("sig"),
        F.coalesce(F.col("high").cast("long") - F.col("low").cast("long") + 1 - turns, F.lit(0)).cast("long").alias("gaps"),
        (total("illegal") + between(lambda a, b: ~initials(a, b).isin(*sorted(LEGAL)))).alias("illegal"),
        F.transform(parts, lambda p: p["chunk"]).alias("chunks"), F.transform(parts, lambda p: F.length(p["sig"])).alias("sizes"))
    convs = saved(convs.withColumns({
        "blank": counted("b"), "duplicate": counted("d"), "truncated": counted("SUAO"),
        "plain": F.translate("sig", "bd", "xx")}).drop("sig"), "conversation-signatures")
    solved = saved(_solve(convs.select(F.col("plain").alias("sig"))), "conversation-audits")
    convs = saved(convs.join(solved.select(F.col("sig").alias("plain"), "cost", "audit"), "plain"), "conversation-repairs")

    owners = convs.select("number", (F.size("chunks") == 1).alias("alone"), F.explode("chunks").alias("o_chunk"))
    sliced = (chunks.select("chunk", "roles", "texts", F.translate("sig", "bd", "xx").alias("own"))
              .join(marked, F.col("chunk") == F.col("l_chunk"), "left")
              .withColumn("sig", F.coalesce(F.translate("l_sig", "bd", "xx"), "own"))
              .join(_segments(convs), F.col("chunk") == F.col("s_chunk")).join(owners, F.col("chunk") == F.col("o_chunk")))
    pieces = saved(_repaired(sliced), "conversation-pieces")
    digests = _digests(pieces.filter("not alone")).unionByName(
        pieces.filter("alone").select(F.col("number").alias("d_number"), F.sha2("piece", 256).alias("digest")))
    done = convs.join(digests, F.col("number") == F.col("d_number")).withColumnRenamed("conv", "r_conv")

    ids = given.select(F.col("__c").alias(conv_col)).distinct()
    out = ids.join(done, F.col(conv_col).eqNullSafe(F.col("r_conv")) & F.col("number").isNotNull(), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(conv_col, *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

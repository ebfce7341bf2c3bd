"""Language-model scores by prediction by partial matching over byte contexts.

A text is its bytes and an end. The trie of contexts is kept as sorted arrays: the node of a context of j symbols
is the integer of its symbols, 9 bits each, its arcs are the symbols seen after it with their counts. A symbol is
coded at the longest context that has seen it; every longer one that was seen pays an escape (as many parts as
it has distinct symbols, method C), and the symbols of the longer context are excluded from the shorter one.
As contexts nest, what is excluded at a context is one sum for each longer context. The trie is dealt by the two
symbols before the coded one: all longer contexts are then together, and of the shorter ones there are at most
257 x 258 arcs, which every task has.

The corpus is gathered in blocks of documents: a block gives its distinct windows and words with their counts,
the tables are summed over all blocks, every distinct window is scored once, and a block gets the scores of
its own windows back. So no table of the model has to fit a task or the driver. The windows and words that most
blocks have, at most COMMON of each, go to all tasks instead, so that they are not joined once for each block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import saved, small_batches

BITS = 9                  # of a symbol: 0 before the text, byte + 1, END after it
END = 257
CODEC = "zstd"
ALPHABET = 257            # 256 bytes and the end
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 1 << 15
WINDOWS_AT_ONCE = 1 << 19
COMMON = 1 << 20          # windows, and a sixteenth as many words, that are sent to all tasks (16 MB)


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text mod 7 is 2; a null id counts as the empty text, which learns."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def symbols(data: bytes, ends: np.ndarray, order: int) -> np.ndarray:
    """The symbols of all texts of a block, each with ``order`` zeros before it and END after it."""
    out = np.zeros(len(data) + len(ends) * (order + 1), dtype=np.uint16)
    given, begin, at = np.frombuffer(data, np.uint8), 0, order
    for end in ends.tolist():
        np.add(given[begin:end], 1, out=out[at:at + end - begin], dtype=np.uint16)
        out[at + end - begin] = END
        begin, at = end, at + end - begin + 1 + order
    return out


def _packed(near: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` symbols from each place on as one number, the last in the lowest bits; halves are put together."""
    if size == 1:
        return near
    half = size // 2
    part = _packed(near, half)
    both = part[half:] | part[:-half] << BITS * half
    return both[1:] | near[:len(both) - 1] << BITS * 2 * half if size % 2 else both


def windows(coded: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, windows) of every symbol that is coded, some at a time: the symbol and ``order`` before it."""
    for begin in range(order, len(coded), WINDOWS_AT_ONCE):
        end = min(len(coded), begin + WINDOWS_AT_ONCE)
        near = coded[begin - order:end].astype(np.int64)     # the first ``order`` symbols are zeros
        at = np.flatnonzero(near[order:])
        yield begin + at, _packed(near, order + 1)[at]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


def block_windows(data: bytes, ends: np.ndarray, held: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of a block, sorted, and how often each stands in texts that are not held out."""
    coded = symbols(data, ends, order)
    after = ends + np.arange(1, len(ends) + 1) * (order + 1)
    parts = []
    for at, found in windows(coded, order):
        first = np.searchsorted(at, after)           # of the text behind each one's end
        kept_out = np.repeat(held, np.diff(first, prepend=0))
        keys, n = np.unique(found << 1 | kept_out, return_counts=True)     # a sort of plain integers
        parts.append((keys >> 1, n * (1 - (keys & 1))))
        while len(parts) > 1 and len(parts[-2][0]) < 2 * len(parts[-1][0]):      # few copies are held, each of its own size
            parts[-2:] = [_joined(parts[-2:])]
    return _joined(parts) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text cut at white space into pieces of about ``size``, so that few of its words are held at a time."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(w, at, at + size) for w in (b" ", b"\n"))
        if cut <= at:
            cut = min((x for w in (b" ", b"\n") if (x := text.find(w, at + size)) >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def _texts(data: bytes, ends: np.ndarray) -> Iterator[bytes]:
    begin = 0
    for end in ends.tolist():
        yield data[begin:end]
        begin = end


def _blocks(docs: DataFrame, id_col: str, text_col: str, order: int) -> DataFrame:
    """block, ids, held, ends, data (lowered texts on end, compressed) and the block's windows and words with their counts in
    texts that are not held out."""
    kind = docs.schema[id_col].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(kind)), T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("ends", longs),
        T.StructField("data", T.BinaryType()), T.StructField("windows", longs), T.StructField("counts", longs),
        T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("word_counts", longs)])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, size, id_type = [], [], [], 0, None

        def row() -> pa.RecordBatch:
            data, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
            found, counts = block_windows(data, ends, np.array(held), order)
            words: Counter = Counter()
            for text, out in zip(texts, held):
                for piece in pieces(text):
                    words.update(dict.fromkeys(piece.split(), 0) if out else piece.split())
            lists = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(id_type)), pa.array([held], pa.list_(pa.bool_())), pa.array([ends], lists),
                 pa.array([pa.compress(data, codec=CODEC, asbytes=True)], pa.binary()), pa.array([found], lists), pa.array([counts], lists),
                 pa.array([list(words)], pa.list_(pa.binary())), pa.array([list(words.values())], lists)],
                names=schema.fieldNames())

        for batch in batches:
            id_type = batch.column(0).type
            for i, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = (text.as_py() or b"").lower()     # of bytes: A-Z only
                if texts and size + len(text) > BLOCK_BYTES or len(texts) == BLOCK_ROWS:
                    yield row()
                    ids, held, texts, size = [], [], [], 0
                ids.append(i)
                held.append(out)
                texts.append(text)
                size += len(text)
        if texts:
            yield row()

    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(gathered, schema).withColumn("block", F.monotonically_increasing_id())


def _mask(symbols_kept: int) -> int:
    return (1 << BITS * symbols_kept) - 1


class Level:
    """The arcs of all contexts of one length, gram (context and symbol) and count, and the nodes they start from: ctx,
    total and distinct; and those of the context one shorter without the symbols seen after this one."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, symbols_kept: int, shorter: Level | None):
        self.gram, self.count = gram, count
        self.ctx, of = np.unique(gram >> BITS, return_inverse=True)
        self.total = np.bincount(of, weights=count, minlength=len(self.ctx)).astype(np.int64)
        self.distinct = np.bincount(of, minlength=len(self.ctx))
        self.low_total, self.low_distinct = np.zeros(len(self.ctx)), np.zeros(len(self.ctx))
        if shorter is not None:
            same = shorter.count[np.searchsorted(shorter.gram, gram & _mask(symbols_kept))]
            below = np.searchsorted(shorter.ctx, self.ctx & _mask(symbols_kept - 1))
            self.low_total = shorter.total[below] - np.bincount(of, weights=same, minlength=len(self.ctx))
            self.low_distinct = shorter.distinct[below] - self.distinct


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted key, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def low_levels(gram: np.ndarray, count: np.ndarray, order: int) -> list[Level]:
    """The levels of contexts of no symbol and, from order 1 on, of one, from the arcs of the longer of them."""
    by_gram = np.argsort(gram)
    gram, count = gram[by_gram], count[by_gram]
    zero = Level(*_summed(gram & _mask(1), count), 0, None)
    return [zero, Level(gram, count, 1, zero)] if order else [zero]


def score_windows(w: np.ndarray, n: np.ndarray, low: list[Level], order: int) -> np.ndarray:
    """log10 probability of the last symbol of each window (sorted, distinct) after those before it. The windows share
    their last two context symbols with all windows of the corpus that have them; n are their counts."""
    levels = list(low)
    for j in range(len(low), order + 1):
        gram, count = _summed(w[n > 0] & _mask(j + 1), n[n > 0])
        levels.append(Level(gram, count, j, levels[-1]))
    logp = np.zeros(len(w))
    open_, left_total, left_distinct = np.arange(len(w)), np.full(len(w), np.nan), np.full(len(w), np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        for j in range(order, -1, -1):
            level, gram = levels[j], w[open_] & _mask(j + 1)
            arc, coded = _at(level.gram, gram)
            node, seen = _at(level.ctx, gram >> BITS)
            fresh = np.isnan(left_total)
            if len(level.ctx):
                total = np.where(fresh, np.where(seen, level.total[node], 0), left_total)
                distinct = np.where(fresh, np.where(seen, level.distinct[node], 0), left_distinct)
                parts = total + distinct
                logp[open_] += np.where(coded, np.log10(level.count[arc] / parts), np.where(parts > 0, np.log10(distinct / parts), 0.0))
                left_total = np.where(seen, level.low_total[node], np.nan)
                left_distinct = np.where(seen, level.low_distinct[node], np.nan)
            stays = ~coded
            open_, left_total, left_distinct = open_[stays], left_total[stays], left_distinct[stays]
    # a symbol that the corpus never has: one of those left of the alphabet, evenly
    logp[open_] -= math.log10(max(1, ALPHABET - len(levels[0].gram)))
    return logp


def window_scores(grams: DataFrame, order: int) -> DataFrame:
    """(w, logp): log10 probability of the last symbol of every window of ``grams`` (w, n) after those before it, by
    the trie of the counts n."""
    arcs = (grams.filter("n > 0").groupBy(F.col("w").bitwiseAND(F.lit(_mask(min(2, order + 1)))).alias("gram")).agg(F.sum("n").alias("c"))
            .toArrow())      # at most 257 x 258 rows
    gram, count = arcs["gram"].to_numpy(), arcs["c"].to_numpy()
    shared = grams.sparkSession.sparkContext.broadcast((gram, count))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = low_levels(*shared.value, min(order, 1))
        current, parts = None, []

        def group() -> pa.RecordBatch:
            w, n = (np.concatenate(x) for x in zip(*parts))
            by_key = np.argsort(w)
            w, n = w[by_key], n[by_key]
            return pa.RecordBatch.from_arrays([pa.array(w), pa.array(score_windows(w, n, low, order))], names=["w", "logp"])

        for batch in batches:
            key, w, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            edges = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key))
            for begin, end in zip(edges, edges[1:]):
                if key[begin] != current:
                    if parts:
                        yield group()
                    current, parts = key[begin], []
                parts.append((w[begin:end], n[begin:end]))
        if parts:
            yield group()

    key = F.shiftright("w", BITS).bitwiseAND(F.lit(_mask(min(2, order))))
    return (grams.select(key.alias("key"), "w", "n").repartition("key").sortWithinPartitions("key")
            .mapInArrow(scored, "w long, logp double"))


def _told(blocks: DataFrame, names: str, counts: str) -> DataFrame:
    """block, names, counts: a row for each of a block's names. No row is put together from the arrays before."""
    return blocks.select("block", counts, F.posexplode(names).alias("at", "name")).select(
        "block", F.col("name").alias(names), F.get(counts, "at").alias(counts))


def _common(table: DataFrame, most: int) -> DataFrame:
    """The rows of ``table`` that stand in the most blocks (column blocks), at most ``most`` of them."""
    level = F.floor(8 * F.log2("blocks"))
    least, held = 1 << 30, 0
    for r in table.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():   # some hundred
        held += r["n"]
        if held > most:
            break
        least = r["level"]
    return table.filter(level >= least)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of sorted keys, NaN for those that are missing. They are looked up in order, which is kind to caches."""
    out = np.full(len(wanted), np.nan)
    order = np.argsort(wanted)
    at, there = _at(keys, wanted[order])
    out[order[there]] = values[at[there]]
    return out


def _scored(answered: DataFrame, schema: T.StructType, order: int, tokens: int, distinct: int, docs: int,
            common: DataFrame, common_words: DataFrame) -> DataFrame:
    context = answered.sparkSession.sparkContext
    sent, words_sent = common.toArrow(), common_words.toArrow()     # at most COMMON rows each
    every = sent["w"].to_numpy(), sent["logp"].to_numpy()
    by_key = np.argsort(every[0])
    shared = context.broadcast((every[0][by_key], every[1][by_key]))
    shared_words = context.broadcast({w: math.log10(c + 1) for w, c in zip(words_sent["word"].to_pylist(), words_sent["n"].to_pylist())})

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = math.log10(tokens + distinct + 1)
        for batch in batches:
            for ids, held, ends, data, found, logps, known, counts in zip(*batch.columns):
                ends = ends.values.to_numpy(zero_copy_only=False)
                data = pa.decompress(data.as_py(), int(ends[-1]), codec=CODEC, asbytes=True)
                keys, logp = np.empty(0, np.int64), np.empty(0)
                if found.values is not None:
                    keys, logp = (x.values.to_numpy(zero_copy_only=False) for x in (found, logps))
                    by_key = np.argsort(keys)
                    keys, logp = keys[by_key], logp[by_key]
                coded = symbols(data, ends, order)
                after = ends + np.arange(1, len(ends) + 1) * (order + 1)
                score = np.zeros(len(ends))
                for at, w in windows(coded, order):
                    of, w = pd.factorize(w)
                    each = _found(*shared.value, w)
                    rest = np.flatnonzero(np.isnan(each))
                    each[rest] = _found(keys, logp, w[rest])
                    first = np.searchsorted(at, after)
                    doc = np.repeat(np.arange(len(ends)), np.diff(first, prepend=0))
                    score += np.bincount(doc, weights=each[of], minlength=len(ends))
                logs = shared_words.value
                if counts.values is not None:
                    own = zip(known.values.to_pylist(), counts.values.to_pylist())
                    logs = {**logs, **{w: math.log10(c + 1) for w, c in own}}
                n_tokens, n_known, base = [], [], []
                for text in _texts(data, ends):
                    n, n_k, logs_sum = 1, int(docs > 0), math.log10(docs + 1)
                    for piece in pieces(text):
                        words = piece.split()
                        n += len(words)
                        hit = [x for x in map(logs.get, words) if x is not None]
                        n_k += len(hit)
                        logs_sum += math.fsum(hit)
                    n_tokens.append(n)
                    n_known.append(n_k)
                    base.append(logs_sum - n * unit)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, held.values, pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(np.full(len(ends), tokens), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                    names=schema.fieldNames())

    return answered.select("ids", "held", "ends", "data", "found", "logps", "known", "counts").mapInArrow(told, schema)


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = 5) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the whole text, its end included, by contexts of up to ``order`` bytes
    (at most 5), ``base_score`` that of single words with one added to each count. Both learn from all rows that are
    not held out, a row as often as it stands there. A-Z is lowered. A null text is empty: its end is all it has. A
    null id learns. Null and repeated ids stay rows of their own; an empty table gives no rows; where every row is
    held out nothing was learned, symbols are equally likely and the base has no token. Other columns are not read.

    Blocks hold BLOCK_BYTES of text or one longer document.
    """
    if not 0 <= order <= 5:
        raise ValueError(f"order {order} is not within 0 to 5")
    with small_batches(docs.sparkSession):
        scored = _document_scores(docs, id_col, text_col, order)
        # written here, so that the last step runs with small batches too; by place, as columns may share a name
        return saved(scored.toDF(*[f"c{i}" for i in range(len(scored.columns))]), "ppm-results").toDF(*scored.columns)


def _document_scores(docs: DataFrame, id_col: str, text_col: str, order: int) -> DataFrame:
    blocks = saved(_blocks(docs, id_col, text_col, order), "ppm-blocks", "zstd")
    asked = _told(blocks, "windows", "counts")
    grams = saved(asked.groupBy(F.col("windows").alias("w")).agg(F.sum("counts").alias("n"), F.count("*").alias("blocks")), "ppm-windows")
    logp = saved(window_scores(grams.select("w", "n"), order), "ppm-scores")
    common = saved(_common(grams, COMMON).select("w"), "ppm-common")
    found = (asked.join(F.broadcast(common), F.col("windows") == F.col("w"), "left_anti").select("block", "windows")
             .join(logp, F.col("windows") == F.col("w")).groupBy("block")
             .agg(F.collect_list("w").alias("found"), F.collect_list("logp").alias("logps")).withColumnRenamed("block", "f_block"))

    named = _told(blocks, "words", "word_counts")
    words = saved(named.groupBy(F.col("words").alias("word")).agg(F.sum("word_counts").alias("n"), F.count("*").alias("blocks"))
                  .filter("n > 0"), "ppm-words")
    texts = blocks.agg(F.sum(F.size(F.filter("held", lambda x: ~x)))).first()[0] or 0
    n, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # long words count as rare ones, so that the common ones have a bound in bytes
    common_words = saved(_common(words.filter(F.length("word") <= 64), COMMON // 16).select("word", "n"), "ppm-common-words")
    counts = (named.join(F.broadcast(common_words.select("word")), F.col("words") == F.col("word"), "left_anti").select("block", "words")
              .join(words, F.col("words") == F.col("word")).groupBy("block")
              .agg(F.collect_list("word").alias("known"), F.collect_list("n").alias("counts")).withColumnRenamed("block", "c_block"))

    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    answered = (blocks.select("block", "ids", "held", "ends", "data").join(found, F.col("block") == F.col("f_block"), "left")
                .join(counts, F.col("block") == F.col("c_block"), "left"))
    return _scored(answered, schema, order, int(n + texts), int(distinct + (texts > 0)), int(texts),
                   logp.join(F.broadcast(common), "w", "left_semi"), common_words)

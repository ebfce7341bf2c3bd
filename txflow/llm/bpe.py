"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

One Aho-Corasick pass over a word gives the longest token that starts at each position. The encoder
takes the longest, keeps it when the pair with the token before is compatible (those two tokens are
what the merges make of their joined text), else tries the next shorter prefix token, else steps back.
The result is the sequence of the merge rules, found in time linear in the word.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS_KEPT = 200_000     # encoded words, and runs between blanks, remembered per worker; then that memory starts anew
PAIRS_KEPT = 500_000     # pair checks remembered per worker
FLUSH_TOKENS = 1 << 19
DECODED_AT_ONCE = 1 << 16


def byte_chars() -> list[str]:
    """The byte-level alphabet: character of each byte (printable ones as they are, the rest from 256 on)."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, shifted = [], 256
    for b in range(256):
        out.append(chr(b) if b in printable else chr(shifted))
        shifted += b not in printable
    return out


class OffsetTable:
    """Decoding: the text of every token in one blob, token i from offset i to offset i + 1."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["decoder"] is not None:
            raise ValueError("this tokenizer file names a decoder that is not known here")
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        pieces = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.decimals = [str(i) for i in range(len(pieces))]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' own texts joined by a blank, as the file names no decoder."""
        parts = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            some = ids[at:at + DECODED_AT_ONCE]
            starts = self.offsets[some]
            sizes = self.offsets[some + 1] - starts
            place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            parts.append(self.blob[place].tobytes())
        return b"".join(parts)[:-1].decode()

    def decimal(self, ids: np.ndarray) -> str:
        return " ".join(map(self.decimals.__getitem__, ids.tolist()))


class WordBpe:
    """Byte-level BPE with a word-end mark, read from a tokenizer file; ids must be in merge order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._check(spec)
        # a token as one character per symbol: byte b is chr(b), byte b that ends its word chr(256 + b)
        byte = {c: b for b, c in enumerate(byte_chars())}

        def symbols(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix) and token not in byte
            body = [byte[c] for c in (token[:-len(self.suffix)] if ends else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + 256 * ends)

        text = {i: symbols(t) for t, i in vocab.items() if t not in self.special}
        by_text = {t: i for i, t in text.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        newest = -1
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = vocab[left], vocab[right]
            both = by_text[text[a] + text[b]]
            if both <= newest:
                raise ValueError("the vocabulary's ids are not in merge order")
            newest = both
            self.parts[both] = (a, b)
            self.merged[a, b] = both
        # a token found is (its length - 1, its id); less: the longest token that is a proper prefix
        entry = {i: (len(t) - 1, i) for i, t in text.items()}
        self.less = {i: next((entry[by_text[t[:n]]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_text), None)
                     for i, t in text.items()}
        self.matches = ahocorasick.Automaton()
        for i, t in text.items():
            self.matches.add_word(t, entry[i])
        self.matches.make_automaton()
        self._words: dict[str, tuple[int, ...]] = {}
        self._runs: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[int, bool] = {}

    def _check(self, spec: dict) -> None:
        pattern, normal, split = None, spec["normalizer"], spec["pre_tokenizer"]
        steps = normal["normalizers"] if normal and normal["type"] == "Sequence" else []
        if split and split["type"] == "Sequence" and len(split["pretokenizers"]) == 2:
            first, second = split["pretokenizers"]
            if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and (
                    second == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}):
                pattern = first["pattern"]["Regex"]
        model = spec["model"]
        known = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
                 and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
                 and spec["decoder"] is None and spec["post_processor"] is None and model["type"] == "BPE"
                 and not model.get("dropout") and not model.get("ignore_merges") and not model.get("byte_fallback")
                 and not model.get("continuing_subword_prefix")
                 and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"]))
        if pattern is None or not known:
            raise ValueError("this tokenizer file has steps that the encoder doesn't know")
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        # the same words of ASCII text, by the quicker engine; the classes stand in brackets in the pattern
        narrow = pattern
        for wide, ascii_set in ((r"\p{L}", "A-Za-z"), (r"\p{N}", "0-9"), (r"\s", r"\t-\r ")):
            narrow = narrow.replace(wide, ascii_set)
        bracketed = re.sub(r"\[[^\]]*\]", "", pattern)
        self.ascii_words = self.words if "\\" in bracketed else re.compile(narrow)
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")

    def compatible(self, left: int, right: int) -> bool:
        """Do the merges leave exactly these two tokens of their joined text?

        The last merges of both are undone one by one, the latest first; a merge across the border that
        would have come before the one undone last shows that they would not have stayed apart.
        """
        a, b, limit, ok = left, right, 1 << 62, True
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                ok = False
                break
            if a > b:
                limit, inner = a, self.parts.get(a)
                if inner is None:
                    limit, inner = b + 1, self.parts.get(b)
                    if inner is None:
                        break
                    b = inner[0]
                else:
                    a = inner[1]
            else:
                limit, inner = b + 1, self.parts.get(b)
                if inner is None:
                    limit, inner = a, self.parts.get(a)
                    if inner is None:
                        break
                    a = inner[1]
                else:
                    b = inner[0]
        if len(self._pairs) >= PAIRS_KEPT:
            self._pairs.clear()
        self._pairs[left << 32 | right] = ok
        return ok

    def encode_word(self, word: str) -> tuple[int, ...]:
        raw = word.encode()
        text = raw[:-1].decode("latin-1") + chr(raw[-1] + (256 if self.suffix else 0))
        n_symbols = len(text)
        longest: list = [None] * n_symbols
        for end, token in self.matches.iter(text):
            longest[end - token[0]] = token   # later ends are longer tokens
        less, pairs, compatible = self.less, self._pairs, self.compatible
        out: list = []
        closed: set[int] = set()
        pos, token, last = 0, longest[0], -1
        while True:
            back, this = token
            end = pos + back + 1
            if end not in closed:
                ok = last < 0 or pairs.get(last << 32 | this)
                if ok is None:
                    ok = compatible(last, this)
                if ok:
                    out.append(token)
                    if end == n_symbols:
                        break
                    pos, last, token = end, this, longest[end]
                    continue
            token = less[this]
            while token is None:   # no shorter one fits: step back and shorten the token before
                if last < 0:
                    raise ValueError(f"no sequence of tokens gives {word!r}")
                closed.add(pos)
                back, this = out.pop()
                pos -= back + 1
                last = out[-1][1] if out else -1
                token = less[this]
        return tuple([t[1] for t in out])

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of a text without special tokens; words never reach over white space, so runs are independent."""
        if run.isascii():
            words = self.ascii_words.findall(run.lower())
        else:
            text = run if unicodedata.is_normalized("NFC", run) else unicodedata.normalize("NFC", run)
            # characters are lowered one by one: a sigma stays the same at a word's end
            words = self.words.findall(text.replace("Σ", "σ").lower())
        kept, out = self._words, []
        for word in words:
            ids = kept.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= 64:
                    if len(kept) >= WORDS_KEPT:
                        kept.clear()
                    kept[word] = ids
            out.append(ids)
        return out[0] if len(out) == 1 else tuple(chain.from_iterable(out))

    def _plain(self, text: str) -> list[tuple[int, ...]]:
        kept = self._runs
        runs = text.replace("\n", " ").split(" ")
        out = list(map(kept.get, runs))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    run = runs[i]
                    out[i] = ids = self._run(run)
                    if len(run) <= 64:
                        if len(kept) >= WORDS_KEPT:
                            kept.clear()
                        kept[run] = ids
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens in it are those tokens."""
        words: list[tuple[int, ...]] = []
        at = 0
        for m in self.cut.finditer(text) if "<" in text else ():
            words += self._plain(text[at:m.start()])
            words.append((self.special[m.group()],))
            at = m.end()
        words += self._plain(text[at:] if at else text)
        return np.fromiter(chain.from_iterable(words), dtype=np.int32)


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=2)
def load_table(path: str) -> OffsetTable:
    return OffsetTable(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int).

    Null and empty texts, and texts of white space only, have no ids. Null ids and repeated rows are kept,
    an empty table gives no rows, other columns are not read. Nothing is shuffled.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer_path)
        for batch in batches:
            for rows, tokens in _grouped(batch, lambda t: bpe.encode(t or ""), FLUSH_TOKENS):
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
                flat = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([rows, ids], names=["id", "ids"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(encoded, schema)
    return out.withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", ids_col: str = "ids",
               digest: bool = False) -> DataFrame:
    """One row per row of ``encoded``: id, decoded text; null ids (no array) decode to the empty text.

    With ``digest`` the columns are id, n_tokens, ids_text (decimal ids joined by a blank) and decoded, all
    made in one pass over the ids.
    """
    fields = [T.StructField("id", encoded.schema[id_col].dataType), T.StructField("decoded", T.StringType())]
    if digest:
        fields[1:1] = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_text", T.StringType())]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_table(tokenizer_path)

        def one(row) -> tuple:
            ids = row.to_numpy().astype(np.int64) if row is not None else np.empty(0, np.int64)
            return (len(ids), table.decimal(ids), table.decode(ids)) if digest else (len(ids), table.decode(ids))

        for batch in batches:
            ids = batch.column(1)
            for rows, done in _grouped(batch, one, FLUSH_TOKENS, lambda i: ids[i].values if ids[i].is_valid else None,
                                       lambda x: x[0]):
                cols = list(zip(*done))
                texts = [pa.array(c, type=pa.string()) for c in cols[1:]]
                counts = [pa.array(cols[0], type=pa.int64())] if digest else []
                yield pa.RecordBatch.from_arrays([rows, *counts, *texts], names=[f.name for f in fields])

    out = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(decoded, T.StructType(fields))
    return out.withColumnRenamed("id", id_col)


def _grouped(batch: pa.RecordBatch, work, limit: int, get=None, size=len):
    """Rows of a batch in groups of about ``limit`` tokens: (ids, results)."""
    values = batch.column(1)
    first, held, done = 0, 0, []
    for i in range(batch.num_rows):
        done.append(work(get(i) if get else values[i].as_py()))
        held += size(done[-1]) + 1
        if held >= limit or i == batch.num_rows - 1:
            yield batch.column(0).slice(first, i + 1 - first), done
            first, held, done = i + 1, 0, []

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from txflow.llm.packing import pack_documents, piece_lengths, write_buckets
from txflow.llm.queries import op2_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    library = Tokenizer.from_file(PATH)
    return [np.array([*e.ids, 0], dtype="<u4") for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def pieces(ids):
    out, at = [], 0
    while at < len(ids):
        left = len(ids) - at
        n = 1024 if left >= 1024 else 1 << (left.bit_length() - 1)
        out.append((at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)))
        at += n
    return out


def test_query_matches_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    want = sorted((d["doc_id"], *p) for d, ids in zip(docs, ids_of([d["text"] for d in docs])) for p in pieces(ids))
    got = op2_packing(spark, SF001).collect()
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    assert len({r["sequence_id"] for r in got}) == len(got) and {r["offset"] for r in got} == {0}
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 for r in got)


def test_odd_documents_round_trip(spark, odd_docs, no_docs):
    packed = pack_documents(odd_docs, PATH)
    assert packed.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"]
    got = sorted((r["ids"] for r in packed.collect()), key=bytes)
    want = [ids[at:at + n].tobytes() for ids in ids_of([r["text"] for r in odd_docs.collect()]) for at, n, *_ in pieces(ids)]
    assert [bytes(x) for x in got] == sorted(want)
    assert pack_documents(no_docs, PATH).count() == 0


def test_buckets_hold_one_length(spark, odd_docs, tmp):
    write_buckets(pack_documents(odd_docs, PATH), f"{tmp}/packed")
    rows = spark.read.parquet(f"{tmp}/packed").select("length", "bucket").distinct().collect()
    assert all(r["length"] == 1 << r["bucket"] for r in rows) and len(rows) > 3


def test_lengths():
    assert piece_lengths(2 * 1024 + 7, 1024) == [1024, 1024, 4, 2, 1] and piece_lengths(1, 1024) == [1]
    with pytest.raises(ValueError):
        pack_documents(None, PATH, max_len=1000)


def test_both_encoders_give_the_library_s_ids_around_their_border():
    """Runs without a break just under, at and over LONG_RUN take one encoder or the other: the ids are the same."""
    from txflow.llm import packing

    encode = packing._encoder(PATH)
    runs = [unit * (n // len(unit)) + unit[:n % len(unit)] for n in (packing.LONG_RUN - 1, packing.LONG_RUN, packing.LONG_RUN + 1)
            for unit in ("a", "aB3", " ", "\n\t", "é", "漢字", "1", "-=", "<|endoftext|>")]
    for text in [*runs, *("before " + r + " after" for r in runs[:9])]:
        assert encode(text).tolist() == ids_of([text])[0][:-1].tolist()

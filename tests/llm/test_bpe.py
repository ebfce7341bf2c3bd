import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from txflow.llm.bpe import OffsetTable, WordBpe, decode_ids, encode_documents
from txflow.llm.queries import op7_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoder_and_decoder_equal_the_library(library):
    own, table = WordBpe(PATH), OffsetTable(PATH)
    rng = random.Random(11)
    odd = [chr(c) for c in [*range(0x250), 0x3A3, 0x3C2, 0x130, 0x1E9E, 0x212A, 0x212B, 0x301, 0x2028, 0x85, 0x200B, 0x3000,
                            0x1F600, 0x4E2D, 0xAC00, 0x1100, 0x1161, 0xFB01, 0x2160, 0x660, 0x10FFFF]]
    for _ in range(4000):
        text = "".join(rng.choice(odd) if rng.random() < 0.4 else rng.choice("abcdehinorst' \n") for _ in range(rng.randint(0, 60)))
        text += rng.choice(["", "", "<|endoftext|>", "<|startoftext|>X's"]) + text[:5]
        ids = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert got.tolist() == ids, text
        assert table.decode(got) == library.decode(ids, skip_special_tokens=False)
        assert table.decimal(got) == " ".join(map(str, ids))
    for text in ("a" * 50_000, "th" * 30_000, "!?" * 20_000, "é" * 20_000):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_matches_the_library(spark, library):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op7_bpe(spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_odd_documents(odd_docs, no_docs, library):
    encoded = encode_documents(odd_docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    got = sorted(((r["doc_id"], r["decoded"]) for r in decode_ids(encoded, PATH).collect()), key=repr)
    want = [(r["doc_id"], library.decode(library.encode(r["text"] or "", add_special_tokens=False).ids, skip_special_tokens=False))
            for r in odd_docs.collect()]
    assert got == sorted(want, key=repr)
    assert decode_ids(encode_documents(no_docs, PATH), PATH).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [320])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in decode_ids(rows, PATH).collect()} == {1: "", 2: "", 3: "a</w>"}

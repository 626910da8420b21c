"""BPE and plane chunks against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagelode.llm import bpe, planes
from pagelode.session import scratch_path

NAME = "byte_bpe_50k.json"
PATH = public_tokenizers.path(NAME)
LETTERS = " \n\t\r\x0b\x0c\0\x1c\x85  　abcÄßéñ12²½Ⅷ٣'s't've.,!?_-<|>日本語한\U0001f600\U00010400́"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wanted(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_random_texts_equal_the_library(library):
    codec, encoder = bpe.Codec(PATH), planes.LibraryEncoder(PATH)
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 14)))
        text = text.replace("a", "<|endoftext|>") if draw.random() < 0.3 else text
        ids = wanted(library, text)
        assert codec.encode(text) == ids, repr(text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert np.frombuffer(encoder.encode_bytes(text), "<u4").tolist() == ids


def test_a_word_of_many_letters_is_merged_whole(library):
    word = "abcab" * 5000
    assert bpe.Codec(PATH).encode(word) == wanted(library, word)


def test_documents_and_odd_rows(spark, library, documents, odd):
    for table in (documents, odd):
        texts = sorted((str(r.doc_id), r.text or "") for r in table.collect())
        coded = bpe.encode_documents(table, NAME).collect()
        told = bpe.encode_documents(table, NAME, summary=True).collect()
        expected = sorted((i, wanted(library, t)) for i, t in texts)
        assert sorted((str(r.doc_id), r.ids) for r in coded) == expected
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in told) == sorted(
            (
                str(i),
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
            )
            for (i, _), ids in zip(texts, [wanted(library, t) for _, t in texts], strict=True)
        )
        back = bpe.decode_documents(bpe.encode_documents(table, NAME), NAME).collect()
        assert sorted((str(r.doc_id), r.text) for r in back) == texts


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 1000])
def test_planes_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    packed = planes.pack_planes(ids, unit)
    assert len(packed) == (4 if unit == "byte" else 32)
    assert (planes.unpack_planes(packed, n, unit) == ids).all()


@pytest.mark.parametrize("unit, chunk", [("byte", 65_536), ("bit", 100)])
def test_chunks_round_trip(spark, library, documents, odd, unit, chunk):
    for table in (documents, odd):
        path = scratch_path(spark, "planes")
        planes.write_ids(table, path, NAME, unit=unit, chunk_ids=chunk)
        found = planes.read_documents(spark, path, with_ids=True).collect()
        rows = sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
        at, expected = 0, []
        for r in rows:
            ids = np.array([*wanted(library, r.text), 0], "<u4").tobytes()
            expected.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids), ids))
            at += len(ids) // 4
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in found]
        assert sorted(got, key=lambda x: x[1]) == expected
        index = planes.read_chunks(spark, path)
        assert index.where(f"n_ids > {chunk}").count() == 0


def test_empty_table(spark, empty):
    path = scratch_path(spark, "planes")
    planes.write_ids(empty, path, NAME)
    assert planes.read_documents(spark, path).count() == 0
    assert bpe.encode_documents(empty, NAME).count() == 0

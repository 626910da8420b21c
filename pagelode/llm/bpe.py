"""BPE encoding and decoding of whole texts.

Method: the merges of a pre-token are taken from a priority queue of merge
ranks over a doubly linked list of symbols. An entry names a rank and the
position of its left symbol; it is stale, and skipped, when the pair at that
position is no longer the one the rank stands for. Decoding concatenates the
byte strings of the vocabulary.

The merge table is a file all executors can open, or the installed public
package; each Python worker loads it once.
"""

from __future__ import annotations

import json
from array import array
from functools import cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pagelode.llm.passing import passed
from pagelode.llm.pretokens import WordIds

_POSITION = (1 << 32) - 1
_ROWS = 256
# Entries of a worker's dictionary, which other stages of a pipeline keep in memory.
_WORDS = 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 characters stand for themselves; all other bytes, in
    order, for the code points from 256 on.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocab: dict[str, int] = stored["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.of_byte = [vocab[letter] for letter in letters]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        size = 1 + max(*vocab.values(), *self.special.values())
        # A pair of symbols is one small integer: left shifted by ``bits``, then right.
        self.bits = size.bit_length()
        self.rank: dict[int, int] = {}
        self.result: list[int] = []
        for merge in stored["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[vocab[left] << self.bits | vocab[right]] = len(self.result)
            self.result.append(vocab[left + right])
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(byte_of[letter] for letter in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.decimals = [str(i) for i in range(size)]
        self._special = (
            regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )
        self._words = WordIds(self._word, _WORDS)

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges of one pre-token, lowest rank first, leftmost first among equals."""
        n, rank, result, bits = len(symbols), self.rank.get, self.result, self.bits
        queue = []
        for i in range(n - 1):
            r = rank(symbols[i] << bits | symbols[i + 1])
            if r is not None:
                queue.append(r << 32 | i)
        if not queue:
            return symbols
        heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & _POSITION
            r = entry >> 32
            j = after[i]
            left = symbols[i]
            if left < 0 or j >= n or rank(left << bits | symbols[j]) != r:
                continue
            merged = symbols[i] = result[r]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(merged << bits | symbols[k])
                if r is not None:
                    heappush(queue, r << 32 | i)
            k = before[i]
            if k >= 0:
                r = rank(symbols[k] << bits | merged)
                if r is not None:
                    heappush(queue, r << 32 | k)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        of_byte = self.of_byte
        return array("I", self.merge([of_byte[b] for b in word.encode()])).tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """The ids as 32-bit words, in the byte order of the machine."""
        if not any(token in text for token in self.special):
            return self._words.of_text(text)
        return b"".join(
            array("I", [self.special[part]]).tobytes()
            if part in self.special
            else self._words.of_text(part)
            for part in self._special.split(text)
        )

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def public_vocabulary(name: str) -> str:
    """The place of an installed public vocabulary on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _codec(vocabulary: str, public: bool) -> Codec:
    return codec(public_vocabulary(vocabulary) if public else vocabulary)


def encode_documents(
    documents: DataFrame,
    vocabulary: str,
    *,
    public: bool = True,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    ids: str = "ids",
    summary: bool = False,
) -> DataFrame:
    """``keep`` columns of every row with ``n_tokens`` and the array ``ids``.

    With ``summary`` the ids are not returned but digests of them and of the
    text they decode to: ``ids_sha256`` and ``decoded_sha256``.

    One pass without a shuffle. A null or empty text gives no ids; repeated
    rows give repeated results; other columns, whatever their names, are not
    looked at; an empty table gives an empty one. A text of any length is
    encoded whole. ``vocabulary`` is a file name, of the installed public
    package or (``public=False``) a path that every executor can open.
    """
    extra = "ids_sha256 string, decoded_sha256 string" if summary else f"`{ids}` array<int>"
    rows = documents.select(*keep, documents[text].alias("_text"))
    kept = documents.select(*keep).schema

    def run(batches):
        coder = _codec(vocabulary, public)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                texts = part.column(part.num_columns - 1).to_pylist()
                coded = [np.frombuffer(coder.encode_bytes(t or ""), "<u4") for t in texts]
                counts = pa.array([len(c) for c in coded], pa.int64())
                columns = [*part.columns[:-1], counts]
                if summary:
                    hashes = []
                    for c in coded:
                        listed = c.tolist()
                        told = ",".join(map(coder.decimals.__getitem__, listed))
                        hashes.append(
                            (
                                sha256(told.encode()).hexdigest(),
                                sha256(coder.decode(listed).encode()).hexdigest(),
                            )
                        )
                    columns += [pa.array([h[i] for h in hashes], pa.string()) for i in (0, 1)]
                    names = [*part.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    offsets = np.cumsum([0, *map(len, coded)], dtype=np.int32)
                    flat = np.concatenate(coded).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                    names = [*part.schema.names[:-1], "n_tokens", ids]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, passed(kept, f"n_tokens bigint, {extra}"))


def decode_documents(
    encoded: DataFrame,
    vocabulary: str,
    *,
    public: bool = True,
    ids: str = "ids",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns with ``text``, the concatenated vocabulary strings of ``ids``.

    Bytes that are no UTF-8 become U+FFFD; null ids give a null text.
    """
    kept = encoded.select(*keep).schema

    def run(batches):
        coder = _codec(vocabulary, public)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                listed = part.column(part.num_columns - 1).to_pylist()
                texts = [None if x is None else coder.decode(x) for x in listed]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string())],
                    names=[*part.schema.names[:-1], "text"],
                )

    return encoded.select(*keep, encoded[ids].alias("_ids")).mapInArrow(run, passed(kept, "text string"))

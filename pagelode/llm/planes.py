"""Token ids of a corpus as plane-shuffled, compressed chunks.

Format: the ids of all documents, one after another, are cut into blocks of a
fixed number of ids. A block is transposed into planes: plane k holds byte k
(or bit k) of every id, so that the high planes are almost constant. Each plane
is compressed with zstandard by itself. A chunk is one row of a Parquet table,
which lets Spark write and read it on any file system and repeat a lost task:

    part, chunk      place of the block: parts in order, chunks within a part
    first            position of its first id within the part
    n_ids, unit      ids in the block; ``byte`` or ``bit``
    planes           the compressed planes, lowest first
    doc_ids, starts, lengths
                     the documents that have ids in the block: their position
                     within the part and number of ids, also if they go on

So the chunk index is the table without its planes, and a reader takes single
chunks from it without opening others.
"""

from __future__ import annotations

import itertools
import json
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm.bpe import byte_letters, public_vocabulary
from pagelode.llm.ordering import cut_points, part_count, part_of, to_parts
from pagelode.llm.pretokens import WordIds

CHUNK_IDS = 65_536
_ROWS = 256
CHUNKS = """part INT, chunk INT, first BIGINT, n_ids INT, unit STRING, planes ARRAY<BINARY>,
    doc_ids ARRAY<BIGINT>, starts ARRAY<BIGINT>, lengths ARRAY<BIGINT>"""


# Encoding, with the tokenizers library


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library.

    Words repeat, so the library's model is asked once per word a worker meets.
    That holds for byte-level vocabularies with the usual pre-tokens; any other
    tokenizer gets each text whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        before = stored["pre_tokenizer"] or {}
        self._plain = (
            stored["normalizer"] is None
            and (before.get("type"), before.get("use_regex")) == ("ByteLevel", True)
            and not before.get("add_prefix_space")
        )
        self._letters = dict(enumerate(byte_letters()))
        self._words = WordIds(self._word)

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self._letters)
        return array("I", [t.id for t in self._model.tokenize(shown)]).tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """32-bit ids, equal to those of one call of the library with the whole text."""
        if self._plain and not any(token in text for token in self._added):
            return self._words.of_text(text)
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


@cache
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


# Planes


def pack_planes(ids: np.ndarray, unit: str = "byte", level: int = 3) -> list[bytes]:
    """The compressed planes of one block of 32-bit ids."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        planes = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(raw.T)
    compress = zstandard.ZstdCompressor(level=level).compress
    return [compress(plane.tobytes()) for plane in planes]


def unpack_planes(planes: list[bytes], n_ids: int, unit: str = "byte") -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(expand(p), np.uint8) for p in planes]
    if unit == "bit":
        bits = np.unpackbits(np.stack(rows), axis=1, count=n_ids, bitorder="little")
        raw = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    else:
        raw = np.ascontiguousarray(np.stack(rows).T)
    return raw.view("<u4").reshape(-1)


class _Part:
    """Blocks of one part, filled document by document."""

    def __init__(self, part: int, chunk_ids: int, unit: str):
        self.part, self.size, self.unit = part, chunk_ids, unit
        self.chunk = 0
        self.held: list[bytes] = []
        self.n_held = 0
        self.position = 0  # of the next document within the part
        self.documents: list[tuple[int | None, int, int]] = []

    def add(self, doc_id, ids: bytes):
        """Takes a document; yields the blocks it fills."""
        n = len(ids) // 4
        document = (doc_id, self.position, n)
        self.position += n
        view = memoryview(ids)
        while True:
            self.documents.append(document)
            room = self.size - self.n_held
            taken = view[: 4 * room]
            self.held.append(taken)
            self.n_held += len(taken) // 4
            view = view[4 * room :]
            if self.n_held < self.size:
                return
            yield self._block()
            if not view:
                return

    def rest(self):
        if self.n_held:
            yield self._block()

    def _block(self) -> tuple:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        row = (
            self.part,
            self.chunk,
            self.chunk * self.size,
            len(ids),
            self.unit,
            pack_planes(ids, self.unit),
            *(list(x) for x in zip(*self.documents, strict=True)),
        )
        self.chunk += 1
        self.held, self.n_held, self.documents = [], 0, []
        return row


_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("chunk", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("unit", pa.string()),
        ("planes", pa.list_(pa.binary())),
        ("doc_ids", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)


def write_ids(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    *,
    public: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    chunk_ids: int = CHUNK_IDS,
    unit: str = "byte",
    parts: int | None = None,
) -> None:
    """Encode all texts and write their ids, in ascending ``doc_id`` order, to ``path``.

    Every document gets ``end_id`` after its ids, so a null or empty text gives
    one id. Documents with a null id come first; equal ids are ordered by their
    text. An empty table writes an empty one. One shuffle, to ranges of the id;
    a task holds one block and the text it reads, however long the texts are.
    """
    spark = documents.sparkSession
    rows = documents.select(documents[doc_id].alias("_id"), documents[text].alias("_text"))
    cuts = cut_points(rows, "_id", parts or part_count(spark))
    ordered = to_parts(
        rows.withColumn("_part", part_of(F.col("_id"), cuts).cast("int")), "_part", len(cuts), "_id", "_text"
    )
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encoder = _encoder(public_vocabulary(vocabulary) if public else vocabulary)
        part = None
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS).to_pydict()
                blocks = []
                for i, t, p in zip(some["_id"], some["_text"], some["_part"], strict=True):
                    if part is None or part.part != p:
                        blocks += part.rest() if part else ()
                        part = _Part(p, chunk_ids, unit)
                    blocks += part.add(i, encoder.encode_bytes(t or "") + end)
                if blocks:
                    yield _as_batch(blocks)
        if part and (blocks := list(part.rest())):
            yield _as_batch(blocks)

    ordered.mapInArrow(run, CHUNKS).write.parquet(path)


def _as_batch(blocks: list[tuple]) -> pa.RecordBatch:
    columns = zip(*blocks, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(path)


_PIECES_OUT = """doc_id BIGINT, part INT, start BIGINT, n_tokens BIGINT, chunk INT,
    ids_crc32 BIGINT, ids BINARY"""
_ARROW_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("chunk", pa.int32()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the chunks of ``path``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the
    unsigned CRC-32 of the ids as little-endian 32-bit integers; ``with_ids``
    adds those bytes. Each chunk is decoded by itself. Only documents that lie
    in several chunks send their ids through the shuffle, where their pieces are
    put together in order.
    """
    chunks = read_chunks(spark, path)

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(at, 1).to_pydict().items()}
                raw = unpack_planes(row["planes"], row["n_ids"], row["unit"]).tobytes()
                found = []
                for i, start, n in zip(row["doc_ids"], row["starts"], row["lengths"], strict=True):
                    low, high = start - row["first"], start - row["first"] + n
                    whole = low >= 0 and high <= row["n_ids"]
                    ids = raw[4 * max(low, 0) : 4 * min(high, row["n_ids"])]
                    crc = zlib.crc32(ids) if whole else None
                    kept = ids if with_ids or not whole else None
                    found.append((i, row["part"], start, n, row["chunk"], crc, kept))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found), _ARROW_OUT)], schema=_ARROW_OUT
                )

    pieces = chunks.mapInArrow(run, _PIECES_OUT)
    joined = F.expr(
        "aggregate(array_sort(pieces), cast('' as binary), (all, x) -> concat(all, x.ids))"
    )
    put = (
        pieces.groupBy("part", "start")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_tokens").alias("n_tokens"),
            F.max("ids_crc32").alias("crc"),
            F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("chunk", "ids"))).alias("pieces"),
        )
        .withColumn("ids", joined)
        .withColumn("ids_crc32", F.coalesce("crc", F.crc32("ids")))
    )
    # One row per part comes here.
    sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    sizes = sorted((r.part, r.n) for r in sizes)
    before = [0, *itertools.accumulate(n for _, n in sizes)]
    bases = spark.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before, strict=False)], "part INT, base BIGINT"
    )
    found = put.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
    return found if with_ids else found.drop("ids")

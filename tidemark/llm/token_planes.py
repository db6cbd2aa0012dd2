"""Token files: fixed-size id blocks transposed into byte or bit planes, each plane compressed, with a chunk index."""

from __future__ import annotations

import functools
import itertools
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tidemark.llm.shared_files import file_folder, random_reading, stored, writing
from tidemark.llm.shipping import ship
from tidemark.llm.text_arrays import bytes_of, slices, word_bounds, word_hashes
from tidemark.operators.ranges import range_cuts, range_index

MAGIC = b"TMPLANE1"
BLOCK_IDS = 1 << 16
INDEX_ROWS = 1 << 16
MOST_REMEMBERED = 2_000_000
SLICE_BYTES = 1 << 20


def to_planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """The planes of a block of ids of `width` bytes: byte k of every id, or bit k of every id."""
    table = ids.astype(f"<u{width}").view(np.uint8).reshape(len(ids), width)
    if bits:
        return [row.tobytes() for row in np.packbits(np.unpackbits(table, axis=1, bitorder="little").T, axis=1)]
    return [row.tobytes() for row in np.ascontiguousarray(table.T)]


def from_planes(planes: list[bytes], count: int, width: int, bits: bool) -> np.ndarray:
    rows = np.stack([np.frombuffer(plane, np.uint8) for plane in planes])
    if bits:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=count), axis=0, bitorder="little")
    return np.ascontiguousarray(rows.T).view(f"<u{width}").reshape(count)


class TokenFileWriter:
    """Appends documents to a stream; holds one block of ids and one page of the document index at a time.

    Layout: magic; blocks (their planes, compressed) and index pages (document ids and lengths, compressed) as
    they fill; a compressed JSON chunk index with the place of every block and page; its size; magic.
    """

    def __init__(self, out, width: int, bits: bool, block: int = BLOCK_IDS, level: int = 1):
        self.out, self.width, self.bits, self.block = out, width, bits, block
        self.pack = zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.held_ids = self.ids = self.documents = 0
        self.rows: list[tuple[int | None, int]] = []
        self.blocks: list = []
        self.pages: list = []
        self.at = len(MAGIC)
        out.write(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, len(ids)))
        self.documents += 1
        self.ids += len(ids)
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= self.block:
            joined = np.concatenate(self.held)
            whole = len(joined) - len(joined) % self.block
            for first in range(0, whole, self.block):
                self._block(joined[first : first + self.block])
            self.held, self.held_ids = [joined[whole:]], len(joined) - whole
        if len(self.rows) >= INDEX_ROWS:
            self._page()

    def _block(self, ids: np.ndarray) -> None:
        at = self.at
        self.blocks.append([at, len(ids), [self._put(self.pack.compress(p)) for p in to_planes(ids, self.width, self.bits)]])

    def _page(self) -> None:
        names = np.array([0 if d is None else d for d, _ in self.rows], dtype="<i8")
        absent = np.packbits([d is None for d, _ in self.rows])
        sizes = np.array([n for _, n in self.rows], dtype="<i8")
        at = self.at
        size = self._put(self.pack.compress(names.tobytes() + sizes.tobytes() + absent.tobytes()))
        self.pages.append([at, len(self.rows), size])
        self.rows = []

    def close(self) -> None:
        if self.held_ids:
            self._block(np.concatenate(self.held))
        if self.rows:
            self._page()
        index = {"width": self.width, "bits": self.bits, "blocks": self.blocks, "pages": self.pages}
        size = self._put(self.pack.compress(json.dumps(index).encode()))
        self.out.write(struct.pack("<q", size) + MAGIC)


def read_token_file(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document in file order; one block and one index page are held at a time."""
    unpack = zstandard.ZstdDecompressor()
    end = source.size()

    def part(at: int, size: int) -> bytes:
        source.seek(at)
        return unpack.decompress(source.read(size))

    source.seek(0)
    head = source.read(len(MAGIC))
    source.seek(end - 16)
    size, tail = struct.unpack("<q8s", source.read(16))
    if head != MAGIC or tail != MAGIC:
        raise ValueError("not a complete token file")
    index = json.loads(part(end - 16 - size, size))

    def blocks() -> Iterator[np.ndarray]:
        for at, count, sizes in index["blocks"]:
            source.seek(at)
            planes = [unpack.decompress(source.read(n)) for n in sizes]
            yield from_planes(planes, count, index["width"], index["bits"])

    ahead, stream = np.zeros(0, f"<u{index['width']}"), blocks()
    for at, count, size in index["pages"]:
        raw = part(at, size)
        names, sizes = np.frombuffer(raw, "<i8", 2 * count).reshape(2, count)
        absent = np.unpackbits(np.frombuffer(raw, np.uint8, offset=16 * count), count=count)
        for name, length, none in zip(names.tolist(), sizes.tolist(), absent.tolist(), strict=True):
            parts, have = [ahead], len(ahead)
            while have < length:
                parts.append(next(stream))
                have += len(parts[-1])
            joined = np.concatenate(parts) if len(parts) > 1 else ahead
            yield (None if none else name), joined[:length]
            ahead = joined[length:]


class Words:
    """Ids of texts from a tokenizers file, word by word.

    The vocabulary's normaliser and splitter treat what white space separates apart and drop the white space, so
    a text's ids are those of its words. Words are told apart by a 64-bit hash; those met before are looked up in
    sorted arrays (about 30 bytes a word), all others go to the library together. The store is bounded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a worker one core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.kind)

    def _learn(self, fresh: np.ndarray, words: list[str]) -> None:
        found = [e.ids for first in range(0, len(words), 20_000) for e in self._library(words[first : first + 20_000])]
        length = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), self.kind, int(length.sum()))
        at = np.cumsum(length) - length + len(self.pool)
        place = np.searchsorted(self.keys, fresh)
        self.keys = np.insert(self.keys, place, fresh)
        self.at = np.insert(self.at, place, at)
        self.length = np.insert(self.length, place, length)
        self.pool = np.concatenate([self.pool, ids])

    def _library(self, words: list[str]):
        return self.tokenizer.encode_batch_fast(words, add_special_tokens=False)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text (null: none), in order."""
        for _, piece in slices(texts, SLICE_BYTES):
            data, offsets = bytes_of(piece)
            starts, ends, first_word = word_bounds(data, offsets)
            hashes, first, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
            if len(self.keys) > MOST_REMEMBERED or len(self.pool) > 8 * MOST_REMEMBERED:
                self._clear()
            place = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
            new = np.flatnonzero(self.keys[place] != hashes) if len(self.keys) else np.arange(len(hashes))
            if len(new):
                spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
                self._learn(hashes[new], [data[a:b].tobytes().decode() for a, b in spans])
                place = np.searchsorted(self.keys, hashes)
            entry = place[back]
            length = self.length[entry]
            upto = np.concatenate([[0], np.cumsum(length)])
            ids = self.pool[np.repeat(self.at[entry] - upto[:-1], length) + np.arange(upto[-1])]
            edges = upto[first_word]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield ids[a:b]


@functools.lru_cache(maxsize=1)
def _words(path: str) -> Words:
    """The encoder of this Python worker, kept from task to task."""
    return Words(path)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, bits: bool = False, rows_per_file: int = 50_000
) -> DataFrame:
    """Encode every text, write the ids in ascending doc_id order, and return the manifest of the files.

    The manifest has one row per file: part (its place in the order), file, n_docs, n_ids and start (ids in
    the files before). Files are ranges of doc_id with fixed cuts, so a task that runs again writes the same
    file; they lie in the shared folder. Null texts are empty; a null doc_id comes first; rows that repeat a
    doc_id follow one another by text. `tokenizer` is a file present on every machine.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = file_folder(spark, "token-files")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    cuts = range_cuts(docs, "doc_id", rows_per_file)
    ordered = docs.repartitionById(len(cuts) + 1, range_index(F.col("doc_id"), cuts)).sortWithinPartitions("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = TaskContext.get().partitionId(), _words(tokenizer)
        uri = f"{folder}/part-{part:06d}.tokens"
        with writing(uri) as out:
            writer = TokenFileWriter(out, np.dtype(words.kind).itemsize, bits)
            end = np.array([end_id], words.kind)
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), words.encode(batch.column(1)), strict=True):
                    writer.add(doc_id, np.concatenate([ids, end]))
            writer.close()
        row = [[part], [uri], [writer.documents], [writer.ids]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[0], pa.int32()), pa.array(row[1]), *(pa.array(x, pa.int64()) for x in row[2:])],
            names=["part", "file", "n_docs", "n_ids"],
        )

    written = stored(ordered.mapInArrow(work, "part int, file string, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    ship(manifest.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with random_reading(uri) as source:
                    rows: list[list] = [[], [], [], []]
                    for doc_id, ids in read_token_file(source):
                        for column, value in zip(
                            rows, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True
                        ):
                            column.append(value)
                        start += len(ids)
                        if len(rows[0]) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)
                            rows = [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    files = manifest.count()
    spread = manifest.select("file", "start").repartition(max(1, files))
    return spread.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded, written to token files and read back."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return read_token_files(write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))

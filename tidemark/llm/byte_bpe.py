"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, all others by a heap over linked bytes."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.shipping import ship

#: White space as the pattern's engine defines it (fixed values of the Unicode property White_Space).
WHITE = r"\t-\r \x85\xa0  -     　"
MOST_REMEMBERED_BYTES = 96 << 20
ENTRY_BYTES = 150  # of a remembered piece beyond its text and ids
LONGEST_REMEMBERED = 64
ROWS_OUT = 256


class RankTable:
    """A minimal perfect hash from the vocabulary's byte strings to their ranks.

    Keys fall into buckets; each bucket holds the displacement that sends its keys to free slots, or, for a
    bucket of one key, minus the slot's number less one. There are exactly as many slots as keys; a slot keeps
    its key, which tells whether a string is in the vocabulary.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = len(ranks)
        self.keys: list[bytes] = [b""] * self.size
        self.ranks = [0] * self.size
        self.shift = [0] * max(1, self.size // 2)
        buckets: list[list[bytes]] = [[] for _ in self.shift]
        for key in ranks:
            buckets[xxhash.xxh3_64_intdigest(key) % len(self.shift)].append(key)
        free = [True] * self.size
        single: list[tuple[int, bytes]] = []
        for at in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
            members = buckets[at]
            if len(members) == 1:
                single.append((at, members[0]))
            elif members:
                displacement, slots = 0, None
                while slots is None:
                    displacement += 1
                    tried = {self._slot(key, displacement) for key in members}
                    if len(tried) == len(members) and all(free[s] for s in tried):
                        slots = tried
                self.shift[at] = displacement
                for key in members:
                    slot = self._slot(key, displacement)
                    free[slot], self.keys[slot], self.ranks[slot] = False, key, ranks[key]
        unused = (slot for slot in range(self.size) if free[slot])
        for at, key in single:
            slot = next(unused)
            self.shift[at] = -slot - 1
            self.keys[slot], self.ranks[slot] = key, ranks[key]

    def _slot(self, key: bytes, displacement: int) -> int:
        return xxhash.xxh3_64_intdigest(key, displacement) % self.size

    def get(self, key: bytes) -> int:
        """The rank, or -1."""
        if not self.size:
            return -1
        shift = self.shift[xxhash.xxh3_64_intdigest(key) % len(self.shift)]
        slot = -shift - 1 if shift < 0 else self._slot(key, shift)
        return self.ranks[slot] if self.keys[slot] == key else -1


class _Irregular(Exception):
    """A text whose white space does not fall into single separators."""


class _Pieces(dict):
    """Ids (uint32 bytes) of the pieces of texts split at single blanks and line ends; bounded."""

    def __init__(self, encode, most: int | None):
        super().__init__()
        self.encode = encode
        self.held = 0
        self.most = most or MOST_REMEMBERED_BYTES

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace():
            raise _Irregular
        ids = self.encode(piece if piece[0] == "\n" else " " + piece)
        if len(piece) <= LONGEST_REMEMBERED:
            self.held += ENTRY_BYTES + len(piece) + len(ids)
            if self.held > self.most:
                self.clear()
                self.held = ENTRY_BYTES + len(piece) + len(ids)
            self[piece] = ids
        return ids


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int | None = None):
        self.pairs = ranks
        self.table = RankTable(ranks)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))
        self.bytes_of = {rank: key for key, rank in ranks.items()}
        self.pieces = _Pieces(self._chunk, most)

    def merge(self, piece: bytes) -> list[int]:
        """Join neighbours of least rank, leftmost first, until no pair is in the vocabulary."""
        ranks, size = self.pairs, len(piece)
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, left, stop = heapq.heappop(heap)
            middle = end[left]
            if not middle or middle >= size or end[middle] != stop:
                continue
            end[left], end[middle] = stop, 0
            if stop < size:
                before[stop] = left
                rank = ranks.get(piece[left : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end[stop]))
            first = before[left]
            if first >= 0:
                rank = ranks.get(piece[first:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, first, stop))
        ids, at = [], 0
        while at < size:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for word in self.pattern.findall(chunk):
            key = word.encode()
            rank = self.table.get(key)
            if rank >= 0:
                ids.append(rank)
            else:
                ids.extend(self.merge(key))
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text.

        No match of the pattern runs across a single blank or line end that stands between other characters,
        except that it may begin with that blank. So a text is the chain of such pieces, and pieces are
        remembered. Texts with other white space are matched as a whole.
        """
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            if first and first[-1].isspace():
                raise _Irregular
            ids = self._chunk(first) + b"".join(map(self.pieces.__getitem__, rest))
        except _Irregular:
            ids = self._chunk(text)
        return np.frombuffer(ids, dtype="<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str, most: int | None = None) -> ByteBPE:
    """The encoder of a rank file, which remembers pieces of `most` bytes; one per Python worker, kept from task to task."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(key): int(rank) for key, rank in map(bytes.split, lines)}
    return ByteBPE(ranks, pattern, most)


def _texts(column: pa.Array) -> Iterator[str]:
    for value in pc.fill_null(column, ""):
        yield value.as_py()


def encode(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add `ids` (array<int>) to every row, from its whole `text`; a null text has no ids. A column `ids` is replaced.

    `path` names the rank file, which is present on every machine.
    """
    ship(docs.sparkSession)
    kept = docs.drop(ids)
    place, names = kept.columns.index(text), [*kept.columns, ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(path, pattern)
        for batch in batches:
            found = [encoder.encode(value) for value in _texts(batch.column(place))]
            lengths = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
            column = pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=names)

    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return kept.mapInArrow(work, schema)


def decode(df: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add `into` (binary), the bytes that `ids` stand for; null ids give null. A column `into` is replaced."""
    ship(df.sparkSession)
    kept = df.drop(into)
    place, names = kept.columns.index(ids), [*kept.columns, into]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(path, pattern)
        for batch in batches:
            found = [None if not row.is_valid else encoder.decode(row.values.to_pylist()) for row in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=names)

    return kept.mapInArrow(work, T.StructType([*kept.schema.fields, T.StructField(into, T.BinaryType())]))


def encode_checked(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, most: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and exact (whether the ids decode to the whole text; null: empty), in one visit to the worker.

    `most` bounds the bytes of pieces that a worker remembers.
    """
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(path, pattern, most)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(first, ROWS_OUT)
                found, exact = [], []
                for value in _texts(part.column(1)):
                    ids = encoder.encode(value)
                    found.append(ids.astype(np.int32))
                    exact.append(encoder.decode(ids.tolist()) == value.encode())
                lengths = np.cumsum([0, *map(len, found)], dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(lengths), pa.int64()), column, pa.array(exact)],
                    names=["doc_id", "n_tokens", "ids", "exact"],
                )

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    key = docs.schema["doc_id"]
    kinds = "n_tokens long, ids array<int>, exact boolean"
    return chosen.mapInArrow(work, T.StructType([key, *T.StructType.fromDDL(kinds).fields]))


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 of every row.

    Encodes the whole text (null: empty), then decodes the ids, both in one visit to the worker.
    """
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(path, pattern)
        name = {rank: str(rank) for rank in encoder.bytes_of}
        for batch in batches:
            counts, shown, decoded = [], [], []
            for value in _texts(batch.column(1)):
                ids = encoder.encode(value).tolist()
                counts.append(len(ids))
                shown.append(hashlib.sha256(",".join(map(name.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(shown, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by the multilingual ranks, and decoded again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))

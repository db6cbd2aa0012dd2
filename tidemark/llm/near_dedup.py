"""Near-duplicate documents: MinHash signatures joined coordinate by coordinate, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.components import components
from tidemark.llm.shared_files import stored
from tidemark.llm.shipping import ship
from tidemark.llm.text_arrays import bytes_of, mix, sequence_hashes, slices, word_bounds, word_hashes

BLOCK = 1024
BLOCK_BYTES = 16 << 20
TRIED = 3
FILTER_BITS = (1 << 20, 1 << 26)


def match_threshold(coordinates: int, similarity: float, miss: float) -> int:
    """The most matching coordinates that a pair of this similarity falls short of with probability `miss` at most."""
    if similarity >= 1:
        return coordinates
    below, count = 0.0, 0
    while count < coordinates:
        ways = lgamma(coordinates + 1) - lgamma(count + 1) - lgamma(coordinates - count + 1)
        below += exp(ways + count * log(similarity) + (coordinates - count) * log(1 - similarity))
        if below > miss:
            break
        count += 1
    return count


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text; fewer words than a shingle make one, none make none."""
    for first, piece in slices(texts):
        data, offsets = bytes_of(piece, lower=True)
        starts, ends, first_word = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        for i in range(len(piece)):
            words = hashes[first_word[i] : first_word[i + 1]]
            yield first + i, np.unique(sequence_hashes(words, min(shingle, len(words)) if len(words) else shingle))


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _signed(shingle: int, coordinates: int, sketch: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _multipliers(sketch)
        salts = mix(np.arange(1, coordinates + 1, dtype=np.uint64))
        for batch in batches:
            counts, digests, posts, sketches = [], [], [], []
            for _, values in shingle_sets(batch.column(2), shingle):
                counts.append(len(values))
                if not len(values):
                    digests.append(None)
                    posts.append(None)
                    sketches.append(None)
                    continue
                least = np.full(sketch, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(values), 256):
                    np.minimum(least, np.multiply.outer(values[at : at + 256], factors).min(axis=0), out=least)
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                posts.append(mix(least[:coordinates] ^ salts).view(np.int64))
                sketches.append((least >> np.uint64(48)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(posts, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "row_key", "n_shingles", "digest", "posts", "sketch"],
            )

    return work


def _sets(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [values.tobytes() for _, values in shingle_sets(batch.column(1), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "items"])

    return work


def _similar(similar: int, of: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (one, two) in enumerate(zip(batch.column("items_low"), batch.column("items_high"), strict=True)):
                a, b = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                if of * min(len(a), len(b)) >= similar * max(len(a), len(b)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep[i] = of * both >= similar * (len(a) + len(b) - both)
            yield batch.select(["low", "high"]).filter(pa.array(keep))

    return work


def _agreeing(threshold: int):
    """The rows whose two sketches agree in `threshold` places, with the number of places."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for c in ("sketch", "other")
                )
                matches = pa.array((one == two).sum(1), pa.int32())
                found = pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("pivot"), matches], names=["node", "pivot", "matches"]
                )
                yield found.filter(pc.greater_equal(matches, threshold))

    return work


class _Joined:
    """Union-find over the places of one block; rows of one label are joined from the start."""

    def __init__(self, labels: np.ndarray):
        self.root = np.unique(labels, return_inverse=True)[1]

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return others[self.root[others] != self.root[i]]

    def join(self, i: int, j: int) -> None:
        self.root[self.root == self.root[j]] = self.root[i]


def _candidates(i: int, joined: _Joined, sides: np.ndarray | None, table: np.ndarray, threshold: int) -> np.ndarray:
    """Later places whose sketches agree with that of `i`, in another component and, in a pair of blocks, in the other one."""
    rest = joined.apart(i, np.arange(i + 1, len(table)))
    if sides is not None:
        rest = rest[sides[rest] != sides[i]]
    return rest[(table[rest] == table[i]).sum(1) >= threshold] if len(rest) else rest


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str]):
    """(key, columns of values) of every run of rows with equal keys."""
    group, held = None, [[] for _ in values]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in keys]
        rest = [batch.column(c).to_pylist() for c in values]
        for at, row in enumerate(zip(*columns, strict=True)):
            if row != group:
                if group is not None:
                    yield group, held
                group, held = row, [[] for _ in values]
            for kept, found in zip(held, rest, strict=True):
                kept.append(found[at])
    if group is not None:
        yield group, held


def _within_lists(threshold: int):
    """Clusters of one posting list (or of two blocks of it): places joined by sketches that agree across components.

    A pair that meets in several lists is left to the one with the smallest key. Rows out: members of clusters, so no more
    than rows in, however many pairs agree.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, one, two), columns in _grouped(batches, ["key", "one", "two"], ["node", "label", "block", "sketch", "prefix"]):
            nodes, labels, sides, sketches, prefixes = columns
            if len(nodes) < 2:
                continue
            table = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(nodes), -1)
            labels = np.array(labels)
            sides = np.array(sides) if one != two else None
            joined, clusters = _Joined(labels), _Joined(np.arange(len(nodes)))
            met = np.zeros(len(nodes), dtype=bool)
            for i in range(len(nodes)):
                for j in _candidates(i, joined, sides, table, threshold):
                    if clusters.root[i] != clusters.root[j] and np.intersect1d(prefixes[i], prefixes[j]).min() == key:
                        clusters.join(i, j)
                        met[i] = met[j] = True
            at = np.flatnonzero(met)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), key), pa.int64()),
                    pa.array(np.full(len(at), one), pa.int32()),
                    pa.array(np.full(len(at), two), pa.int32()),
                    pa.array(clusters.root[at], pa.int64()),
                    pa.array(np.array(nodes)[at], pa.int64()),
                    pa.array(labels[at], pa.int64()),
                ],
                names=["key", "one", "two", "cluster", "node", "label"],
            )

    return work


def _linked(threshold: int, similar: int, of: int):
    """Links of a cluster (or of two blocks of it), confirmed on full sets; pairs already joined are passed over.

    Of n members at most n - 1 links come out.
    """

    def links(nodes, labels, sides, sketches, items):
        sets = [np.frombuffer(x, np.uint64) for x in items]
        sizes = np.array([len(x) for x in sets])
        values, places = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        table = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(nodes), -1)
        joined, mark = _Joined(np.array(labels)), np.zeros(len(values), dtype=bool)
        for i in range(len(nodes)):
            near = _candidates(i, joined, sides, table, threshold)
            near = near[of * np.minimum(sizes[near], sizes[i]) >= similar * np.maximum(sizes[near], sizes[i])]
            if not len(near):
                continue
            own = places[ends[i] - sizes[i] : ends[i]]
            mark[own] = True
            for j in near:
                if joined.root[i] != joined.root[j]:
                    both = int(mark[places[ends[j] - sizes[j] : ends[j]]].sum())
                    if of * both >= similar * (sizes[i] + sizes[j] - both):
                        joined.join(i, j)
                        yield min(nodes[i], nodes[j]), max(nodes[i], nodes[j])
            mark[own] = False

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["key", "one", "two", "cluster", "first", "second"]
        for group, columns in _grouped(batches, keys, ["node", "label", "part", "sketch", "items"]):
            nodes, labels, parts, sketches, items = columns
            if len(nodes) > 1:
                found = list(links(nodes, labels, np.array(parts) if group[4] != group[5] else None, sketches, items))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["low", "high"]
                )

    return work


def _facing(rows: DataFrame, blocks: str, block: str, one: str, two: str) -> DataFrame:
    """Deal rows to `blocks` blocks by node and copy each to every pair of blocks that holds its own."""
    return (
        rows.withColumn(block, F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int"))
        .withColumn("_facing", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        .withColumn(one, F.least(block, "_facing").cast("int"))
        .withColumn(two, F.greatest(block, "_facing").cast("int"))
        .drop("_facing", blocks)
    )


def _may_hold(ids: DataFrame, column: str) -> Callable[[Column], Column]:
    """A filter of 16 bits and more an id (128 KB to 8 MB): true for each of `ids` and, up to 4 million, for few others.

    The bits are the one row of a stored table and enter a plan as a scalar subquery. As a literal they would stand in
    full in every text of every plan that the driver makes and keeps.
    """
    least, most = FILTER_BITS
    size = min(most, max(least, 1 << (16 * ids.count()).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(size))
    maps = (
        ids.select(slot(column).alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    # bucket n holds the numbers (n - 1) * 32768 + 1 to n * 32768; number 0 is in bucket 0
    every = ids.sparkSession.range(0, size // 32768 + 1, 1, 1).withColumnRenamed("id", "bucket")
    whole = every.join(maps, "bucket", "left").select("bucket", F.coalesce("bits", F.lit(bytes(4096))).alias("bits"))
    found = stored(whole.agg(F.expr("listagg(bits) WITHIN GROUP (ORDER BY bucket)").alias("bits")), "filter")
    return lambda c: _bit_set(found.scalar(), slot(c))


def _bit_set(bits: Column, slot: Column) -> Column:
    place = F.bitmap_bucket_number(slot) * 32768 + F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (F.call_function("shiftright", byte, (place % 8).cast("int")) % 2) == 1


def row_key() -> Column:
    """A digest of doc_id and text: rows of one document that are alike share it."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(doc_id, F.lit(":"), F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary")))


def _full_sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, items): the whole shingle set of every (node, row_key); only these rows of `docs` move."""
    passes = _may_hold(nodes, "row_key")
    chosen = docs.where(passes(F.col("row_key"))).join(nodes, "row_key").select("node", "text")
    sets = chosen.mapInArrow(_sets(shingle), "node long, items binary")
    return stored(sets.groupBy("node").agg(F.min("items").alias("items")), "sets")


def confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, shingle: int, similar: int, of: int) -> DataFrame:
    """Those (low, high) whose full sets meet the similarity; only documents in a pair are read into sets."""
    ends = pairs.select(F.explode(F.array("low", "high")).alias("node")).distinct()
    sets = _full_sets(docs, stored(classes.join(ends, "node").select("node", "least.row_key"), "paired"), shingle)
    low = sets.select(F.col("node").alias("low"), F.col("items").alias("items_low"))
    high = sets.select(F.col("node").alias("high"), F.col("items").alias("items_high"))
    return pairs.join(low, "low").join(high, "high").mapInArrow(_similar(similar, of), "low long, high long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    similar: int = 80,
    of: int = 100,
    coordinates: int = 64,
    sketch: int = 512,
    miss: float = 1e-5,
) -> DataFrame:
    """Groups of documents linked by of * intersection >= similar * union of their shingle sets.

    Takes doc_id (long) and text; returns per row doc_id, n_shingles, component_id (least doc_id reachable
    through links), kept (doc_id = component_id), row_key and first (whether the row is its group's to keep: the one of
    least doc_id, null last, then of least row_key). Words are runs of non-space characters, A-Z lower-cased.

    1. One pass makes each set's digest, `coordinates` keys (one for each coordinate and value) and a sketch of
       `sketch` one-byte coordinates. Equal sets become one numbered node.
    2. Nodes are posted under their keys. Keys of one node are dropped. A pair needs `match_threshold` matches,
       so it shares one of a node's rarest keys: only those are posted (prefix), long lists of common passages
       are skipped, and a node with too few shared keys cannot have a partner at all.
    3. Every list compares its members' sketches with one pivot's; each node's `TRIED` likeliest pivots are
       confirmed on full sets. These links join components; pairs that were not tried are left to step 4.
    4. What is left to compare in a list are pairs of different components; a list beyond `BLOCK` members is
       compared by pairs of blocks. Sketches above the match threshold make clusters, whose full sets meet in one task
       (beyond `BLOCK_BYTES`, in pairs of blocks): there pairs are confirmed, and those that are joined already passed
       over, so that n members make at most n - 1 links.

    A link is missed only if matches fall below a threshold, which happens to a pair exactly at the limit
    with probability `miss` for each of the two. Nothing is capped. Null or blank texts have no shingles and link
    with nothing; each is first. Every row is judged by its own text: rows that repeat a doc_id with other texts are
    documents of their own, and rows without a doc_id too, whose component_id is null if no row of the group has one.
    Rows alike in doc_id and text share one row_key and one verdict.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    least = match_threshold(coordinates, similar / of, miss)
    agree = match_threshold(sketch, similar / of, miss)
    signed = stored(
        docs.mapInArrow(
            _signed(shingle, coordinates, sketch),
            "doc_id long, row_key binary, n_shingles long, digest binary, posts array<long>, sketch binary",
        ),
        "signed",
    )
    classes = stored(
        signed.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("least"),
            F.first("posts").alias("posts"),
            F.first("sketch").alias("sketch"),
            F.first("n_shingles").alias("n_shingles"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    posts = classes.select("node", F.explode("posts").alias("key"))
    often = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (
        posts.join(often, "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("ranked"))
        .where(F.size("ranked") >= least)
        .select("node", F.expr(f"transform(slice(ranked, 1, size(ranked) - {least - 1}), x -> x.key)").alias("prefix"))
    )
    nodes = stored(ranked.join(classes.select("node", "sketch", "n_shingles"), "node"), "nodes")
    lists = nodes.select("node", F.explode("prefix").alias("key"))

    pivots = lists.groupBy("key").agg(
        F.min_by("node", F.xxhash64("node", "key")).alias("pivot"), F.count("*").alias("n")
    )
    sketches = nodes.select("node", "sketch")
    pivots = pivots.where("n > 1").join(sketches.withColumnsRenamed({"node": "pivot", "sketch": "other"}), "pivot")
    stars = lists.join(pivots.drop("n"), "key").where("node <> pivot").join(sketches, "node")
    agreeing = stars.select("node", "pivot", "sketch", "other").mapInArrow(
        _agreeing(agree), "node long, pivot long, matches int"
    )
    # a node met its keys' pivots, at most one a key; the likeliest few are enough to join most components
    likely = agreeing.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("matches", "pivot")), False).alias("best"))
    likely = likely.select("node", F.explode(F.slice("best", 1, TRIED)).alias("b")).select("node", "b.pivot")
    likely = stored(
        likely.select(F.least("node", "pivot").alias("low"), F.greatest("node", "pivot").alias("high")).distinct(), "stars"
    )
    first_links = stored(confirmed(docs, likely, classes, shingle, similar, of), "linked")

    labels = components(first_links)
    labelled = lists.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("label"))
    split = labelled.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n")
    )
    split = split.where("least <> most").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    open_lists = (
        _facing(labelled.join(split, "key"), "blocks", "block", "one", "two")
        .join(nodes.drop("n_shingles"), "node")
        .repartition("key", "one", "two")
        .sortWithinPartitions("key", "one", "two")
    )
    clusters = stored(
        open_lists.mapInArrow(_within_lists(agree), "key long, one int, two int, cluster long, node long, label long"), "clusters"
    )
    known = classes.join(clusters.select("node").distinct(), "node")
    sets = _full_sets(docs, stored(known.select("node", "least.row_key"), "clustered"), shingle)
    sized = clusters.join(known.select("node", "sketch", "n_shingles"), "node")
    cluster = ["key", "one", "two", "cluster"]
    parts = sized.groupBy(*cluster).agg(F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES).cast("int").alias("parts"))
    together = (
        _facing(sized.drop("n_shingles").join(parts, cluster), "parts", "part", "first", "second")
        .join(sets, "node")
        .repartition(*cluster, "first", "second")
        .sortWithinPartitions(*cluster, "first", "second", "node")
    )
    rest = stored(together.mapInArrow(_linked(agree, similar, of), "low long, high long"), "rest")
    roots = components(first_links.unionByName(rest))
    heads = roots.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("head"))
    of_class = (
        classes.select("digest", "node", "least")
        .join(roots.join(heads, "root").select("node", "head"), "node", "left")
        .select("digest", F.coalesce("head", "least").alias("head"))
    )
    own = F.col("digest").isNull()
    return (
        signed.select("doc_id", "row_key", "n_shingles", "digest")
        .join(of_class, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(own, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
            "row_key",
            (own | (F.col("row_key") == F.col("head.row_key"))).alias("first"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near copies in all documents: 3-word shingles, similarity 0.85."""
    found = near_duplicates(read_documents(spark, folder), shingle=3, similar=85, of=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")

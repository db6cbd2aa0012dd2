"""Phrases whose words stand together more often than their parts: counted in FM-indexes over word ids."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.shared_files import file_folder, reading, stored, writing
from tidemark.llm.shipping import ship
from tidemark.llm.text_arrays import bytes_of, mix, slices, word_bounds

WORDS_PER_SHARD = 1_200_000
ROWS_OUT = 100_000
SLICE_BYTES = 1 << 20
SALTS = 64
MOST_FILTER_BITS = 1 << 26
REACHES, COVERED, COVERS = range(3)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = _ENDS.copy()
_BLANK[list(b" \t")] = True


def word_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (A-Z lower-cased, binary) of some texts in order, and whether a piece begins with each."""
    data, offsets = bytes_of(texts, lower=True)
    starts, ends, first_word = word_bounds(data, offsets, _BLANK)
    ended = np.cumsum(_ENDS[data])[starts] if len(starts) else np.zeros(0, np.int64)
    begins = np.diff(ended, prepend=-1) != 0
    begins[first_word[:-1][first_word[:-1] < len(starts)]] = True
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    held = data[~_BLANK[data]]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(held)]), begins


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the keys, rank of each key's value); keys and places are sorted as one number if they fit."""
    size = len(keys)
    width = max(1, (size - 1).bit_length())
    if int(keys.max()).bit_length() + width <= 63:
        packed = np.sort(keys << width | np.arange(size))
        order = packed & ((1 << width) - 1)
        values = packed >> width
    else:
        order = np.argsort(keys)
        values = keys[order]
    ranks = np.empty(size, dtype=np.int64)
    ranks[order] = np.cumsum(np.diff(values, prepend=values[0]) != 0)
    return order, ranks


def transform(text: np.ndarray, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform of `text` (ids; 0 ends a piece, and the text), suffixes ordered by `depth` ids.

    Ranks of runs of 1, 2, 4, ... ids come from pairs of ranks of half the length. Runs of `depth` ids are enough: an
    interval of a phrase of up to `depth` ids holds the same suffixes as in the full order.
    """
    ranks, length = text.astype(np.int64), 1
    order = None
    while length < depth or order is None:
        order, ranks = _ranked(ranks * (int(ranks.max()) + 1) + np.roll(ranks, -length))
        length *= 2
    return text[order - 1]


class FMIndex:
    """Intervals of phrases in a text and in its reverse: one extends a phrase to the left, the other to the right."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.bwt = {"left": forward.astype(np.int32), "right": backward.astype(np.int32)}
        self.size = len(forward)

    @functools.cached_property
    def firsts(self) -> np.ndarray:
        """How many ids are smaller than 0, 1, 2, ...; the interval of a single id."""
        return np.concatenate([[0], np.cumsum(np.bincount(self.bwt["left"]))])

    def extend(self, side: str, near: np.ndarray, far: np.ndarray, counts: np.ndarray, passes):
        """The extensions of the phrases by one word on `side` that pass, in order of phrase and word.

        `near` are the starts of their intervals in the index that reads on that side, `far` those in the other.
        `passes(phrase numbers, words)` tells which extensions to keep. Returns arrays: phrase number, word, start in the
        near index, start in the far index, count.
        """
        bwt = self.bwt[side]
        before = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) + np.repeat(near - before, counts)
        width = len(self.firsts)
        found, n = np.unique(np.repeat(np.arange(len(counts)), counts) * width + bwt[at], return_counts=True)
        phrase, word = found // width, found % width
        # all words of a phrase stand side by side, so the smaller ones before a word shift it in the far index
        new_far = far[phrase] + np.cumsum(n) - n - before[phrase]
        keep = np.flatnonzero(word > 0)
        keep = keep[passes(phrase[keep], word[keep])]
        phrase, word, n, new_far = phrase[keep], word[keep], n[keep], new_far[keep]
        # rank: the places of one word in the transform are a run of this sorted list
        places = np.sort(bwt.astype(np.int64) * self.size + np.arange(self.size))
        return phrase, word, np.searchsorted(places, word * self.size + near[phrase]), new_far, n


def _planes(values: np.ndarray) -> bytes:
    return pa.Codec("zstd", 1).compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def _save(uri: str, index: FMIndex) -> None:
    """Both transforms, each as four byte planes compressed together, behind three lengths."""
    left, right = _planes(index.bwt["left"]), _planes(index.bwt["right"])
    with writing(uri) as out:
        out.write(np.array([index.size, len(left), len(right)], "<i8").tobytes() + left + right)


def _load(uri: str) -> FMIndex:
    with reading(uri) as stream:
        size, left, right = np.frombuffer(stream.read(24), "<i8").tolist()
        both = [
            np.frombuffer(pa.Codec("zstd").decompress(stream.read(n), 4 * size), np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]
            for n in (left, right)
        ]
    return FMIndex(*both)


_WORDS = "shard long, lang string, word string, start long, n long"


class _Shard:
    """Words gathered for one index."""

    def __init__(self):
        self.size = 0
        self.parts: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}

    def add(self, lang: str, words: pa.Array, begins: np.ndarray) -> None:
        self.parts.setdefault(lang, []).append((words, begins))
        self.size += len(words) + int(begins.sum())

    def text(self) -> tuple[np.ndarray, list[tuple[str, pa.Array]]]:
        """Ids from 1 with 0 around every piece, and the words of these ids by language."""
        ids, begins, known, taken = [], [], [], 0
        for lang, parts in self.parts.items():
            coded = pa.concat_arrays([words for words, _ in parts]).dictionary_encode()
            ids.append(coded.indices.to_numpy().astype(np.int64) + taken + 1)
            begins += [b for _, b in parts]
            known.append((lang, coded.dictionary))
            taken += len(coded.dictionary)
        ids, begins = np.concatenate(ids), np.concatenate(begins)
        places = np.arange(len(ids)) + np.cumsum(begins)
        text = np.zeros(int(places[-1]) + 2, dtype=np.int64)
        text[places] = ids
        return text, known


def _indexed(folder: str, depth: int, words_per_shard: int):
    """Write an FM-index of every stretch of documents; return the words of each."""

    def flush(shard: _Shard) -> pa.RecordBatch:
        text, known = shard.text()
        # a file is named by all it holds: another attempt at this task writes the same one or another name
        name = hashlib.blake2b(text.tobytes(), digest_size=8)
        for lang, words in known:
            name.update(lang.encode() + b"\0")
            for buffer in words.buffers()[1:]:
                name.update(buffer or b"")
        number = int.from_bytes(name.digest(), "little") >> 1
        index = FMIndex(transform(text, depth), transform(text[::-1], depth))
        _save(f"{folder}/{number:016x}.fm", index)
        langs = pa.concat_arrays([pa.repeat(pa.scalar(lang), len(words)) for lang, words in known])
        words = pa.concat_arrays([words for _, words in known]).cast(pa.large_string()).cast(pa.string())
        columns = [index.firsts[1:-1], np.diff(index.firsts)[1:]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(words), number), pa.int64()), langs, words, *[pa.array(x, pa.int64()) for x in columns]],
            names=["shard", "lang", "word", "start", "n"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            langs = batch.column(0)
            for lang in langs.unique().to_pylist():
                for _, piece in slices(batch.column(1).filter(pc.equal(langs, lang)), SLICE_BYTES):
                    words, begins = word_runs(piece)
                    cuts, first = np.flatnonzero(begins), 0
                    while first < len(words):
                        # up to the first piece that begins when the shard is full
                        at = np.searchsorted(cuts, first + max(1, words_per_shard - shard.size))
                        stop = int(cuts[at]) if at < len(cuts) else len(words)
                        shard.add(lang, words.slice(first, stop - first), begins[first:stop])
                        first = stop
                        if shard.size >= words_per_shard:
                            yield flush(shard)
                            shard = _Shard()
        if shard.size:
            yield flush(shard)

    return work


def slots(ids: list[np.ndarray], bits: int) -> np.ndarray:
    """A place from 0 to bits - 1 for each tuple of ids, given as columns."""
    found = np.full(len(ids[0]), len(ids), dtype=np.uint64)
    for column in ids:
        found = mix(found ^ column.view(np.uint64))
    return (found & np.uint64(bits - 1)).view(np.int64)


def _slotted(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = slots([column.to_numpy() for column in batch.columns], bits)
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["slot"])

    return work


def _sieve(tuples: DataFrame) -> tuple[int, bytes]:
    """(bits, bit map) of a table of ids: 16 bits and more a row, but 8 MB at most, beyond which more others pass."""
    wanted = max(1 << 15, 1 << (16 * tuples.count()).bit_length())
    bits = min(wanted, MOST_FILTER_BITS)
    marked = tuples.mapInArrow(_slotted(bits), "slot long").select((F.col("slot") + 1).alias("slot"))
    maps = marked.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("map")
    )
    found = bytearray(bits // 8)
    for bucket, part in maps.collect():
        found[(bucket - 1) * 4096 : bucket * 4096] = part
    return bits, bytes(found)


def _may_hold(sieve: tuple[int, bytes], ids: list[np.ndarray]) -> np.ndarray:
    bits, marks = sieve
    slot = slots(ids, bits)
    return (np.frombuffer(marks, np.uint8)[slot >> 3] >> (slot & 7) & 1).astype(bool)


def _may_decide(sieve: tuple[int, bytes], ids: list[np.ndarray]) -> np.ndarray:
    """Whether both parts of one word less, without the last and without the first word, carry marks that go together."""
    marked = lambda kind, at: _may_hold(sieve, [np.full(len(ids[0]), 2 * kind + at), *(ids[1:] if at else ids[:-1])])
    found = marked(REACHES, 0) & marked(REACHES, 1)
    found |= marked(COVERED, 0) & marked(COVERS, 1)
    return found | marked(COVERS, 0) & marked(COVERED, 1)


def _counted(folder: str, length: int, sieves: list, deciding=None):
    """Count the phrases of `length` words in every shard, given its frequent words.

    Words are extended to the right and to the left in turn, both intervals in step. sieves[i] tells which phrases of
    i + 2 words may be frequent; an extension is followed only if the shorter phrase at its other end may be, too.
    With `deciding`, marks of the phrases of one word less, phrases of `length` words that cannot decide are not counted.
    """

    def counted(shard: int, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _load(f"{folder}/{shard:016x}.fm")
        table = pa.Table.from_batches(rows)
        number, start, n = (table.column(c).to_numpy() for c in ("id", "start", "n"))
        named = np.full(len(index.firsts), -1, dtype=np.int64)
        named[np.searchsorted(index.firsts, start, side="right") - 1] = number
        intervals, ids = {"left": start, "right": start}, [number]
        for words in range(2, length + 1):
            side, other = ("right", "left") if words % 2 == 0 else ("left", "right")

            def passes(phrase, word, words=words, side=side, ids=ids):
                keep = named[word] >= 0
                if words > 2:
                    rest = [column[phrase[keep]] for column in (ids[1:] if side == "right" else ids[:-1])]
                    new = named[word[keep]]
                    rest = [*rest, new] if side == "right" else [new, *rest]
                    keep[keep] = _may_hold(sieves[words - 3].value, rest)
                if words == length and deciding:
                    whole, new = [column[phrase[keep]] for column in ids], named[word[keep]]
                    keep[keep] = _may_decide(deciding.value, [*whole, new] if side == "right" else [new, *whole])
                return keep

            phrase, word, near, far, n = index.extend(side, intervals[side], intervals[other], n, passes)
            ids = [column[phrase] for column in ids]
            ids = [*ids, named[word]] if side == "right" else [named[word], *ids]
            if words < length:
                keep = _may_hold(sieves[words - 2].value, ids)
                near, far, n, ids = near[keep], far[keep], n[keep], [column[keep] for column in ids]
            intervals = {side: near, other: far}
        names = [*[f"w{i}" for i in range(1, length + 1)], "n"]
        for first in range(0, len(n), ROWS_OUT):
            part = [pa.array(x[first : first + ROWS_OUT], pa.int64()) for x in (*ids, n)]
            yield pa.RecordBatch.from_arrays(part, names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for first, stop in zip(cuts, cuts[1:], strict=False):
                if first < stop:
                    if held and shards[first] != shard:
                        yield from counted(shard, held)
                        held = []
                    shard = int(shards[first])
                    held.append(batch.slice(first, stop - first))
        if held:
            yield from counted(shard, held)

    return work


def phrases(
    docs: DataFrame,
    longest: int = 4,
    least: int = 30,
    lang: str = "lang",
    text: str = "text",
    words_per_shard: int = WORDS_PER_SHARD,
    deciding: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(phrases of 1 to `longest` words that occur `least` times in their language, words per language).

    Phrases: lang, phrase, length, f (occurrences), heads and tails (occurrences of its first 1, 2, ... words; of all its
    words, all but the first, ...), and ids, an array with a number for each word. Words per language: lang, total.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and those into words at blanks and tabs.
    A null text is empty; a null language is `und`.

    1. Tasks index their documents in shards of about `words_per_shard` words (a piece is never cut) and write each
       FM-index to the shared folder. Words are counted over all shards.
    2. Each further word: every shard extends the intervals of its frequent words, to the right and to the left in turn,
       through phrases that may be frequent, and counts are summed over shards. A bit map of bounded size says which may:
       it lets some others pass, whose extensions are too rare to be kept, and never loses one.
    3. `deciding`, if given, marks phrases of `longest` - 1 words, from all phrases up to these: (kind, w1, w2, ...). Of
       the phrases of `longest` words those that these marks exclude (`_may_decide`) are then neither counted nor returned.

    A shard's intervals are fewer than its words; nothing else is gathered in one task.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = file_folder(spark, "fm-index")
    chosen = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    rows = stored(chosen.mapInArrow(_indexed(folder, longest, words_per_shard), _WORDS), "words")
    totals = rows.groupBy("lang").agg(F.sum("n").alias("total"))
    sums = rows.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    words = stored(sums.withColumn("id", F.monotonically_increasing_id()), "frequent-words")
    alive = rows.join(words.select("lang", "word", "id"), ["lang", "word"]).select("shard", "id", "start", "n")
    state = stored(alive, "alive-words").repartition("shard").sortWithinPartitions("shard")
    found = level = words.select(
        "lang", F.col("word").alias("phrase"), F.lit(1).alias("length"), "f",
        F.array("f").alias("heads"), F.array("f").alias("tails"), F.array("id").alias("ids"),
    )
    sieves = []
    for length in range(2, longest + 1):
        ids = [f"w{i}" for i in range(1, length + 1)]
        marks = spark.sparkContext.broadcast(_sieve(deciding(found))) if deciding and length == longest else None
        counts = state.mapInArrow(_counted(folder, length, sieves, marks), ", ".join(f"{c} long" for c in [*ids, "n"]))
        frequent = stored(counts.groupBy(*ids).agg(F.sum("n").alias("f")).where(F.col("f") >= least), "frequent")
        sieves = [*sieves, spark.sparkContext.broadcast(_sieve(frequent.drop("f")))]
        first = level.select(F.col("ids").alias("prefix"), "lang", F.col("phrase").alias("begin"), "heads")
        second = level.select(F.col("ids").alias("suffix"), F.col("phrase").alias("end"), "tails")
        level = stored(
            frequent.select("f", F.array(*ids).alias("ids"), F.array(*ids[:-1]).alias("prefix"), F.array(*ids[1:]).alias("suffix"))
            .join(first, "prefix")
            .join(second, "suffix")
            .select(
                "lang",
                F.concat_ws(" ", "begin", F.substring_index("end", " ", -1)).alias("phrase"),
                F.lit(length).alias("length"),
                "f",
                F.concat("heads", F.array("f")).alias("heads"),
                F.concat(F.array("f"), "tails").alias("tails"),
                "ids",
            ),
            "phrases",
        )
        found = found.unionByName(level)
    return found, totals


_CUT = (
    "array_min(transform(sequence(1, length - 1), k -> named_struct('score', CAST(f AS DECIMAL(20, 0)) * 2000000 div"
    " (heads[k - 1] + tails[k]), 'k', k, 'l', heads[k - 1], 'r', tails[k])))"
)


def _uncovered(found: DataFrame, covered: int, of: int) -> DataFrame:
    """The phrases that none of one word more covers."""
    inner = F.array(F.expr("slice(ids, 1, length - 1)"), F.expr("slice(ids, 2, length - 1)"))
    longer = found.where("length > 2").select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("within"))
    return found.join(longer, "ids", "left").where(
        F.col("within").isNull() | (F.lit(of) * F.col("within") < F.lit(covered) * F.col("f"))
    )


def _best(found: DataFrame, most: int) -> DataFrame:
    """The `most` highest scored phrases of each language: lang, phrase, a, l, r, score, near, rank."""
    scored = found.select("lang", "phrase", F.col("f").alias("a"), F.expr(_CUT).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    ranked = Window.partitionBy("lang").orderBy(*best)
    return (
        scored.withColumn("near", F.row_number().over(salted))
        .where(F.col("near") <= most)
        .withColumn("rank", F.row_number().over(ranked).cast("long"))
        .where(F.col("rank") <= most)
    )


def _deciding(longest: int, least: int, covered: int, of: int, most: int) -> Callable[[DataFrame], DataFrame]:
    """Marks that tell which phrases of `longest` words the `most` best of a language may depend on.

    Some are settled before: those of up to `longest` - 2 words, and those of a word more whose neighbours are too rare to
    cover them. Of the phrases of `longest` words, those made of a first part and a rest that share the words between occur
    f(first part) + f(rest) - f(words between) times at least; the most frequent pair of each such middle is taken with
    this count. The `most`-th best score of all these is a floor, which
    a phrase must reach (0 if there are fewer). One of `longest` words, of a occurrences, then matters only if it reaches
    the floor itself or covers one of a word less that does. Both its parts of a word less occur a times at least, and it
    scores at most 2000000 * a / (f(word at either end) + a). Per part, as the first (0) or the last (1) of a phrase, looking
    at all parts that share the words between:

    REACHES: this bound reaches the floor with its own count, and with the highest count of such parts on the other side.
    COVERED: it reaches the floor, and a part on the other side is frequent enough for both to cover it.
    COVERS: it is frequent enough to cover such a part on the other side.
    """

    def marks(found: DataFrame) -> DataFrame:
        found = found.where("length > 1")
        ends = found.where(F.col("length") == longest - 1).selectExpr(
            "*",
            "inline(array(struct(0 AS at, slice(ids, 2, length - 1) AS middle, heads[0] AS edge),"
            " struct(1 AS at, slice(ids, 1, length - 1) AS middle, tails[length - 1] AS edge)))",
        )
        other = (1 - F.col("at")).alias("at")
        highest = ends.groupBy(other, "middle").agg(F.max("f").alias("highest"))
        open_ends = ends.join(highest, ["at", "middle"]).where(F.lit(of) * F.col("highest") >= F.lit(covered) * F.col("f"))
        sure = found.where(F.col("length") == longest - 1).join(open_ends.select("ids"), "ids", "left_anti")
        settled = _uncovered(found, covered, of).where(F.col("length") < longest - 1).drop("within").unionByName(sure)
        part = F.struct("f", "ids", "heads", "tails")
        pairs = ends.groupBy("lang", "middle").agg(
            F.max(F.when(F.col("at") == 0, part)).alias("first"), F.max(F.when(F.col("at") == 1, part)).alias("rest")
        )
        common = pairs.withColumn("f", F.expr("first.f + rest.f - first.tails[1]")).where(F.col("f") >= max(least, 1))
        certain = common.selectExpr(
            "lang", "CAST(middle AS STRING) AS phrase", f"{longest} AS length", "f",
            "first.heads AS heads", "concat(array(f), rest.tails) AS tails", "middle AS ids",
        )
        known = settled.unionByName(certain)
        floors = _best(known, most).where(F.col("rank") == most).select("lang", F.col("score").alias("floor"))
        bound = "CAST({0} AS DECIMAL(20, 0)) * 2000000 div (edge + {0}) >= floor"
        sides = (
            ends.join(F.broadcast(floors), "lang", "left")
            .withColumn("floor", F.coalesce("floor", F.lit(0)))
            .withColumn("stays", F.expr(f"{_CUT}.score >= floor"))
        )
        others = sides.groupBy(other, "middle").agg(
            F.max("f").alias("highest"),
            F.max(F.when(F.expr(bound.format("f")), F.col("f"))).alias("reaching"),
            F.min(F.when(F.col("stays"), F.col("f"))).alias("lowest"),
        )
        kinds = {
            REACHES: F.col("reaching").isNotNull() & F.expr(bound.format("least(f, reaching)")),
            COVERED: F.col("stays") & (F.lit(of) * F.col("highest") >= F.lit(covered) * F.col("f")),
            COVERS: F.lit(of) * F.col("f") >= F.lit(covered) * F.col("lowest"),
        }
        marked = F.array(*[F.when(holds, 2 * F.lit(kind) + F.col("at")).cast("long") for kind, holds in kinds.items()])
        words = [F.col("ids")[i].alias(f"w{i + 1}") for i in range(longest - 1)]
        return sides.join(others, ["at", "middle"]).select(F.explode(F.array_compact(marked)).alias("kind"), *words)

    return marks


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, of: int = 100, most: int = 2000, **options
) -> DataFrame:
    """The `most` highest scored phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Cutting a phrase of `a` occurrences into a first part (l) and a rest (r) scores floor(2000000 * a / (l + r)); its lowest
    score counts, of equal ones that of the earliest cut. A phrase goes if a longer one, of at most `longest` words, holds
    it and of * f(longer) >= covered * a. Since a longer phrase is no more frequent than the ones between, it is enough to
    look at phrases of one word more. Order: score, then a, descending, then the phrase in byte order. Products are
    decimals, which hold more than 64 bits. Options are those of `phrases`.

    Phrases of `longest` words are most of the different ones, and with more text ever more of them are frequent. Only
    those that the result may depend on are counted (`_deciding`).
    """
    deciding = _deciding(longest, least, covered, of, most) if longest > 3 else None
    found, totals = phrases(docs, longest, least, deciding=deciding, **options)
    return (
        _best(_uncovered(found.where("length > 1"), covered, of), most)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 phrases of 2 to 4 words of every language."""
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"))


_CUTS = " UNION ALL ".join(
    f"SELECT g.lang, g.phrase, g.a, {k} AS k, p.f AS l, q.f AS r FROM grams g"
    f" JOIN words_of p ON p.lang = g.lang AND p.phrase = array_to_string(g.words[:{k}], ' ')"
    f" JOIN words_of q ON q.lang = g.lang AND q.phrase = array_to_string(g.words[{k + 1}:], ' ') WHERE g.length > {k}"
    for k in (1, 2, 3)
)
_INNER = " UNION ALL ".join(
    f"SELECT lang, array_to_string(words[{i}:{i + k - 1}], ' ') AS phrase, a FROM grams WHERE length = {length}"
    for length in (3, 4)
    for k in range(2, length)
    for i in range(1, length - k + 2)
)
_RUNS = " UNION ALL ".join(
    f"SELECT lang, {k} AS length, words[i:i + {k - 1}] AS words"
    f" FROM (SELECT lang, words, unnest(range(1, len(words) - {k} + 2)) AS i FROM split_up)"
    for k in (1, 2, 3, 4)
)
ORACLE = rf"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), parts AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered
), split_up AS (
  SELECT lang, words FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM parts) WHERE len(words) > 0
), runs AS ({_RUNS}
), words_of AS (
  SELECT lang, length, array_to_string(words, ' ') AS phrase, any_value(words) AS words, count(*)::BIGINT AS f
  FROM runs GROUP BY lang, length, array_to_string(words, ' ')
), grams AS (
  SELECT lang, length, phrase, words, f AS a FROM words_of WHERE length > 1 AND f >= 30
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM split_up GROUP BY lang
), inner_phrases AS (
  SELECT lang, phrase, max(a) AS within FROM ({_INNER}) GROUP BY lang, phrase
), cuts AS ({_CUTS}
), scored AS (
  SELECT *, (2000000::HUGEINT * a // (l + r))::BIGINT AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
  FROM lowest LEFT JOIN inner_phrases i ON i.lang = lowest.lang AND i.phrase = lowest.phrase
  WHERE i.within IS NULL OR 100 * i.within < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

"""WARC, winnowing, token files, byte-level BPE and importance resampling against plain versions."""

import base64
import hashlib
import io
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, importance, text_arrays, token_planes, warc, winnowing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n", "a  b", "x\n\n y\t", " lead", "tail ", "é𝒳 naïve İI", "don't  'S", "a" * 3000, "1234567 12 3", "z\x1cz  q"]


def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(k): int(r) for k, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


# byte-level BPE


def test_bpe_equals_library_on_random_texts():
    wanted, ranks = library()
    encoder = byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
    draw, letters = random.Random(5), "ab '\n\t  \r\x1c\x85é̀1２世 .,!s  İ"
    for _ in range(4000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(16)))
        assert encoder.encode(text).tolist() == wanted.encode_ordinary(text), repr(text)
    assert len(set(encoder.table.keys)) == len(ranks) == encoder.table.size
    assert all(encoder.table.get(k) == r for k, r in ranks.items()) and encoder.table.get(b"\xff\xfe\xfd") == -1


def test_bpe_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_REMEMBERED_BYTES", 8000)
    _, ranks = library()
    encoder = byte_bpe.ByteBPE(ranks, public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(500)) + " " + "y" * 200
    assert encoder.decode(encoder.encode(text).tolist()) == text.encode()
    assert len(encoder.pieces) <= 50 and all(len(k) <= byte_bpe.LONGEST_REMEMBERED for k in encoder.pieces)


def test_bpe_round_trip_of_rows(spark, documents):
    wanted, _ = library()
    docs = documents(list(enumerate(ODD)) + [(3, "\n")], ids="clash", n_tokens=9)
    rows = byte_bpe.round_trip(docs, RANKS).collect()
    assert len(rows) == len(ODD) + 1
    for row in rows:
        ids = wanted.encode_ordinary(ODD[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((ODD[row.doc_id] or "").encode()).hexdigest()
    encoded = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS)
    assert encoded.where("decoded <> cast(coalesce(text, '') AS binary)").count() == 0
    assert byte_bpe.round_trip(documents([]), RANKS).count() == 0


# token files


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("width", [2, 4])
def test_planes_round_trip(bits, width):
    draw = np.random.default_rng(2)
    for count in (1, 7, 8, 9, 1000):
        ids = draw.integers(0, 256**width - 1, count, dtype=np.uint64).astype(f"<u{width}")
        planes = token_planes.to_planes(ids, width, bits)
        assert len(planes) == (8 * width if bits else width)
        assert (token_planes.from_planes(planes, count, width, bits) == ids).all()


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("bits", [False, True])
def test_token_file_round_trip(bits, monkeypatch):
    monkeypatch.setattr(token_planes, "INDEX_ROWS", 5)
    draw, out = random.Random(3), io.BytesIO()
    rows = [(None if i == 2 else i, np.array([draw.randrange(60000) for _ in range(draw.choice([0, 1, 30, 500]))], "<u2")) for i in range(40)]
    writer = token_planes.TokenFileWriter(out, 2, bits, block=64)
    for doc_id, ids in rows:
        writer.add(doc_id, ids)
    writer.close()
    back = list(token_planes.read_token_file(Source(out.getvalue())))
    assert [d for d, _ in back] == [d for d, _ in rows]
    assert all((a == b).all() and len(a) == len(b) for (_, a), (_, b) in zip(back, rows, strict=True))
    with pytest.raises(ValueError):
        list(token_planes.read_token_file(Source(out.getvalue()[:-3])))


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_equal_library(spark, documents, bits):
    texts = [*ODD, "The cat's <|endoftext|> mat", "# hash"] * 2
    rows = [(3 * i - 20, t) for i, t in enumerate(texts)]
    docs = documents(rows[::-1], start=4, ids_crc32="clash")
    found = token_planes.read_token_files(token_planes.write_token_files(docs, WORDS, 2, bits, rows_per_file=7))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found.collect()}
    library, start = Tokenizer.from_file(WORDS), 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert found[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), repr(text)
        start += len(ids)


def test_token_files_of_odd_tables(spark, documents):
    assert token_planes.read_token_files(token_planes.write_token_files(documents([]), WORDS, 2)).count() == 0
    rows = documents([(4, "b"), (None, "c"), (4, "a"), (4, "a")])
    found = token_planes.read_token_files(token_planes.write_token_files(rows, WORDS, 2)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in found] == [(None, 0, 2), (4, 2, 2), (4, 4, 2), (4, 6, 2)]


# winnowing


def test_every_window_has_its_rightmost_least():
    draw = random.Random(1)
    for _ in range(30):
        text = "".join(draw.choice("aAb \n") for _ in range(draw.randrange(1, 200)))
        hashes, places = winnowing.fingerprint(winnowing.code_points(text), 4, 5)
        kept = [i for i, c in enumerate(text) if c not in " \n"]
        if len(kept) < 4:
            assert len(places) == (1 if kept else 0)
            continue
        values = np.array([ord(text[i].lower()) for i in kept])
        grams = winnowing.gram_hashes(values, 4)
        window = min(5, len(grams))
        wanted = {max(j for j in range(i, i + window) if grams[j] == grams[i : i + window].min()) for i in range(len(grams) - window + 1)}
        assert places.tolist() == [kept[j] for j in sorted(wanted)]
        assert (hashes == grams[sorted(wanted)]).all()


def test_hashes_of_stretches_and_match_guarantee(monkeypatch):
    draw = np.random.default_rng(4)
    points = draw.integers(97, 123, 5000)
    whole = winnowing.gram_hashes(points, 16)
    monkeypatch.setattr(winnowing, "_STRETCH", 100)
    assert (winnowing.gram_hashes(points, 16) == whole).all()
    monkeypatch.undo()
    passage = "".join(map(chr, draw.integers(97, 123, winnowing.GRAM + winnowing.WINDOW - 1)))
    one, two = (f"{'q' * 50}{passage}{c * 40}" for c in "vw")
    assert np.intersect1d(*(winnowing.fingerprint(winnowing.code_points(t))[0] for t in (one, two))).size


def test_edited_and_next(spark, documents):
    texts = [None, "", "abc", "A quick brown fox " * 9, "é" * 41, "A quick brown fox " * 9 + "!", "x y z " * 40]
    docs = documents([(5 * i, t) for i, t in enumerate(texts)][::-1], part=1, ahead="clash")
    found = {r.doc_id: r for r in winnowing.edit_likeness(docs).collect()}
    prints = lambda t: winnowing.fingerprint(winnowing.code_points(t))
    for i, text in enumerate(texts):
        own, following, row = text or "", texts[(i + 1) % len(texts)] or "", found[5 * i]
        changed = winnowing.edited(own, following)
        assert row.n_chars == len(own) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.fingerprint == winnowing.digest(*prints(own)) and row.edited_fingerprint == winnowing.digest(*prints(changed))
        assert row.near_edited == winnowing.likeness(prints(own)[0], prints(changed)[0])
        assert row.near_next == winnowing.likeness(prints(own)[0], prints(following)[0])
    assert winnowing.edit_likeness(documents([])).count() == 0
    alone = winnowing.edit_likeness(documents([(None, "only one text here")])).collect()
    assert alone[0].near_next == 1.0


def test_fingerprints_as_rows(spark, documents):
    rows = {r.doc_id: r.prints for r in winnowing.fingerprints(documents([(1, "some text " * 20), (2, None)])).collect()}
    assert rows[2] == [] and rows[1][0].position == winnowing.fingerprint(winnowing.code_points("some text " * 20))[1][0]


# WARC

PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    big = "<p>" + "ä" * 300_000
    rows = [(1, "http://a/1", "same"), (2, "http://a/\r\n2", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", big), (None, "u", "same"), (9, "u", "same"), (6, "u", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash"))
    manifest = warc.write_warc(pages, archive_bytes=300)
    found = warc.read_warc(manifest).collect()
    assert len(found) == len(rows)
    for row in found:
        html = next((h for p, _, h in rows if p == row.page_id)) or ""
        assert row.payload_bytes == len(html.encode())
        assert row.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert row.payload is None if row.record_type == "revisit" else row.payload == html.encode()
    of = {r.page_id: (r.record_type, r.refers_to) for r in found}
    assert of == {1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), None: ("revisit", 9), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), 6: ("response", None)}
    plain = warc.read_warc(warc.write_warc(pages, least_bytes=5), with_payload=False).collect()
    assert {r.record_type for r in plain} == {"response"}
    assert warc.read_warc(warc.write_warc(pages.limit(0))).count() == 0


def test_warc_keeps_any_url(spark):
    urls = ["http://a/" + "x" * 3_000_000, "http://a/ b\tc\r\nWARC-Type: x\r\n\r\n", " lead\u2028 ", "http://a/%20%0D", "é𝒳", "", None]
    pages = spark.createDataFrame([(i, url, "p") for i, url in enumerate(urls)], PAGES)
    found = {r.page_id: r for r in warc.read_warc(warc.write_warc(pages)).collect()}
    assert [found[i].url for i in range(len(urls))] == [url or "" for url in urls]
    assert {r.record_type for r in found.values()} == {"response", "revisit"}


def test_warc_reader_verifies_and_reads_forward():
    digest = warc.base32_sha1(hashlib.sha1(b"hello").digest())
    good = warc.record(1, "http://x", b"hello", digest, None)
    archive = warc.member(good) + warc.member(warc.record(2, "http://y", b"hello", digest, 1))
    whole = list(warc.records(io.BytesIO(archive)))
    assert [r.headers["warc-type"] for r in whole] == ["response", "revisit"]
    assert [r.payload_bytes for r in whole] == [5, 5] and whole[0].payload == b"hello"

    class Drip(io.BytesIO):
        def read(self, size=-1):
            return super().read(min(size, 3) if size > 0 else 3)

    assert len(list(warc.records(Drip(archive)))) == 2
    for broken in (good.replace(b"hello", b"jello"), good.replace(b"Content-Length: 8", b"Content-Length: 7"), good[:-2], good + b"x", b"no" + good):
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(warc.member(broken))))
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(archive[:-20])))


# importance resampling


def test_resample_takes_the_largest_keys(spark, documents):
    draw = random.Random(2)
    good = [(i, " ".join(draw.choice(["the", "of", "and", "river", "stone"]) for _ in range(30))) for i in range(60)]
    bad = [(i, " ".join(draw.choice(["$$$", "win", "!!", "cash"]) for _ in range(30))) for i in range(100, 130)]
    docs = documents([*good, *bad, (200, None), (201, "")], log_weight=1.0, kept=False)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:20]] + [(i, 0, 0) for i, _ in bad[:10]] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    every = {r.doc_id: r.gumbel_key for r in importance.resample(docs, labels, share=1.0).collect()}
    assert len(every) == 92
    chosen = {r.doc_id for r in importance.resample(docs, labels).collect()}
    assert len(chosen) == round(92 * 2 / 3)
    assert min(every[d] for d in chosen) >= max(every[d] for d in set(every) - chosen)
    assert len(chosen & {i for i, _ in good}) >= 58 and not chosen & {i for i, _ in bad}
    assert importance.resample(docs, labels, share=0.0).count() == 0
    assert importance.resample(documents([]), labels).count() == 0
    assert importance.resample(docs, labels.limit(0)).count() == 92


def plain_buckets(text):
    """Buckets of a text's words and word pairs, in plain integers."""
    whole = (1 << 64) - 1

    def spread(value):
        value = (value ^ (value >> 30)) * 0xBF58476D1CE4E5B9 & whole
        value = (value ^ (value >> 27)) * 0x94D049BB133111EB & whole
        return value ^ (value >> 31)

    def word(data):
        if len(data) > 64:
            return xxhash.xxh3_64_intdigest(data)
        return spread(sum((b + 1) * pow(text_arrays._BASE, i, 1 << 64) for i, b in enumerate(data)) & whole)

    def pair(first, second):
        total = 2
        for h in (first, second):
            total = (total ^ h) * 0x9FB21C651E98DF25 & whole
            total ^= total >> 29
        return spread(total)

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [word(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", low)]
    return [h % importance.BUCKETS for h in [*words, *map(pair, words, words[1:])]]


def test_weights_equal_plain_version(spark, documents):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice(["the", "The", "of", "río", "$$", "x" * 70, "𝒳"]) for _ in range(draw.randrange(40)))) for i in range(80)]
    rows += [(200, None), (201, " \n"), (3, "a second text"), (None, "the of")]
    labels = [(i, i % 2) for i in range(30)] + [(1, 0), (5, 1), (200, 1), (None, 1), (7, None)]
    quality = {}
    for doc_id, good in labels:
        if doc_id is not None and good is not None:
            quality[doc_id] = min(good, quality.get(doc_id, 1))
    raw, target = np.ones(importance.BUCKETS), np.ones(importance.BUCKETS)
    for doc_id, text in rows:
        for bucket in plain_buckets(text):
            raw[bucket] += 1
            target[bucket] += quality.get(doc_id, 0)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())

    def noise(doc_id):
        digits = hashlib.md5(f"resample|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:12]
        return -math.log(-math.log((int(digits, 16) + 0.5) / (1 << 48)))

    table = spark.createDataFrame(labels, "doc_id long, quality int").repartition(3)
    found = sorted((r.doc_id or -1, r.log_weight, r.gumbel_key) for r in importance.resample(documents(rows), table, share=1.0).collect())
    wanted = sorted((i or (-1 if i is None else 0), sum(ratio[b] for b in plain_buckets(t)), i) for i, t in rows[1:])
    wanted = [(i, weight, weight + noise(whole)) for i, weight, whole in wanted]
    assert [r for r in found if r[0] > 0] == [pytest.approx(r) for r in wanted if r[0] > 0]
    _, share = importance.gram_ratios(documents(rows), table, 20_000)
    assert share == pytest.approx(sum(quality.values()) / len(quality))


def test_equal_keys_are_drawn_by_doc_id(spark, documents, monkeypatch):
    monkeypatch.setattr(importance, "draw", lambda seed, *parts: F.lit(0.5))
    docs = documents([(i, "same text") for i in range(50)])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert sorted(r.doc_id for r in importance.resample(docs, labels, share=0.2).collect()) == list(range(10))

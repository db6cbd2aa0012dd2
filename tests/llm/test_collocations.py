import collections
import random
import re

import numpy as np
import pytest

from tidemark.llm import collocations as col


def plain_counts(rows, longest=4):
    """(lang, words) -> occurrences; and words per language."""
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    return counts, totals


def plain_collocations(rows, least=30, most=2000, longest=4):
    counts, totals = plain_counts(rows, longest)
    found = {}
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        inside = any(
            lang == other and len(longer) > len(words) and n >= least and 100 * n >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), n in counts.items()
        )
        if not inside:
            cuts = []
            for k in range(1, len(words)):
                l, r = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((2000000 * a // (l + r), k, l, r))
            score, _, l, r = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return {
        lang: [(i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:most], 1)]
        for lang, rows in found.items()
    }


def corpus(seed):
    draw = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a", "b", "é", "X\x00y", "ÀB"]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(draw.randrange(0, 40)):
            text += draw.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "!\r\n", " "]) + draw.choice(words)
            if draw.random() < 0.3:
                text += " New york  city"
            if draw.random() < 0.2:
                text += " one two three four five"
        rows.append((i, text, draw.choice(["en", "en", None, "de", ""])))
    rows += [(500, None, "en"), (501, "", None), (502, " . ,\n", "xx"), (503, "a b " * 400, "en"), rows[0], rows[0], (None, rows[1][1], "de")]
    return rows


def run(docs, **options):
    found = {}
    for r in col.collocations(docs, **options).orderBy("lang", "rank").collect():
        found.setdefault(r.lang, []).append(tuple(r[1:]))
    return found


@pytest.mark.parametrize("least,most,words_per_shard", [(30, 2000, 2_000_000), (3, 2000, 200), (5, 7, 50), (1, 40, 1000)])
def test_equals_brute_force(spark, documents, least, most, words_per_shard):
    rows = corpus(least)
    docs = documents([(d, t, lang, "s") for d, t, lang in rows], word="clash", shard=3, id="x", phrase="p").repartition(3)
    assert run(docs, least=least, most=most, words_per_shard=words_per_shard) == plain_collocations(rows, least, most)


def test_other_lengths_and_long_texts(spark, documents, monkeypatch):
    monkeypatch.setattr(col, "SLICE_BYTES", 100)
    rows = corpus(9)
    docs = documents([(d, t, lang, "s") for d, t, lang in rows])
    for longest in (2, 5):
        assert run(docs, longest=longest, least=4, words_per_shard=300) == plain_collocations(rows, 4, longest=longest)


def test_empty_and_blank_tables(spark, documents):
    assert run(documents([])) == {}
    assert run(documents([(1, None), (2, ""), (3, " .\n")]), least=1) == {}


def test_index_finds_every_phrase():
    draw = np.random.default_rng(1)
    text = np.concatenate([[0], draw.integers(0, 5, 400), [0]])
    index = col.FMIndex(col.transform(text, 4), col.transform(text[::-1], 4))
    starts, n = index.firsts[1:-1], np.diff(index.firsts)[1:]
    everything = lambda phrase, word: np.ones(len(word), dtype=bool)
    phrase, _, near, far, count = index.extend("left", starts, starts, n, everything)
    pairs = collections.Counter((a, b) for a, b in zip(text, text[1:], strict=False) if a and b)
    assert sorted(count.tolist()) == sorted(pairs.values()) and len(phrase) == len(pairs)
    _, _, _, _, threes = index.extend("right", far, near, count, everything)
    wanted = collections.Counter(t for t in zip(text, text[1:], text[2:], strict=False) if all(t))
    assert sorted(threes.tolist()) == sorted(wanted.values())


def test_sieve_holds_every_tuple(spark):
    ids = spark.range(0, 90_000, 9).selectExpr("id AS w1", "id * 7 AS w2")
    sieve = col._sieve(ids)
    w1 = np.arange(0, 90_000, 9)
    assert col._may_hold(sieve, [w1, w1 * 7]).all() and col._may_hold(sieve, [w1, w1 * 7 + 1]).mean() < 0.1


def test_words_and_pieces():
    import pyarrow as pa

    texts = pa.array(["Ab cd. ef\tGH, ij ", None, "", " . ", "x", "É,\x0b y"]).cast(pa.large_string()).fill_null("")
    words, begins = col.word_runs(texts)
    assert words.to_pylist() == [b"ab", b"cd", b"ef", b"gh", b"ij", b"x", "É".encode(), b"y"]
    assert begins.tolist() == [True, False, True, False, True, True, True, True]


def test_wide_keys_rank_alike():
    keys = np.random.default_rng(4).integers(0, 50, 1000)
    for factor in (1, 1 << 56):
        order, ranks = col._ranked(keys * factor)
        assert (np.diff(keys[order]) >= 0).all() and ranks.tolist() == np.unique(keys, return_inverse=True)[1].tolist()


def test_last_length_follows_the_input(spark, documents, monkeypatch):
    """Phrases of four words that the result cannot depend on are not counted: rows grow no faster than the text."""
    plain, made = col._counted, {}

    def counted(folder, length, sieves, *more):
        made[length] = rows = spark.sparkContext.accumulator(0)
        work = plain(folder, length, sieves, *more)

        def run(batches):
            for batch in work(batches):
                rows.add(batch.num_rows)
                yield batch

        return run

    monkeypatch.setattr(col, "_counted", counted)
    draw = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    passages = [" ".join(f"p{i}x{k}" for k in range(6)) for i in range(12)]
    texts = [" ".join(draw.choices(words, k=12) + [draw.choice(passages)] + draw.choices(words, k=12)) for _ in range(750)]
    counts = []
    for n in (150, 750):
        rows = [(i, text, "en") for i, text in enumerate(texts[:n])]
        docs = documents([(d, t, lang, "s") for d, t, lang in rows]).repartition(2)
        assert run(docs, least=4, most=30, words_per_shard=1000) == plain_collocations(rows, 4, 30)
        counts.append(made[4].value)
    assert 0 < counts[1] <= 5 * counts[0], counts

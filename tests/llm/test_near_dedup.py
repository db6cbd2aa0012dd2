import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near_dedup
from tidemark.llm.components import components
from tidemark.llm.near_dedup import _may_hold, match_threshold, near_duplicates


def brute_components(rows, shingle, similar, of):
    """doc_id -> (set size, least doc_id reachable), from all pairs."""
    sets = {}
    for doc_id, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size = min(shingle, len(found))
        sets[doc_id] = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and of * both >= similar * (len(sets[a]) + len(sets[b]) - both):
                one, two = sorted((top(a), top(b)))
                root[two] = one
    return {d: (len(s), top(d)) for d, s in sets.items()}


def words(draw, count):
    return [draw.choice("abcdefghij") + draw.choice("klmnopqrst") + str(draw.randrange(60)) for _ in range(count)]


def corpus(seed):
    """Groups of near copies at all distances, exact copies, a passage many share, short and blank texts."""
    draw, rows = random.Random(seed), []
    passage = words(draw, 40)
    for _ in range(4):
        first = words(draw, 150)
        for _ in range(12):
            text = list(first)
            for _ in range(draw.randrange(0, 7)):
                text[draw.randrange(len(text))] = "x" + str(draw.randrange(10**6))
            rows.append(" ".join(text))
    for _ in range(40):
        rows.append(" ".join(passage + words(draw, 60)))
    rows += [rows[0]] * 30 + ["one", "One", "two words", "", "   \n", None, "A b C d", "a B c D"]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("shingle,similar", [(3, 85), (5, 80)])
def test_groups_equal_brute_force(spark, documents, shingle, similar):
    rows = corpus(shingle)
    wanted = brute_components(rows, shingle, similar, 100)
    found = near_duplicates(documents(rows, kept=1, node="x"), shingle, similar, 100).collect()
    assert len(found) == len(rows)
    for row in found:
        size, root = wanted[row.doc_id]
        assert (row.n_shingles, row.component_id, row.kept) == (size, root, root == row.doc_id)


def test_rows_are_judged_by_their_own_text(spark, documents):
    text, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "wv")
    rows = [(None, text), (5, text), (5, text), (7, text), (9, None), (7, other), (3, other), (None, "x y"), (None, "x y"), (None, "z")]
    found = near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept, r.first) for r in found) == [
        (0, 1, 0, True, True),
        (0, 1, 0, True, True),
        (0, 1, 0, True, True),
        (0, 26, 5, False, False),
        (3, 26, 3, True, True),
        (5, 26, 5, True, True),
        (5, 26, 5, True, True),
        (7, 26, 3, False, False),
        (7, 26, 5, False, False),
        (9, 0, 9, True, True),
    ]
    assert len({bytes(r.row_key) for r in found}) == 8


def family(draw, count, changes):
    """Copies of one text that differ from one another, most pairs a little below the limit."""
    first, rows = words(draw, 200), []
    for _ in range(count):
        text = list(first)
        for at in draw.sample(range(200), changes):
            text[at] = "y" + str(draw.randrange(10**9))
        rows.append(" ".join(text))
    return rows


def test_family_of_almost_copies_equals_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 20_000)
    draw = random.Random(8)
    rows = list(enumerate(family(draw, 90, 3) + family(draw, 60, 4)))
    wanted = brute_components(rows, 3, 85, 100)
    found = near_duplicates(documents(rows), 3, 85, 100).collect()
    assert {r.doc_id: r.component_id for r in found} == {d: root for d, (_, root) in wanted.items()}


def test_rows_made_grow_in_proportion():
    made = {}
    for count in (100, 200, 400):
        rows = family(random.Random(count), count, 4)
        batch = next(near_dedup._signed(3, 64, 512)(iter([pa.record_batch(
            [pa.array(range(count), pa.int64()), pa.array([b""] * count), pa.array(rows)], names=["doc_id", "row_key", "text"])])))
        columns = dict(key=[1] * count, one=[0] * count, two=[0] * count, node=range(count), label=range(count), block=[0] * count,
                       sketch=batch.column("sketch"), prefix=[[1]] * count)
        listed = list(near_dedup._within_lists(match_threshold(512, 0.85, 1e-5))(iter([pa.RecordBatch.from_pydict(columns)])))
        sets = [v.tobytes() for _, v in near_dedup.shingle_sets(pa.array(rows), 3)]
        columns |= dict(cluster=[0] * count, first=[0] * count, second=[0] * count, part=[0] * count, items=sets)
        links = list(near_dedup._linked(match_threshold(512, 0.85, 1e-5), 85, 100)(iter([pa.RecordBatch.from_pydict(columns)])))
        made[count] = (sum(b.num_rows for b in listed), sum(b.num_rows for b in links))
        assert made[count][0] <= count and made[count][1] < count
    assert made[100][0] > 50


def test_long_words_that_a_polynomial_confuses():
    one = "a"
    while len(one) < 4096:
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    sets = [set(v.tolist()) for _, v in near_dedup.shingle_sets(pa.array([one, two]), 3)]
    assert sets[0] != sets[1]


def test_empty_table(spark, documents):
    assert near_duplicates(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame(chain + star + [(7, 7), (200, 199), (199, 200)], "low long, high long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert all(roots[i] == 0 for i in range(41)) and all(roots[i] == 100 for i in range(100, 160))
    assert roots[200] == roots[199] == 199
    assert components(links.limit(0)).count() == 0


def test_filter_holds_every_id(spark):
    ids = spark.range(0, 5000, 7).withColumnRenamed("id", "node")
    passes = _may_hold(ids, "node")
    table = spark.range(20000).withColumn("in", passes(F.col("id")))
    assert table.where("id % 7 = 0 AND id < 5000 AND NOT in").count() == 0
    assert table.where("in").count() < 800


def test_plans_do_not_spell_the_filter_out(spark):
    passes = _may_hold(spark.range(5).withColumnRenamed("id", "node"), "node")
    kept = spark.range(20).where(passes(F.col("id")) | passes(F.col("id") + 1))
    assert kept.where("id < 5").count() == 5
    assert len(kept._jdf.queryExecution().toString()) < 50_000


def test_threshold_meets_its_miss():
    least = match_threshold(64, 0.85, 1e-5)
    draws = np.random.default_rng(1).binomial(64, 0.85, 200_000)
    assert (draws < least).mean() < 1e-4 and least > 35
    assert 1600 < match_threshold(2000, 0.85, 1e-5) < 1700 and match_threshold(64, 1.0, 1e-5) == 64

import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import filter_audit
from tidemark.llm.filter_audit import gallop, outside, union, word_counts


def plain_audit(rows, labels):
    """Every order applied row by row."""
    facts, found = [], {}
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(o is not None and doc_id is not None and o < doc_id and (t or "") == text for o, t, _ in rows)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search("[#$%&*|]", text) is not None,
            "E": smaller,
        }
        mine = [x for x in labels if x[0] == doc_id and doc_id is not None]
        facts.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    for part in {f[0] for f in facts}:
        inside = [f for f in facts if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = inside
            for step, name in enumerate(order, 1):
                gone = [f for f in left if f[1][name]]
                left = [f for f in left if not f[1][name]]
                shapley[name] += len(gone)
                found[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(f[1][name] for f in inside) - len(gone),
                    sum(f[1][name] and sum(f[1].values()) == 1 for f in inside),
                    sum(f[2] for f in gone),
                    sum(f[3] for f in gone),
                ]
        for order, step in itertools.product(map("".join, itertools.permutations("ABCDE")), range(1, 6)):
            found[part, order, step].append(shapley[order[step - 1]])
    return found


def run(spark, documents, tmp_path, rows, labels, **clashing):
    documents([(d, t, lang, "s") for d, t, lang in rows], **clashing).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    result = filter_audit.op13_filter_audit(spark, str(tmp_path)).collect()
    return {(r.part, r.filter_order, r.step): list(r[3:]) for r in result}, len(result)


def corpus(seed):
    draw, rows = random.Random(seed), []
    for i in range(120):
        words = [draw.choice("abcdefgh") * draw.randrange(1, 9 if i % 3 else 40) + str(draw.randrange(10 ** (1 + i % 4))) for _ in range(draw.choice([20, 130]))]
        if i % 4 == 0:
            words[3] = "A" * 90
        if i % 5 == 0:
            words[5] = draw.choice("#$%&*|é")
        rows.append((i, " ".join(words), draw.choice(["en", "de", None, ""])))
    rows += [(200 + i, rows[i][1], "fr") for i in range(20)] + [rows[3], rows[3], (None, rows[4][1], "de"), (None, rows[4][1], "de")]
    rows += [(300, None, "en"), (301, "", None), (302, " \n\t", "en"), (4, rows[9][1], "en"), (-1, rows[7][1], "de")]
    rows += [(400, "ab " * 700_000 + "#", "en")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows_per_range", [7, 1 << 16])
def test_query_equals_brute_force(spark, documents, tmp_path, monkeypatch, rows_per_range):
    rows = corpus(5)
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 260, 3)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (9999, 1, 1)]
    monkeypatch.setattr(filter_audit, "ROWS_PER_RANGE", rows_per_range)
    found, count = run(spark, documents, tmp_path, rows, labels, part="x", digest="y", a=True, good=1, toxic=0)
    wanted = plain_audit(rows, labels)
    assert count == len(found) == 600 * len({lang or "" for _, _, lang in rows})
    assert found == wanted


def test_empty_tables(spark, documents, tmp_path):
    assert run(spark, documents, tmp_path, [], []) == ({}, 0)


def test_ranges_are_bounded_and_add_up(spark):
    rows = spark.range(1000).selectExpr("id", "CAST(id % 2 AS STRING) AS part", "id % 3 = 0 AS f", "id % 5 = 0 AS g")
    lists = filter_audit.failing_lists(rows, ["f", "g"], "part", ["id"], rows_per_range=64).collect()
    assert max(r.rows for r in lists) <= 64 and sum(r.rows for r in lists) == 1000
    assert sum(len(r.lists[0]) // 4 for r in lists) == 334


def test_lists_merge_like_sets():
    draw = np.random.default_rng(2)
    for one, two in itertools.product([0, 1, 5, 3000, 20_000], repeat=2):
        a, b = (np.unique(draw.integers(0, 40_000, n)).astype("<u4") for n in (one, two))
        assert gallop(a, b).tolist() == np.searchsorted(a, b).tolist()
        assert union(a, b).tolist() == np.union1d(a, b).tolist()
        assert a[outside(a, b)[0]].tolist() == np.setdiff1d(a, b).tolist()


def test_words_of_long_texts_are_counted_whole(monkeypatch):
    data = ("one two  three\n" * 500 + "x" * 300).encode()
    monkeypatch.setattr(filter_audit, "TEXT_STRETCH", 64)
    assert word_counts(data) == (1501, 4)
    assert word_counts(b"") == (0, 0)

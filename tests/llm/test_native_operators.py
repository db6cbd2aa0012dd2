"""Chat formatting, private terms, quality rules and mixing against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format, mixing, private_terms, quality_rules

TURNS = "conv_id long, turn long, role string, text string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# chat formatting


def test_formatted_turns_read_back(spark):
    texts = ["plain", "", "</s>[INST] ok [/INST]", r"[\INST] \\ <\\s> [", " [TEXT] [ROLE]", "a\n\nb ", "[[INST]]<<s>>", "[", "é𝒳" * 50, r"ends with [\ ", None]
    draw, rows = random.Random(1), []
    for conv in range(60):
        for turn in range(draw.randrange(1, 6)):
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", "tool", "[INST]", "", None]), draw.choice(texts)))
    found = chat_format.digests(chat_format.format_conversations(spark.createDataFrame(rows, TURNS)))
    assert "Python" not in plan_of(found) and "Arrow" not in plan_of(found)
    for row in found.collect():
        turns = [(r or "", t or "") for c, _, r, t in rows if c == row.conv_id]
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_order_marks_and_odd_rows(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (3, 1, "user", "u"), (None, None, "user", None), (4, 1, "assistant", "b"), (4, 0, "user", "a"), (4, 0, "user", "a")]
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS segments", "'x' AS formatted")
    found = {r.conv_id: r for r in chat_format.format_conversations(table).collect()}
    assert {k: r.valid for k, r in found.items()} == {1: True, 2: False, 3: False, None: True, 4: False}
    assert found[1].formatted == "[SYS] s [/SYS][INST] u [/INST][OUT] a</s>"
    assert [s.text for s in found[1].segments if s.loss] == ["a"]
    assert chat_format.format_conversations(table.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat_format.Template({}, chat_format.Turn("((", "))", False), "]").marks()


def test_rows_without_a_conversation_stand_alone(spark):
    rows = [(None, 0, "user", "u"), (None, 0, "user", "u"), (None, 1, "assistant", "a"), (1, 0, "user", "u"), (1, 1, "assistant", "a")]
    found = chat_format.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((r.conv_id or 0, len(r.segments), r.valid) for r in found) == [(0, 3, False), (0, 3, True), (0, 3, True), (1, 6, True)]
    lone = spark.createDataFrame([(None, "user", "u", "c")], "conv_id long, role string, text string, turn string")
    assert [r.formatted for r in chat_format.format_conversations(lone).collect()] == ["[INST] u [/INST]"]


# mixing


def targets_of(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, found = sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return found | {s: level * weight[s] for s in free}
        for s in over:
            found[s], left = most * sizes[s], left - most * sizes[s]
            free.remove(s)
    return found


def test_targets_equal_resharing(spark):
    draw = random.Random(7)
    for _ in range(8):
        sources = draw.sample(["a", "b", "c", "d", "e", "Z", "é", None, "\U0001d4b3"], draw.randrange(1, 9))
        sizes = {s: draw.choice([0, 1, 7, 100, draw.randrange(5000)]) for s in sources}
        table = spark.createDataFrame(list(sizes.items()), "source string, size long")
        found = {r.source: r.target for r in mixing.source_targets(table, (1, 2, 3), 3).collect()}
        assert found == pytest.approx(targets_of(sizes))


def test_mix_emits_rate_copies(spark, documents):
    draw = random.Random(8)
    rows = [(i, " ".join("w" * draw.randrange(1, 30)), "en", draw.choice(["a", "a", "a", "b", None])) for i in range(600)]
    rows += [(1000, None, "en", "empty"), (1001, " \n", "en", "empty"), (None, "x y", "en", "a"), (5, "x y", "en", "a")]
    docs = documents(rows, copies=5, target="clash")
    counted = mixing.repetitions(docs)
    assert "Python" not in plan_of(counted)
    held = counted.collect()
    taken = Counter()
    for row in held:
        assert row.size == len(row.text.split()) if row.text else row.size == 0
        rate = row.target / row.source_size if row.source_size else 0
        assert row.copies in (int(rate), int(rate) + 1) and row.copies <= 3
        taken[row.source] += row.copies * row.size
    for source, target in {r.source: r.target for r in held}.items():
        assert taken[source] == pytest.approx(target, rel=0.25, abs=1)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in held)
    assert mixing.mix(docs.limit(0)).count() == 0
    again = {(r.doc_id, r.text): r.copies for r in mixing.repetitions(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.text): r.copies for r in held}


def test_mix_keeps_columns_of_any_name(spark, documents):
    rows = [(i, "w " * (i % 9 + 1), "en", "ab"[i % 2]) for i in range(100)]
    plain = documents(rows)
    clashing = plain.selectExpr("*", "doc_id AS size", "doc_id AS _size", "'t' AS Target", "'o' AS _of", "'c' AS _copy", "7 AS copies", "1 AS `a.b`")
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns
    found = mixed.collect()
    assert all((r.size, r._size, r.Target, r._of, r._copy, r.copies) == (r.doc_id, r.doc_id, "t", "o", "c", 7) for r in found)
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in mixing.mix(plain).collect())
    assert {r._of for r in mixing.repetitions(clashing).collect()} == {"o"}


# quality rules


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return [len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)]


def test_counts(spark, documents):
    draw = random.Random(3)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "a a a a a a a", "x\ny\nx\n\n \nx ", "#|<> $", " é 𝒳", "a b c d e f " * 900]
    texts += ["".join(draw.choice(["a", "b", " ", "\n", "#", "\r", "é"]) for _ in range(draw.randrange(200))) for _ in range(60)]
    rows = {r.doc_id: r for r in quality_rules.with_counts(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert [rows[i][name] for name in quality_rules.COUNTS] == counts_of(text), repr(text)


def prose(draw, count):
    return " ".join("".join(draw.choice("etaoinshr") for _ in range(draw.choice([2, 3, 4, 5, 6, 7]))) for _ in range(count)).capitalize() + "."


def test_outliers_go_and_ordinary_texts_stay(spark, documents):
    draw = random.Random(4)
    rows = [(i, prose(draw, draw.randrange(40, 400)), draw.choice(["en", None]), draw.choice(["a", "a", None])) for i in range(500)]
    bad = [(1000 + i, " ".join(f"{w}###" for w in prose(draw, 80).split()), "en", "a") for i in range(25)]
    bad += [(2000 + i, prose(draw, 80).upper(), None, None) for i in range(12)]
    few = [(3000, "too few words", "en", "a"), (3001, None, "en", "a"), (3002, "one two three four five six " * 9, "en", "a")]
    found = quality_rules.judge(documents(rows + bad + few, kept=1, n_words="clash"), ["doc_id", "text"])
    assert "Python" not in plan_of(found)
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert len(kept) == len(rows + bad + few)
    assert sum(kept[i] for i, *_ in rows) >= 498
    assert not any(kept[i] for i, *_ in bad + few)


def plain_shapes(levels, points, share, prior_rows):
    """The same search in numpy: starts, steps over the nearest bins, smallest determinant, then shrinkage by level."""
    size, floors = quality_rules.SIZE, np.array([f for _, _, f in quality_rules.VECTOR])

    def step(x, mean, cov):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        bins = np.floor(np.log1p(d) * quality_rules.BINS)
        edge = np.sort(bins)[int(np.ceil(share * len(x) - 1e-9)) - 1]
        near = x[bins <= edge]
        return near.mean(0), np.cov(near.T, bias=True).reshape(size, size) + np.diag(floors**2)

    def quantile(values, q):
        values = np.sort(np.floor(values * 200 + 0.5))
        return values[int(np.ceil(q * len(values) - 1e-9)) - 1] / 200

    def search(x):
        middle = np.array([quantile(c, 0.5) for c in x.T])
        scale = np.maximum([(quantile(c, 0.75) - quantile(c, 0.25)) / 1.349 for c in x.T], floors)
        z = (x - middle) / scale
        bent = [np.tanh(z), z / np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]]
        shapes = [(middle, np.diag(scale**2))]
        shapes += [(middle, np.outer(scale, scale) * (t.T @ t) / len(x) + np.diag(floors**2)) for t in bent]
        for _ in range(2):
            shapes = [step(x, *shape) for shape in shapes]
        best = min(shapes, key=lambda s: np.linalg.slogdet(s[1])[1])
        while np.linalg.slogdet((after := step(x, *best))[1])[1] < np.linalg.slogdet(best[1])[1] - quality_rules.SETTLED:
            best = after
        return best

    inner = quality_rules.chi_square_quantile(share, size)
    correction = share / quality_rules._chi_square(inner, size + 2)
    found, names = {}, [levels[i] for i in range(len(levels))]
    for level in (2, 1, 0):
        for group in {n[level] for n in names}:
            x = points[[n[level] == group for n in names]]
            mean, cov = search(x)
            parent = next((n[level + 1] for n in names if n[level] == group), None) if level < 2 else None
            above = found[parent] if parent else (mean, np.diag((quality_rules.WIDE * floors) ** 2))
            n, both = len(x), len(x) + prior_rows
            middle = (n * mean + prior_rows * above[0]) / both
            second = n * (correction * cov + np.outer(mean, mean)) + prior_rows * (above[1] + np.outer(*[above[0]] * 2))
            found[group] = middle, second / both - np.outer(middle, middle)
    return found


def test_shapes_equal_plain_version(spark):
    """Groups from one row to hundreds, with a far cluster: means, covariances and so verdicts are those of numpy."""
    draw = np.random.default_rng(6)
    size, levels, parts = quality_rules.SIZE, [], []
    for name, rows in [("a", 300), ("b", 60), ("c", 7), ("d", 1)]:
        for lang in ("en", "zz") if rows > 7 else ("en",):
            mixing_matrix = draw.normal(0, 0.4, (size, size)) + np.eye(size)
            x = draw.normal(0, 1, (rows, size)) @ mixing_matrix + (3 if lang == "zz" else 0)
            x[: rows // 6] += 12
            parts.append(x)
            levels += [[f"s{lang}{name}", f"l{lang}", "all"]] * rows
    points = np.vstack(parts)
    table = spark.createDataFrame([(n, *map(float, p)) for n, p in zip(levels, points)], ["levels", *quality_rules.NAMES])
    wanted = plain_shapes(levels, points, 0.75, 50)
    got = {r["group"]: r for r in quality_rules.group_shapes(table, 0.75, 50).collect()}
    limit = quality_rules.chi_square_quantile(1 - 1e-6, size)
    for group in {n[0] for n in levels}:
        mean, cov = wanted[group]
        assert [got[group][m] for m in quality_rules.MEANS] == pytest.approx(mean.tolist(), abs=1e-9)
        assert [got[group][f"c{i}_{j}"] for i, j in quality_rules.PAIRS] == pytest.approx([cov[i, j] for i, j in quality_rules.PAIRS], abs=1e-7)
        factor = np.zeros((size, size))
        for i, j in quality_rules.PAIRS:
            factor[i, j] = got[group][f"f{i}_{j}"]
        x = points[[n[0] == group for n in levels]]
        mine = (((x - mean) @ factor.T) ** 2).sum(1) <= limit
        assert mine.tolist() == (np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean) <= limit).tolist()


def test_one_more_row_changes_no_verdict(spark, documents):
    """No size from which on another rule holds: the same outlier is rejected in tables of 40, 99 and 101 rows."""
    draw = random.Random(12)
    texts = [(i, prose(draw, 80)) for i in range(101)]
    bad = (1000, " ".join(f"{w}###" for w in prose(draw, 80).split()))
    for rows in (40, 99, 101):
        kept = {r.doc_id: r.kept for r in quality_rules.judge(documents(texts[: rows - 1] + [bad]), ["doc_id"]).collect()}
        assert not kept.pop(1000) and all(kept.values()) and len(kept) == rows - 1


def test_small_and_empty_tables(spark, documents):
    text = " ".join(f"w{i}" for i in range(20))
    clash = dict(_words=1, _lines=2, carried=3, levels=4, group=5)
    rows = quality_rules.judge(documents([(1, text), (1, text), (2, "x " + text)], **clash), ["doc_id", *clash]).collect()
    assert all(r.kept and not r.base_failed and r.distance is not None and r["_words"] == 1 for r in rows) and len(rows) == 3
    assert quality_rules.judge(documents([]), ["doc_id"]).count() == 0


def test_chi_square_quantile():
    assert quality_rules.chi_square_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3)


# private terms

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    checks = (
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    )
    return [(kind, m.start(), m.end()) for kind, pattern, good in checks for m in pattern.finditer(text) if good(m[0])]


def test_base_spans(spark, documents):
    draw = random.Random(9)
    texts = [None, "", "a@b.com_x@y.org", "a@b@c.d", "1.2.3.4.5.6.7.8", "001.2.3.0255", "999.1.1.1.1", "4111 1111 1111 1111", "4111-1111  1111-1111", "+1 (555) 123-4567.", "+4111111111111111", "é𝒳 q@r.st\n10.0.0.1", "9" * 2000, "x" * 5000 + "@", ".a" * 4000 + "@b" + ".c" * 4000]
    texts += ["".join(draw.choice("a@.1234 -+()é") for _ in range(draw.randrange(120))) for _ in range(300)]
    found = private_terms.with_base_spans(documents(list(enumerate(texts))))
    assert "Python" not in plan_of(found)
    for row in found.collect():
        spans = [(k, s.start, s.end) for k in private_terms.PATTERNS for s in row[k]]
        assert spans == base_spans(row.text or ""), repr(row.text)
        assert all(row.text[s.start : s.end] == s.found for k in private_terms.PATTERNS for s in row[k])


def revealing_corpus():
    draw, rows = random.Random(11), []
    for i in range(300):
        rows.append((i, " ".join(draw.choice(["river", "stone", "cloud", "grass", "common"]) for _ in range(20))))
    for i in range(300, 306):
        rows.append((i, f"common river Zanzibarov wrote from zed@mail.example.com common stone {i}"))
    rows.append((306, "common cloud zanzibarov alone"))
    return rows


def test_terms_that_reveal_an_entity(spark, documents):
    rows = revealing_corpus()
    docs = documents(rows)
    limits = private_terms.Limits(generalise=0.9, remove=0.999)
    terms = {r.term: r.disclosure for r in private_terms.disclosing_terms(docs.select("text"), limits).collect()}
    count, near = len(rows), 6
    wanted = np.log(near * count / (7 * near)) / np.log(count / near)
    assert terms["zanzibarov"] == pytest.approx(wanted) and "common" not in terms and "river" not in terms
    found = private_terms.find(docs, limits)
    spans = {r.doc_id: [r.text[s.start : s.end] for s in (*r.term_removed, *r.term_generalised)] for r in found.collect()}
    assert "Zanzibarov" in spans[300]
    assert spans[306] == ["zanzibarov"] and not any(spans[i] for i in range(300))
    clean = {r.doc_id: r for r in private_terms.sanitise(docs, limits).collect()}
    assert "zed@" not in clean[300].text and "[email]" in clean[300].text and "anzibarov" not in clean[306].text
    assert all(clean[i].text == text for i, text in rows[:300])


def test_terms_are_counted_over_whole_documents(spark, documents):
    far, filler = "Ozymandias begins. ", "river stone cloud grass " * 30
    rows = [(i, filler + f"common {i}") for i in range(200)]
    rows += [(200 + i, far + filler + "write to oz@mail.example.com") for i in range(6)]  # never near
    rows += [(300 + i, ("" if i < 4 else filler) + "Xanadu " + (filler if i >= 4 else "") + "at +1 (555) 123-4567") for i in range(10)]
    rows += [(400 + i, "a" * 117 + f"bcdef kublakhan{'' if i else ' khan'} 10.0.0.1") for i in range(3)]  # no fragments
    rows += [(500, filler + "ozymandias"), (501, None), (502, "")]
    limits = private_terms.Limits()
    found = {(r.term, r.entity): r.disclosure for r in private_terms.disclosing_terms(documents(rows).select("text"), limits).collect()}
    seen, seen_by, both = Counter(), Counter(), Counter()
    for _, text in rows:
        terms = set(re.findall(r"[^\W_]+", (text or "").lower()))
        held = {f"{k}:{(text[a:b] if k == 'email' else re.sub('[^0-9]', '', text[a:b]))}" for k, a, b in base_spans(text or "")}
        seen.update(terms), seen_by.update(held), both.update((t, e) for t in terms for e in held)
    wanted = {}
    for (term, entity), n in both.items():
        disclosure = np.log(n * len(rows) / (seen[term] * seen_by[entity])) / np.log(len(rows) / seen_by[entity])
        if n >= limits.support and n >= limits.tied * seen[term] and disclosure >= limits.generalise:
            wanted[term, entity] = disclosure
    assert {"ozymandias", "xanadu", "kublakhan"} <= {t for t, _ in wanted}
    assert found == pytest.approx(wanted)


def test_every_token_can_reveal(spark, documents):
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choice(["river", "of", "a", "7", "的山", "cloud"]) for _ in range(12))) for i in range(300)]
    mail = "write to someone@mail.example.com"
    texts = [f"a river of Lee {mail}", f"K9x42, {mail}", f"山的王小明的山 {mail}", f"的タナカ的 {mail}", f"cafe\u0301s {mail}", f"\U00020000\U00020001 {mail}"]
    rows += [(1000 + 10 * i + j, text.replace("someone", f"user{i}")) for i, text in enumerate(texts) for j in range(4)]
    found = {r.doc_id: r for r in private_terms.sanitise(documents(rows)).collect()}
    spans = {r.doc_id: r for r in private_terms.find(documents(rows)).collect()}
    for i, name in enumerate(["Lee", "K9x42", "王小明", "タナカ", "cafe\u0301s", "\U00020000\U00020001"]):
        for j in range(4):
            row = spans[1000 + 10 * i + j]
            hidden = {p for s in (*row.term_removed, *row.term_generalised) for p in range(s.start, s.end)}
            at = row.text.index(name)
            assert hidden >= set(range(at, at + len(name))), name
            assert all(row.text[s.start : s.end] == s.found for s in (*row.term_removed, *row.term_generalised))
            clean = found[row.doc_id].text
            assert not any(c in clean for c in (name if ord(name[0]) > 0x3000 else [name]))
    assert "a river of" in found[1000].text and all(found[i].text == text for i, text in rows[:300])


def test_support_follows_from_significance(spark, documents):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("bcdfgklmnprst") + draw.choice("aeiou") for _ in range(3))
    filler = [(i, " ".join(word() for _ in range(8))) for i in range(2000)]
    pair = [(3000 + i, f"Zanzibarov {word()} zed@mail.example.com") for i in range(2)]
    once = [(4000, "Ozymandias oz@mail.example.com")]

    def found(rows, **limits):
        terms = private_terms.disclosing_terms(documents(rows).select("text"), private_terms.Limits(**limits))
        return {(r.term, r.entity) for r in terms.collect()}

    # two documents in 2,003: (2 / 2,003) ** 2 = 1e-6 for each of a few thousand pairs; one document is never enough
    assert ("zanzibarov", "email:zed@mail.example.com") in found(filler + pair + once)
    assert not any(term == "ozymandias" for term, _ in found(filler + pair + once, chance=0.9))
    assert ("zanzibarov", "email:zed@mail.example.com") not in found(filler + pair + once, chance=1e-4)
    # among few documents the same two are no evidence
    assert not found(filler[:6] + pair + once)


def test_accident_bounds_the_binomial_tail(spark):
    for n, k, share in [(1, 1, 0.01), (2, 2, 0.001), (10, 6, 0.1), (50, 20, 0.3), (50, 10, 0.3)]:
        tail = sum(math.comb(n, j) * share**j * (1 - share) ** (n - j) for j in range(k, n + 1))
        bound = spark.range(1).select(private_terms._log_accident(F.lit(k), F.lit(n), F.lit(share))).first()[0]
        assert tail <= math.exp(bound) * (1 + 1e-9) and (k < n or math.exp(bound) == pytest.approx(tail))
        assert k > n * share or bound == 0


def test_sanitise_keeps_columns_of_any_name(spark, documents):
    rows = [(1, "write to a@b.cd now"), (2, "nothing"), (3, None)]
    names = ["email", "IP", "term_removed", "_email", "_text", "_removed", "_generalised", "_spans", "term", "start"]
    docs = documents(rows).selectExpr("*", *[f"'own' AS {name}" for name in names])
    clean = private_terms.sanitise(docs)
    assert clean.columns == docs.columns
    found = clean.collect()
    assert sorted((r.doc_id, r.text) for r in found if r.text) == [(1, "write to [email] now"), (2, "nothing")]
    assert {r[name] for r in found for name in names} == {"own"}
    spans = {r.doc_id: r for r in private_terms.find(docs).collect()}
    assert [(s.start, s.end) for s in spans[1].email] == [(9, 15)] and spans[1]._text == spans[1]._spans == "own"


def test_sanitise_odd_tables(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (3, "+1 (555) 123-4567 and 4111111111111111"), (None, "a@b.cd a@b.cd")]
    clean = private_terms.sanitise(documents(rows))
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == [(0, "[email] [email]"), (1, ""), (2, ""), (2, ""), (3, "[phone] and [card]")]
    assert private_terms.sanitise(documents([])).count() == 0

"""The pipeline's stages: columns kept, decisions in effect, odd rows; and its whole result."""

import random

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe
from tidemark.llm.shared_files import stored
from tidemark.llm.shipping import BATCH_LIMIT, bound_batches


def text(draw, count=60):
    return " ".join("".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(2, 8))) for _ in range(count))


def test_pipeline_over_planted_documents(spark, documents):
    draw = random.Random(12)
    rows = [(i, text(draw), "en", draw.choice(["a", "b", None])) for i in range(200)]
    rows += [(500 + i, rows[i][1], "en", "a") for i in range(10)]  # copies
    rows += [(600, rows[0][1] + " last", "en", "b"), (700, "short", "en", "a"), (701, None, "en", "a"), (702, "", None, None)]
    rows += [(800, text(draw) + " mail me at jo@mail.example.com " + text(draw), "en", "a"), (5, rows[5][1], "en", "a")]
    docs, names = documents(rows, kept="clash", row=7, ids="x"), []
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "test")
        names.append(name)
        seen[name] = docs
        if name != names[-1] or name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in seen.items()}
    assert set(ids["quality rules"]) == {d for d, *_ in rows} - {700, 701, 702}
    alone = ids["near duplicates"]
    assert len(alone) == len(set(alone)) and set(alone) == {d for d, *_ in rows if d < 500 or d == 800}
    clean = seen["personal data"].where("doc_id = 800").first()
    assert "[email]" in clean.text and "jo@" not in clean.text and clean.n_chars == len(clean.text)
    assert set(ids["mixing"]) <= set(alone)
    last = seen["byte-level BPE"]
    assert last.where("NOT exact OR n_tokens <> size(ids)").count() == 0 and len(ids["byte-level BPE"]) == len(ids["mixing"])


def test_stages_take_empty_tables_and_null_ids(spark, documents):
    empty = documents([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name
    same = documents([(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "a b c d e f g"), (4, "a b c d e f g")])
    left = corpus_pipeline.drop_near_copies(spark, same, "").collect()
    assert sorted(r.doc_id or 0 for r in left) == [3]


def test_texts_under_one_id_are_judged_apart(spark, documents):
    one, two = ("a b c d e f g h", "k l m n o p q r")
    rows = [(1, one), (1, two), (2, two), (None, "s t u v w x"), (None, "s t u v w x"), (4, ""), (4, ""), (1, one)]
    left = corpus_pipeline.drop_near_copies(spark, documents(rows), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, "s t u v w x"), (1, one), (1, two), (4, "")]


def test_run_reads_and_writes_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "n_tokens", "ids", "exact"] and result.where(~F.col("exact")).count() == 0
    assert result.count() > 100


def test_rows_without_copies_stay_where_they_are(spark, documents):
    """Texts of rows that neither go nor repeat are not shuffled: their branch has no join."""
    draw = random.Random(3)
    rows = [(i, text(draw)) for i in range(50)]
    docs = documents([*rows, (60, rows[0][1]), (1, rows[1][1])])
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    branches = left._jdf.queryExecution().optimizedPlan().children()
    assert "Join" not in branches.apply(0).toString() and "Join" in branches.apply(1).toString()
    assert sorted(r.doc_id for r in left.collect()) == list(range(50))


def test_workers_of_the_pipeline_get_small_batches_and_remember_little(spark, documents):
    def sizes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    docs = documents([(i, f"a{i} b c " + "word " * 4000) for i in range(600)]).coalesce(1)
    spark.conf.unset(BATCH_LIMIT)
    try:
        result = corpus_pipeline.encode(spark, docs, "")
        sizes = [r["size"] for r in docs.select("text").mapInArrow(sizes_of, "size long").collect()]
        assert sum(sizes) > 12_000_000 and max(sizes) < 5_000_000
        assert result.where("exact AND n_tokens = size(ids)").count() == 600
        spark.conf.set(BATCH_LIMIT, "1m")
        bound_batches(spark)
        assert spark.conf.get(BATCH_LIMIT) in ("1m", "1048576b")
    finally:
        spark.conf.unset(BATCH_LIMIT)
    ranks = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    encoder = byte_bpe.vocabulary(ranks, public_tokenizers.PATTERN, 8000)
    text = " ".join(f"word{i}" for i in range(500))
    assert encoder.decode(encoder.encode(text).tolist()) == text.encode() and len(encoder.pieces) <= 50
    assert corpus_pipeline.REMEMBERED_BYTES * 2 < byte_bpe.MOST_REMEMBERED_BYTES

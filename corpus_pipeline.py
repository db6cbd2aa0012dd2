"""From raw documents to token ids: reject, de-duplicate, sanitise, mix, encode.

Every stage takes (spark, docs, folder of the tables) and works on all that the one before kept. A stage is
written as parquet to the shared folder and read back as the next one's docs, so an executor that is lost costs
at most the stage under way.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, mixing, near_dedup, private_terms, quality_rules
from tidemark.llm.shared_files import stored
from tidemark.llm.shipping import bound_batches

SHINGLE, SIMILAR, OF = 5, 80, 100
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED_BYTES = 32 << 20  # by a worker of the last stage, beside a JVM that four stages have filled


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The row as one column, beside copies of `columns`: whatever a row holds, no name can clash."""
    return docs.select(F.struct("*").alias("row"), *columns)


def _whole(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def reject_poor(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Quality rules: documents that fail a limit or lie far outside their language and source go.

    Null or blank texts fail; a null language or source is a value of its own; repeated rows are judged alike.
    """
    return _whole(quality_rules.judge(_packed(docs, "text", "lang", "source"), ["row"]).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """MinHash near-dedup (5-word shingles, similarity 0.8): the least doc_id of each group stays.

    Every row is judged by its own text: of rows that repeat a doc_id with other texts, and of rows without one, only
    copies go. Of a group's rows the one of least doc_id, null last, stays; of rows alike in doc_id and text one. Blank
    texts link with nothing and stay. A bit filter tells most rows that neither go nor repeat; only the others are shuffled.
    """
    bound_batches(spark)
    verdict = stored(near_dedup.near_duplicates(docs, SHINGLE, SIMILAR, OF).select("row_key", "first"), "verdict")
    gone = verdict.where("NOT first").select("row_key").distinct()
    again = verdict.where("first").groupBy("row_key").count().where("count > 1").select("row_key")
    keyed = docs.select(F.struct("*").alias("row"), near_dedup.row_key().alias("row_key"))
    named = near_dedup._may_hold(stored(gone.union(again), "named"), "row_key")(F.col("row_key"))
    left = keyed.where(named).join(gone, "row_key", "left_anti")
    once = left.join(again, "row_key", "left_anti")
    alike = left.join(again, "row_key", "left_semi").dropDuplicates(["row_key"])
    return _whole(keyed.where(~named)).unionByName(_whole(once)).unionByName(_whole(alike))


def sanitise(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """PII: personal data replaced by its kind, terms that reveal it removed or generalised; n_chars follows.

    Null texts stay null. No row goes.
    """
    clean = private_terms.sanitise(_packed(docs, "text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.select(*[new.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Mixing: every document as often as its source's rate and its own draw say; none more than three times.

    A null source is a source. Texts without words go with their source's rate like others.
    """
    return _whole(mixing.mix(_packed(docs, "doc_id", "text", "source")))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Byte-level BPE: doc_id, n_tokens and ids of every row, and whether the ids decode to its text (null: empty)."""
    bound_batches(spark)
    return byte_bpe.encode_checked(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), most=REMEMBERED_BYTES)


STAGES = [
    ("quality rules", reject_poor),
    ("near duplicates", drop_near_copies),
    ("personal data", sanitise),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: Connected components have no fixed-depth SQL, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import langid, near_dedup, packing, quality
from terraloom.llm.common import cut, release, shared_table, small_batches, table

#: A document whose language is less certain than this goes, as does one without any letter.
LEAST_LANGUAGE_SCORE = 0.5
#: A document goes whose estimated probability of good quality is below this.
LEAST_QUALITY = 0.5


def _keep(docs: DataFrame, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows whose text the made function keeps, with all their columns and without a shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))
        keep = batch = None
        release()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay. Texts go that are null or without a letter, whose language is uncertain, or
    that are less likely, per letter, than nearly all training texts of their language: other languages and random
    letters. Very long texts are read whole; repeated rows and null ids are judged each by its text."""
    model = spark.sparkContext.broadcast(langid.train(docs, public_tokenizers.path("piece_bpe_32k.model")))

    def make():
        of = langid.predictor(model.value)
        least = dict(zip(model.value.langs, model.value.least))

        def keep(texts):
            return [lang != langid.UNKNOWN and score >= LEAST_LANGUAGE_SCORE and rate >= least[lang] for lang, score, rate in zip(*of(texts))]

        return keep

    return _keep(docs, make)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts stay; without any label for them, all do. A null text is judged
    as an empty one; null and repeated ids are judged each by its text; very long texts are read whole."""
    model = spark.sparkContext.broadcast(quality.fit(docs, table(spark, sf_dir, "labels")))

    def make():
        of = quality.scorer(model.value)
        return lambda texts: (of(texts) >= LEAST_QUALITY).tolist()

    return _keep(docs, make)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one document stays, that with the smallest id; null ids come last.

    A document is an id with its text: different texts under one id are different documents, and so are rows without
    an id; equal texts under one id are one. A null text is no copy of anything. Very long texts are compared whole.
    """
    row = next(c for c in ("row_key", *(f"row_key_{k}" for k in range(len(docs.columns) + 1))) if c not in docs.columns)
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    classes = near_dedup.near_duplicates(keyed, id_col=row)
    ids = keyed.select(F.col(row).alias("key"), "doc_id")
    chosen = classes.select(F.col("doc_id").alias("key"), "class_id").join(ids, "key").groupBy("class_id")
    first = cut(chosen.agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m")).select(F.col("m.key").alias(row)))
    n = first.count()
    kept = keyed.join(F.broadcast(first) if n <= near_dedup.BROADCAST_IDS else first, row, "left_semi")
    if kept.select(row).count() > n:  # repeated rows
        kept = kept.withColumn(f"{row}_md5", F.md5("text")).dropDuplicates([row, "doc_id", f"{row}_md5"])
    return kept.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences of at most 2048 tokens; null and repeated ids are packed each for
    itself, a null text as an empty one. After three other stages an executor has less memory to spare, so fewer
    chunks are remembered."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=40_000, merged=1 << 20)


STAGES = [("language", language), ("quality", good_quality), ("near_dedup", distinct_documents), ("packing", packed)]

#: The stages are learned or seeded procedures that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality classifier, toxicity, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs. Both classifiers are fitted on the labelled documents of sf_dir
(their bounded samples, see the operators), and then decide over all that the stage was given.
All stages but the last return the columns they were given, whatever further columns those are.
A stage looks at doc_id, text and (the mix) source alone: a null text counts as empty, rows with a
null or a repeated id are rows like any other, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.llm import mixing, neardup, packing, quality, tokens, toxicity
from addrloom.llm.common import discard_since, stored, stored_so_far, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good stay. Empty texts are scored like any other; without labels to learn from all have one score."""
    forest = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_documents(docs, lambda text: quality.text_scores(forest, text) >= quality.KEEP)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network predicts to be toxic go; a text without words is scored by one empty window."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_documents(docs, lambda text: model.scores(text) < quality.KEEP)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: of those with the least doc_id (without one, where no row has any) the one with the least text key. Rows without words are in no group and stay."""
    rows = neardup.grouped(docs).filter("kept or n_shingles = 0")
    one = rows.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("_id"), F.min("key").alias("_key"), (F.count(F.lit(1)) > 1).alias("_many"))
    bare = rows.filter("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.lit(False).alias("_many")).distinct()
    kept = stored(one.select("_id", "_key", "_many").unionByName(bare))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), neardup.text_key(F.col("text")).alias("key"))
    out = rows.join(kept.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("row", "_id", "_key", "_many")
    if kept.filter("_many").isEmpty():
        return out.select("row.*")
    return out.filter("not _many").unionByName(out.filter("_many").dropDuplicates(["_id", "_key"])).select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none, once, or twice; rows that repeat an id share its coin. A null source is a source of its own."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, copies included, in sequences of at most 4096 tokens; an empty text is its end id alone."""
    return packing.pack(packing.pieces(docs, tokens.tokenizer_path("word_bpe_49k.json"), end_id=1))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", packed),
]

#: The classifiers are fitted in numpy, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the tables that a stage has stored go once its result is written."""
    docs = table(spark, sf_dir, "documents")
    mark = stored_so_far()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
            discard_since(spark, mark, docs)
    return docs

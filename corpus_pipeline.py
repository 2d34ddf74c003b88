"""From raw documents to packed training sequences: five stages, each one of the corpus operators.

Every stage takes the documents that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common, mixing, packing, quality, simhash, suffixes, tokens


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, learned from these documents' labels, scores below its threshold.

    Null and empty texts are scored like any other; repeated rows get one score each; of an empty table nothing is left.
    Other columns pass unchanged, whatever their names. Very long texts are scored whole, one at a time.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter(F.col(common.fresh(docs.columns, "quality_score")) >= quality.THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) one row stays, of the least doc_id and text hash.

    Rows without an id come after all others. Ids may repeat with different texts: rows are told by both. Rows that repeat
    id and text are copies, and one of them stays, whichever its other columns. Null texts are copies of empty ones. Other
    columns pass unchanged, whatever their names; an empty table stays empty. Very long texts are compared whole.
    """
    own, kept = common.fresh(docs.columns, "near_row"), common.fresh(docs.columns, "near_kept")
    row = lambda doc_id, key, name: F.struct(doc_id.cast("long").alias("doc_id"), key.alias("text_key")).alias(name)  # noqa: E731  equal where both are, nulls too
    groups = simhash.similar_documents(docs, shingle_words=5, similarity=0.8)
    firsts = groups.filter(F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))).select(row(F.col("doc_id"), F.col("text_key"), kept)).distinct()
    keyed = docs.select("*", row(F.col("doc_id"), simhash.text_key(), own))
    # texts are shuffled once: both steps are by the same key
    return keyed.join(firsts, F.col(own) == F.col(kept), "left_semi").dropDuplicates([own]).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 100 bytes that occur earlier out of the texts; documents of which nothing is left go.

    Null texts stay null, empty ones empty, and n_chars is counted anew. Repeated rows are documents one after the other.
    Other columns pass unchanged, whatever their names; an empty table stays empty. Very long texts are judged whole.
    """
    cut, spans = suffixes.cut_repeats(docs), F.col(common.fresh(docs.columns, "cut_spans"))
    left = cut.filter((spans == 0) | (F.trim("text") != ""))
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources asks for: repeated documents are repeated rows.

    Null sources are one source; null and empty texts have no words, and are taken as often as their block is. Other
    columns pass unchanged, whatever their names; an empty table stays empty. Very long texts count whole.
    """
    return mixing.materialise(docs, mixing.mix(docs)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens; each copy of a repeated document is packed.

    Null and empty texts are documents of the end id alone; null ids stay null; very long texts are cut into pieces; an
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    return packing.pack(docs, tokens.vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good_quality),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeated_passages),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Hashing, learning and tokenising can't be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each but the last is written to the shared folder and read again.

    What a stage needed besides its input is dropped from the folder once the stage is written, and so is its input.
    """
    docs, read = common.documents(spark, sf_dir), []
    for k, (_, stage) in enumerate(STAGES):
        before = common.made_folders()
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            folder = common.new_folder(spark, f"stage-{k}")
            docs.write.mode("overwrite").parquet(folder)
            docs = spark.read.parquet(folder)
            common.drop_folders([*read, *(f for f in common.made_folders() if f not in before and f != folder)])
            read = [folder]
    return docs

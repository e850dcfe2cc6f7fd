"""Cleaning a corpus: toxicity, language, near duplicates, personal data, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over what its
predecessor kept; all but the last return the columns of `documents`.  `run`
writes each stage's rows as Parquet to the shared checkpoint folder and reads
them back, so a lost executor never costs more than one stage.

Rows that go: texts that the toxicity model rejects (predicted 1), texts
without a letter (language `und`), texts that the language model confidently
calls another language than the one they are filed under, and all but one
document of each group of near duplicates (five-word shingles, similarity 0.8
or more).  Personal data is replaced in place, and what is left is packed into
sequences of 4096 tokens.  Models learn only from documents
whose id is not held out, out of the documents that reach their stage.

Edge cases.  Null and empty texts, which have no letter, go at the language
stage; a text filed under no language stays if it has a letter.  Rows without an
id are judged by their text, are never taken for near duplicates, and stay.
Rows of one id are judged each until the near-duplicate stage, which keeps one
of them, the longest; ties go to the first text, then language and source.  An
empty table passes every stage, and so does one without labels (nothing is
toxic) or without known languages (only letterless texts go).  Columns beside
those of `documents` are dropped by the first stage, so their names cannot
clash with what a stage adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm import common, language, near_dedup, packing, pii, toxicity

#: Score from which a predicted language counts against the one that a document is filed under.
CONFIDENT = 0.9
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def drop_unreadable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the language that they are filed under, as far as the kernel classifier can tell; letterless texts go."""
    docs = docs.select(*COLUMNS)
    model = language.train(docs)
    if model is None:  # no language is known: only letters can be asked for
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    # a language that was never learned cannot be predicted, so it proves nothing
    foreign = (F.col("lang_pred") != F.col("lang")) & (F.col("score") >= CONFIDENT) & F.col("lang").isin(model.languages)
    return language.predict(docs, model).where((F.col("lang_pred") != language.UNKNOWN) & ~F.coalesce(foreign, F.lit(False))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate component, as one row; empty texts and rows without an id stay.

    Of the rows of a kept id the longest text stays.
    """
    docs = docs.select(*COLUMNS)
    kept = near_dedup.near_duplicates(docs, words=5, percent=80).where("doc_id is not null").groupBy("doc_id").agg(F.bool_and("kept").alias("kept")).where("kept").select("doc_id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last(), "text", *COLUMNS[2:]))
    first = docs.where("doc_id is null").unionByName(docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn("nth", nth).where("nth = 1").drop("nth"))
    return first.select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences of 4096 tokens: an index of the corpus, without the tokens.

    With the tokens (`pack_documents(docs)`) they would be shuffled twice, which is beyond the disk of a stage.
    """
    return packing.pack_documents(docs, keep_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unreadable),
    ("minhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: The learned stages and the packing have no SQL; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

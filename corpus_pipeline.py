"""A corpus pipeline of five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame;
it is written as Parquet to the shared folder and read again as the next
stage's documents, so a lost executor costs the running tasks of one stage.
Every stage works on all rows that its predecessor kept, and its decisions
take effect: rejected rows are gone, masked texts replace the old ones.  All
but the last return the columns of ``documents``.

1. toxicity: rows whose calibrated score reaches the threshold go (fitted on
   the label rows that may be learned from);
2. exact dedup: of equal texts one row stays;
3. near dedup: shingle sets of five words with a Jaccard similarity of 0.8 or
   more link, one row of each group stays;
4. pii: personal data is replaced by its kind in angle brackets;
5. packing: the texts become pieces of sequences of at most 2048 tokens.

An empty table passes through all stages.  Null texts count as empty: they are
not toxic, equal to each other, link with nothing, and pack to an end token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm.common import give_back, materialize, read_table, ship, small_batches
from aurum.llm.exact_dedup import deduplicate
from aurum.llm.ngram_join import jaccard_components
from aurum.llm.packing import pack_documents
from aurum.llm.pii import fit as fit_pii
from aurum.llm.pii import mask_pii
from aurum.llm.toxicity import drop_toxic, learnable
from aurum.llm.toxicity import fit as fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    labels = learnable(read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    index = fit_toxicity(docs, labels, "text", "doc_id", "toxic")
    return drop_toxic(docs, index)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by a number of their own: ids may repeat or be null.
    Of each group the row with the smallest id stays (null last, then the first row)."""
    ship(spark)
    small_batches(spark)
    give_back()
    row = "__row"
    while row in docs.columns:
        row += "_"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    out = materialize(jaccard_components(numbered, doc_id=row, width=5, percent=80).select(F.col("id").alias(row), "component_id"), "near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", row)).alias("first")
    stay = numbered.select("doc_id", row).join(out, row).groupBy("component_id").agg(first).select(F.col(f"first.{row}").alias(row))
    return numbered.join(stay, row, "left_semi").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    field = fit_pii(docs)
    give_back()
    return mask_pii(docs, field, length="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup), ("pii", pii), ("packing", packing)]

#: Nearest-neighbour scores and the conditional random field have no SQL form;
#: tests compare run() with the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split(" ")[0])
    return STAGES[-1][1](spark, docs, sf_dir)

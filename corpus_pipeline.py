"""From raw documents to encoded training text: language, near copies, repeated passages, benchmark passages, pieces.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written and read again as the next one's
``docs``; all but the last return the columns of documents. Stages keep rows in no particular order. A row with a null
id passes the stages that compare documents unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridframe.llm import decontaminate, langid, partenum, pieces, substring, vocabulary
from gridframe.llm.idmap import id_map
from gridframe.llm.textbytes import small_batches
from gridframe.session import cut, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; ``lang`` stays as it came.

    The centroids are learned from the stage's own labelled rows. Documents without a letter are rejected, and those
    farther from every centroid than labelled rows of their size are from their own language.
    """
    small_batches(spark)
    model = langid.fit(docs.where("doc_id IS NOT NULL"))
    judged = langid.predict(docs.select(*COLUMNS), model)
    return judged.where("NOT rejected").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by 5-word shingles at similarity 0.8.

    Of rows that share its id, the first by its columns stays.
    """
    small_batches(spark)
    found = partenum.similar_components(docs).where("doc_id IS NOT NULL")
    # Only documents that go or whose id repeats must meet the result; a bit map lets the others pass where they are.
    ids = cut(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("first")))
    maybe = id_map(ids.where("n > 1 OR first <> doc_id"))
    known = docs.where("doc_id IS NOT NULL").select(*COLUMNS).withColumn("_maybe", maybe.may_hold("doc_id"))
    sure = known.where("NOT _maybe").select(*COLUMNS)
    kept = known.where("_maybe").join(ids.where("first = doc_id").select("doc_id"), "doc_id", "left_semi")
    rows = Window.partitionBy("doc_id").orderBy(*COLUMNS[1:])
    single = kept.withColumn("_row", F.row_number().over(rows)).where("_row = 1").select(*COLUMNS)
    return sure.unionByName(single).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 20-word runs that start earlier; changed texts have their kept words joined by spaces.

    A document with no word left goes; one that had none stays.
    """
    small_batches(spark)
    kept = substring.remove_repeats(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    left = kept.where((F.col("n_removed") < F.col("n_words")) | ~changed)
    length = F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return left.select("doc_id", text.alias("text"), "lang", "source", length.alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    small_batches(spark)
    found = decontaminate.find_matches(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("matches") == 0).select(*COLUMNS)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, pieces`` and whether decoding gives the text back."""
    small_batches(spark)
    words = vocabulary.load()
    decoded = pieces.round_trip(docs.select("doc_id", "text"), words)
    exact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", exact.alias("exact"))


STAGES = [
    ("language ID", known_languages),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", as_pieces),
]

#: The stages have no SQL counterpart; tests hold them against a plain version in one process.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

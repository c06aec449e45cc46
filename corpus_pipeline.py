"""A corpus pipeline of five operators, each over all that the stage before it kept.

Language identification, near-duplicate groups, benchmark decontamination,
personal data, packing. All stages but the last return documents. Models are
fitted on the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.llm import decontam, jaccard, langid, packing, pii
from plantlens.llm.common import bounded, cut, read, sized
from plantlens.llm.queries import tokenizer_path


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter or far from every model go."""
    bounded(spark)
    told = langid.identify(docs, langid.fit_on(docs), *docs.columns)
    return told.filter("not rejected").select(*docs.columns)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and its column that tells all rows apart: doc_id, or where that repeats or is null a written number."""
    odd = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs, "doc_id"
    return cut(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered"), "_row"


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each near-duplicate group, once; null ids come last.

    Unlinked texts stay, whatever their ids. Texts of no words link to none, but
    equal rows are one.
    """
    bounded(spark)
    rows, key = numbered(docs)
    found = cut(jaccard.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text")), "near")
    if key == "doc_id":
        kept = found.filter("doc_id = component_id").select("doc_id")
    else:
        ids = rows.select(key, F.col("doc_id").alias("id"), F.coalesce(F.sha2("text", 256), F.lit("")).alias("sha"))
        alone = F.col("n_shingles") == 0
        group = [F.when(~alone, F.col("component_id")), F.when(alone, F.col("id")), F.when(alone, F.col("sha"))]
        first = F.min(F.struct(F.col("id").isNull(), "id", "sha", key))
        kept = found.join(ids, F.col("doc_id") == F.col(key)).groupBy(alone, *group).agg(first[key].alias(key)).select(key)
    return rows.join(sized(cut(kept, "kept")), key, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, each row on its own."""
    rows, key = numbered(docs)
    found = decontam.contamination(rows.select(F.col(key).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    hit = cut(found.filter("contaminated").select(F.col("doc_id").alias(key)), "hit")
    return rows.join(sized(hit), key, "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each personal item replaced by its kind; n_chars follows the text."""
    bounded(spark)
    clean = pii.masked(docs, pii.fit_on(docs.select("doc_id", "text")), *docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    bounded(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("language", in_a_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Trained stages are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline: quality rules, toxicity, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``; the last returns the packed pieces. A document that a stage rejects is gone for the later ones.
Rows are rejected one by one, by file and place in the file: rows that share a doc_id, or have none, do not share their fate.
Only an input that is no read of files is written once more, with a number for each row. Null and empty texts fail the quality rules.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import near_dedup, packing, quality_rules, secrets_scan, toxicity
from tidemark.llm.queries import tokenizer_path
from tidemark.sources.storage import release, stored


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number for the row, the same whenever they are read, and its column.

    Of a read of Parquet files the number is made of the file and the row's place in it. Other frames are stored with one, and so are the
    rare files whose numbers meet.
    """
    key = "_stage_row"
    while key in docs.columns:
        key += "_"
    # a plan without a part below it is a plain read; others (a limit, say) may give other rows when they are read again
    if docs._jdf.queryExecution().analyzed().children().isEmpty() and "_metadata" not in docs.columns:
        file = F.shiftleft(F.crc32(F.col("_metadata.file_path").cast("binary")).bitwiseAND((1 << 31) - 1), 32)
        try:
            numbered = docs.withColumn(key, file.bitwiseOR(F.col("_metadata.row_index")))
        except AnalysisException:  # no files, or files without numbers of rows
            pass
        else:
            if numbered.groupBy(key).count().where("count > 1").isEmpty():
                return numbered, key
    return stored(docs.withColumn(key, F.monotonically_increasing_id())), key


def without(docs: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs``, made by ``keyed``, whose number is not in ``rejected``; their columns as they were."""
    return docs.join(rejected.select(key), key, "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules, or that boilerplate lines have left with too little."""
    docs, key = keyed(docs)
    return without(docs, stored(quality_rules.quality_rules(docs, id_column=key).where("not kept").select(key)), key)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted to be toxic by a model fitted on the labelled ones among ``docs``."""
    docs, key = keyed(docs)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, stored(toxicity.score(docs, model, id_column=key).where("predicted = 1").select(key)), key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, the one with the smallest id, of each group of near duplicates. Missing ids come last."""
    docs, key = keyed(docs)
    classes = near_dedup.near_duplicates(docs, id_column=key)
    found = classes.select(key, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)
    placed = stored(found.join(docs.select(key, order.alias("place")), key))
    first = placed.groupBy("component_id").agg(F.min("place").alias("first"))
    rejected = stored(placed.join(first, "component_id").where("place != first").select(key))
    release(classes, placed)
    return without(docs, rejected, key)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; ``n_chars`` follows the new text."""
    clean = secrets_scan.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents into sequences without padding."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: SQL cannot express the fitted model, the near duplicates and the packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from ``documents`` on; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        last, docs = docs, stored(stage(spark, docs, sf_dir))
        release(last)
    return STAGES[-1][1](spark, docs, sf_dir)

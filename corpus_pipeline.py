"""A training corpus in five stages: toxic documents go, near copies go, benchmark passages go, sources are mixed, ids are written.

Every stage reads the whole table that its predecessor wrote; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from confluo.llm.decontaminate import decontaminate
from confluo.llm.mixing import mix
from confluo.llm.nearcopies import drop_near_copies
from confluo.llm.simhash import keep_one_per_group
from confluo.llm.tokens import read_token_files, tokenizer_path, write_token_files
from confluo.llm.toxicity import drop_toxic
from confluo.plans.storage import new_path, store

#: Documents of which benchmark passages are a larger share of the words are removed; below, the passages are cut out.
MAX_COVERAGE = 0.1


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, row by row: null and empty texts are judged like a text without words.

    Rows with null or repeated ids are judged by their own texts; an empty table stays empty.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the row with the smallest id stays; of what is left, near copies by five-word Jaccard go too.

    Rows are judged one by one, whatever id they share; null ids come last, then the hash of the text decides.  Null, empty
    and wordless texts are one group.  An empty table stays empty.
    """
    return drop_near_copies(store(keep_one_per_group(docs), "unlinked"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are benchmark to over a tenth of their words go.

    Null texts stay null; ids, other columns and repeated rows are kept; an empty table or benchmark changes nothing.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_coverage=MAX_COVERAGE)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by the rates of their sources; null is a source of its own.

    Rows with a null or repeated id draw by their texts.  An empty table stays empty.
    """
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written in the binary format and read back: doc_id, start, n_tokens, ids_crc32, a row for each row of ``docs``.

    Null texts are the end id alone; null ids come first; an empty table gives an empty table.
    """
    path = new_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_path())
    return read_token_files(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: Tokenizer, trees and hashes are beyond SQL; tests/llm hold the stages against plain versions of their operators and on planted cases instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

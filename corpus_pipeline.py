"""A training corpus from raw documents: language ID, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (session, documents, folder of tables), works on all that its predecessor kept, and returns documents
with the same columns; the last returns pieces of packed sequences.

For all stages: an empty table gives no rows; extra columns are carried along, whatever their names; null and empty
texts do not fail. Rows with a null id pass the stages that compare documents unchanged, as nothing can name them. Rows
that share an id but not their text are documents of their own: each is told apart by id and text.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import gridloom
from gridloom.llm.bloom import build_bits, log_blocks, probe
from gridloom.llm.decontaminate import decontaminate
from gridloom.llm.language import UNKNOWN, identify_languages, learn_profiles
from gridloom.llm.neardup import near_duplicates
from gridloom.llm.packing import pack
from gridloom.llm.repeats import cut_repeats, repeated_passages
from gridloom.plans.scratch import settings, written, written_alone

for _module in (gridloom, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

#: A text is rejected when it fits no learned language better than this; prose of a learned one scores above 0.35.
LEAST_SCORE = 0.15


#: A task hands its Python worker so many bytes of rows at once: a batch counted in rows may hold very long texts.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20)}


def settled(spark: SparkSession, make: Callable[[], DataFrame], what: str) -> DataFrame:
    """The rows of ``make()``, worked out now, as the settings of a session hold only for what runs under them."""
    with settings(spark, BATCHES):
        return written_alone(spark, make, what)


#: What tells a document from all others within a stage.
KEY = "_gridloom_row_key"


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The documents with a long ``KEY``, and whether ids repeat. Rows of one key have one id and one text, and keys are
    in the order of ids; a null id has no key.

    Where no id repeats, that is the id itself. Else pairs of id and the text's fingerprint are numbered in order, and
    the numbers joined to the rows; two texts of one id have one fingerprint with a probability of 2^-64.
    """
    mark = "_gridloom_text"
    marked = docs.withColumn(mark, F.xxhash64("text"))
    known = marked.where("doc_id IS NOT NULL").select("doc_id", mark)
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn(KEY, F.col("doc_id").cast("long")), False
    pairs = known.distinct().repartitionByRange("doc_id", mark).sortWithinPartitions("doc_id", mark)
    numbers = written(pairs.withColumn(KEY, F.monotonically_increasing_id()), "row-keys")
    return marked.join(numbers, ["doc_id", mark], "left").select(*docs.columns, KEY), True


def parted(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``KEY`` may be in ``keys``, all other rows). The first are those of ``keys`` and a few more.

    Only the key is looked at, where the rows are read, by a filter of fixed size; so a join with ``keys`` that follows
    moves no other row's text, however large both tables are.
    """
    power = log_blocks(keys.count())
    bits = build_bits(keys.select(F.xxhash64(F.col(key).cast("long")).alias("h")), power)

    @F.arrow_udf("boolean")
    def among(hashes: pa.Array) -> pa.Array:
        return pa.array(probe(bits, power, hashes.to_numpy().view(np.uint64)))

    found = among(F.xxhash64(KEY))
    return rows.where(found), rows.where(~found)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents name; ``lang`` is what was found. Null, empty and
    letterless texts are rejected; repeated rows are judged alike. Only what changes is written: ids and fingerprints of
    texts that are rejected or of another language than named."""
    with settings(spark, BATCHES):
        profiles = learn_profiles(docs.select("doc_id", "text", "lang"))
    own = {name: f"_c{k}" for k, name in enumerate(docs.columns)}  # names that no result of the operator has
    plain = docs.toDF(*own.values())
    ident, text, lang = (own[name] for name in ("doc_id", "text", "lang"))
    marked = plain.withColumn("_mark", F.xxhash64(text))
    found = identify_languages(marked, profiles, ident, text, (ident, lang, "_mark"))
    fits = F.coalesce((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE), F.lit(False))
    told = found.select(F.col(ident).alias("_id"), "_mark", F.col("lang_pred").alias("_lang"), fits.alias("_fits"), lang)
    changes = told.where(~F.col("_fits") | ~F.col("_lang").eqNullSafe(F.col(lang))).drop(lang).dropDuplicates(["_id", "_mark"])
    changed = settled(spark, lambda: changes, "languages")
    same = F.col(ident).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_mark"))
    kept = plain.join(changed, same, "left").where("_fits IS NULL OR _fits")
    columns = (F.coalesce("_lang", c) if c == lang else F.col(c) for c in own.values())
    return kept.select(*columns).toDF(*own)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, and of one id's that with the smallest
    fingerprint of its text. Of rows that repeat an id and its text one stays, whatever their other columns."""
    rows, repeated = keyed(docs)
    gone = settled(spark, lambda: near_duplicates(rows, (80, 100), KEY).where("NOT kept").select(F.col("doc_id").alias(KEY)).distinct(), "gone")
    some, others = parted(rows, gone, KEY)
    left = others.unionByName(some.join(gone, KEY, "left_anti"))
    if repeated:
        whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        one = left.where(f"{KEY} IS NOT NULL").groupBy(KEY).agg(F.min_by(whole, F.xxhash64(whole)).alias("_row")).select("_row.*")
        return one.unionByName(left.where(f"{KEY} IS NULL").select(*docs.columns))
    return left.select(*docs.columns)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that stood before; ``n_chars`` follows the text. Rows that
    repeat an id and its text are cut alike."""
    rows, _ = keyed(docs)
    found = settled(spark, lambda: repeated_passages(rows, KEY).where(F.size("cuts") > 0).select("doc_id", "cuts"), "cuts")
    some, others = parted(rows, found, "doc_id")
    named = settled(spark, lambda: some, "named")  # a task that cuts keeps no second Python worker to pick rows
    cut = cut_repeats(named, found, KEY).unionByName(others)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words in a row of a benchmark text stand."""
    rows, _ = keyed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = settled(spark, lambda: decontaminate(rows, benchmark, id_col=KEY).where(F.size("items") > 0)
                    .select(F.col("doc_id").alias(KEY)).distinct(), "leaks")
    return rows.join(leaks, KEY, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, as pieces of documents with their ids."""
    return settled(spark, lambda: pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2), "packed")


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("suffix_array_dedup", repeats_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: No SQL can express the first and last stage; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the folder's documents; each stage is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

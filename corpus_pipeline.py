"""A training corpus from ``documents``: language ID, line dedup, near-duplicate removal, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept.
All but the last return the columns of ``documents``.  Ids may be null or
repeat: a row is a document of its own, and stages that join their result back
give each row a key first.  After mixing, a document that the mix takes twice is there twice.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_encode
from tidemark.llm.common import materialize, table
from tidemark.llm.language_id import held_out, identify, train
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.ngram_join import ngram_join

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame, tag: str) -> DataFrame:
    """``docs`` with ``__row``, unique, and ``__content``, a hash of the row; written down, so that keys stay whatever is run again."""
    return materialize(docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("__content")).withColumn("__row", F.monotonically_increasing_id()), tag)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found, with that language as their ``lang``; those without letters (``und``) go."""
    tables = train(docs.filter(~held_out()))
    rows = docs.select("text", F.struct(*COLUMNS).alias("__doc"))  # whole rows pass through, none is looked up again
    found = identify(rows, tables, id_col="__doc").filter("lang_pred <> 'und'")
    return found.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"__doc.{c}") for c in COLUMNS])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of 40 or more code points that five or more documents share, but for their last holder."""
    kept = line_dedup(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked at five-word similarity of 0.8, one row, of the smallest id; a null id is the last."""
    rows = _keyed(docs, "pipeline-near")
    classed = ngram_join(rows, id_col="__row").select(F.col("doc_id").alias("__row"), F.col("class_id").alias("__class"), "class_size")
    classed = materialize(classed.filter("class_size > 1").drop("class_size"), "pipeline-classes")
    known = rows.select("__row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__content", "__row").alias("rank")).join(classed, "__row")
    first = known.groupBy("__class").agg(F.min("rank").alias("first")).select(F.col("first.__row").alias("__row"))
    gone = materialize(classed.select("__row").join(first, "__row", "left_anti"), "pipeline-gone")
    return rows.join(gone, "__row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    rows = _keyed(docs, "pipeline-rows")
    taken = materialize(mix(rows, ties=("__content", "__row")).filter("copies > 0").select("__row", "copies"), "pipeline-mix")
    # Both sides grow with the input: a merge join at every size.
    return rows.join(taken.hint("merge"), "__row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and a hash of the bytes they decode to."""
    out = bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: Suffix automata, MinHash tries and BPE merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: the stages that turn ``documents`` into training tokens.

Every stage takes (spark, docs, sf_dir), works on all documents it is given and
returns documents again; the last one adds the token ids. What each stage does:

1. language ID: learns from the documents' own languages and drops those it rejects: without a text or a
   letter, or whose n-grams are, whatever the text's length, far less likely in the best
   language than its training text's (another script, gibberish). Where no row names a language, nothing
   can be learned, and all texts with a letter stay.
2. near-dedup: of the documents whose 5-word shingle sets are linked by a similarity
   of 0.8 or more, the one with the smallest id stays (one without an id only if none has
   one). Rows are compared by a number of their own, so neither a repeated id links
   unlike texts nor a missing one keeps copies.
3. PII: replaces personal data by its kind in brackets; ``n_chars`` follows.
4. mixing: takes each document as often as the mix of sources asks, up to twice.
5. byte-level BPE: the text gives way to ``n_tokens`` and ``ids`` (packed, little-endian).

``ORACLE_SQL`` is None: SQL can express neither the classifier, the tilted rates nor
the merges. The tests hold each stage against a brute-force version instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacecast.llm import bpe, langid, mixing, neardup, pii
from pacecast.llm.common import columns, release, stored

#: Standard deviations of an n-gram's log probability that a text's mean may lie below its language's.
LEAST_FIT = -2.5
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; ``lang`` itself is not changed."""
    model = langid.train(docs)
    found = langid.predict(docs, model, lang_to="__lang", score_to="__score", fit_to="__fit")
    return found.where(F.col("__fit") >= LEAST_FIT).select(*columns(docs, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, whatever their ids; fully repeated rows are copies as well."""
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id())
                      .withColumn("__text", F.xxhash64("text")), "pipeline-rows")
    found = neardup.near_duplicates(numbered, id_col="__row", keep=["doc_id", "__text"])
    # rows without words are linked with nothing: of these, only repeated rows with an id are copies
    alone, named = F.col("n_shingles") == 0, F.col("doc_id").isNotNull()
    group = [F.when(alone & named, F.lit(None)).when(alone, F.col("__row")).otherwise(F.col("component_id")),
             *[F.when(alone & named, F.col(c)) for c in ("doc_id", "__text")]]
    # the smallest id of a group stays, an id before none, and of its rows the first
    first = F.min(F.struct((~named).alias("unnamed"), "doc_id", "__row"))
    winners = (found.groupBy(*[c.alias(f"__{i}") for i, c in enumerate(group)]).agg(first.alias("__first"))
               .select(F.col("__first.__row").alias("__row")))
    return numbered.join(winners, "__row", "left_semi").select(*columns(docs, docs.columns))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced."""
    out = pii.redact(docs)
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-numbered")
    taken = mixing.mix(numbered, keep=["__row"]).where("copies > 0").select("__row", "copies")
    repeated = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")
    return (numbered.join(taken, "__row").select(*columns(docs, docs.columns), repeated)
            .select(*columns(docs, docs.columns)))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    kept = [c for c in docs.columns if c != "text"]
    return bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, keep=kept)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("PII", redact_pii),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode_bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage in turn to ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
        release(spark, keep=1)  # what the stage wrote on its way, and the documents it read
    return STAGES[-1][1](spark, docs, sf_dir)

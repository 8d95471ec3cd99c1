"""The corpus pipeline: quality rules, near copies, personal data, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep
the columns of ``documents``.  ``run`` applies the stages one after the other and writes
each result to the shared folder, from which the next stage reads it; what a stage stored for
itself is removed then.

Missing, empty and blank texts have too few words and go in the first stage, as do rows of
hosts that fail; no documents give no rows.  Columns besides those of ``documents`` are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catchframe.llm import bpe, mixing, pii, quality, simhash
from catchframe.llm.common import stored, table
from catchframe.session import release, working_folders


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule and come from hosts that pass; a document without a host is of a host of its own."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of four-word shingles that differ in four bits at most.

    The smallest id stays, a missing one only if there is no other; equal rows are one document.
    """
    return simhash.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates under the session's key; ``n_chars`` follows, a missing text stays missing."""
    return pii.replace(docs, pii.session_key(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled in shards; texts without words are not taken."""
    return mixing.mixed(docs, whole=True)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document's text as a digest, and their number; a missing text counts as empty."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", drop_bad),
    ("near_copies", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

# Pair merging, fingerprints and keyed draws have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = set(working_folders())
        docs = stored(stage(spark, docs, sf_dir), name)
        # The result's folder is the last one; the others are not read again.
        release(spark, [f for f in working_folders()[:-1] if f not in before])
    return docs

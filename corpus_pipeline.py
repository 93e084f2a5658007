"""Corpus pipeline: the stages that a table of documents goes through, each by its operator.

``run`` applies the stages to ``documents``; each stage's rows are written as Parquet and read again,
so a lost executor repeats work of one stage only.  The first four return the columns of documents,
the last what the token files hold of each document.
"""

from __future__ import annotations

import public_tokenizers

from weekcast.llm import decontaminate, mixing, quality, simhash, wavelet
from weekcast.llm.common import staged, table


def quality_filter(spark, docs, sf_dir):
    """Documents that the classifier accepts; it learns from the labels outside the held-out fifth."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each SimHash group: 4-word shingles, at most 4 differing bits."""
    return simhash.keep_one(docs, k=4, radius=4)


def decontamination(spark, docs, sf_dir):
    """Documents without any 10-word window of the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"), n=10)


def source_mix(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them: weights 1, 2, 3, three epochs at most."""
    return mixing.mixed_documents(docs)


def token_output(spark, docs, sf_dir):
    """Token files of the mix, and what they hold per document."""
    return wavelet.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_filter", quality_filter), ("simhash_near_dedup", simhash_near_dedup),
          ("decontamination", decontamination), ("source_mix", source_mix), ("token_output", token_output)]

#: Fingerprints, trees and token ids have no SQL form: tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

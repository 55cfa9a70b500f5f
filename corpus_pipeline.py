"""The corpus pipeline: STAGES in order, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the docs of the next one.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from tabspark.llm import common, decontaminate, jaccard_join, mixing, quality, secrets


def quality_rules(spark, docs, sf_dir):
    """Documents that the rule cascade rejects go."""
    return quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of the n-gram Jaccard join stays."""
    return jaccard_join.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that are contaminated by benchmark items go."""
    return decontaminate.drop_contaminated(docs, common.read(spark, sf_dir, "benchmark"))


def secret_masking(spark, docs, sf_dir):
    """Secrets are masked in the texts."""
    return secrets.mask(docs)


def source_mixing(spark, docs, sf_dir):
    """All documents with their place in the mix of sources, in that order."""
    return mixing.mix(docs).orderBy("slot", "in_block")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_masking),
    ("mixing sources", source_mixing),
]


def run(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The classes of the join come from repeated joins of a graph; tests hold the rows against brute force.
ORACLE_SQL = None

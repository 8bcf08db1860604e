"""The corpus pipeline (part of the ``tillguard.llm`` subpackage).

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's ``docs``.  Every stage works on
all that its predecessor kept; all but the last return the columns of
``documents``.
"""

from tillguard.llm import jaccard, packing, quality, secrets, toxicity
from tillguard.llm.common import written


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or the learned verdict go."""
    return quality.stage(spark, docs, sf_dir)


def toxic_documents(spark, docs, sf_dir):
    """Documents whose expected severity is too high go."""
    return toxicity.stage(spark, docs, sf_dir)


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of linked documents stays."""
    return jaccard.stage(spark, docs, sf_dir)


def redact_secrets(spark, docs, sf_dir):
    """Secrets are replaced in the text; every document stays."""
    return secrets.stage(spark, docs, sf_dir)


def pack_windows(spark, docs, sf_dir):
    """Pieces of the documents by sequence, with the ids' checksums."""
    return packing.digest(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("jaccard_join", near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack_windows),
]

#: Not expressible in SQL (fitted models, tokenizer); tested by brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

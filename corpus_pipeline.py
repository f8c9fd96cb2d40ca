"""Documents to a training mixture: STAGES in order, each stored as Parquet and read again as the next one's input."""

from readgrade.llm import byte_cnn, exact_dedup, latent_decontam, mixing, simhash
from readgrade.llm.common import stored, table


def quality(spark, docs, sf_dir):
    """Documents that the byte-level network rejects go; it learns from ``labels`` of the documents it is given."""
    return byte_cnn.keep_good(docs, byte_cnn.train(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the one with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Of texts whose fingerprints of three-word shingles are connected over three differing bits or fewer, the one with the smallest id stays."""
    return simhash.drop_near_copies(docs, width=3, radius=3)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return latent_decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark, docs, sf_dir):
    """Documents as often as the mixture of their sources uses them, with epoch and block_rank."""
    return mixing.mix(docs)


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("decontamination", decontamination), ("mixture", mixture)]
#: The stages hash and learn in ways that SQL lacks; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on ``documents``; empty tables, nulls and clashing column names as each operator says."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

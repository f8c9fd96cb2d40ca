"""SimHash near-dedup: 64-bit fingerprints, links at few differing bits, components.

Distinct fingerprints only are compared. Fingerprints in reach of each other agree in at least two
of five bit blocks, so each is dealt to ten buckets, one for each pair of blocks. A
bucket that is larger than a limit is split again by the same rule on the bits that are still free,
twice at most: the last buckets leave 16 bits free or fewer and so hold 65,536 distinct
fingerprints at most, however many documents there are. Buckets are compared by bit slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from readgrade.llm import bitslice
from readgrade.llm.common import checked_broadcast, fresh, per_text, stored, table, with_columns
from readgrade.llm.components import components

BLOCKS, SEED, PART = 5, 42, 1 << 16
#: Buckets of more distinct fingerprints are split by further bits.
LIMIT = 4096


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Bits that are set in over half of the hashes of the word shingles; zero without words."""
    words = (text or b"").lower().split()  # of bytes: A-Z and the six ASCII spaces
    if not words:
        return 0
    total, count, digest = np.zeros(64, np.int64), max(1, len(words) - width + 1), xxhash.xxh64_intdigest
    for begin in range(0, count, PART):
        part = range(begin, min(begin + PART, count))
        h = np.fromiter((digest(b" ".join(words[i:i + width]), SEED) for i in part), "<u8", len(part))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""
    def start():
        return lambda texts: [np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)]

    return per_text(docs, id, text, "fp long", start)


def _masks(free: list[int], agree: int) -> list[int]:
    """Masks of every choice of ``agree`` of five blocks of the free bits."""
    blocks = [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(free), BLOCKS)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def _levels(radius: int) -> list[list[int]]:
    """Masks of each level, all its masks in a fixed order; masks of a level extend those of the one before."""
    agree, levels = BLOCKS - radius, [[0]]
    for _ in range(3):
        levels.append([mask | more for mask in levels[-1]
                       for more in _masks([b for b in range(64) if not mask >> b & 1], agree)])
    return levels[1:]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, radius: int = 3, limit: int = LIMIT) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints ``fp`` that differ in at most ``radius`` (1 to 3) bits.

    Within a bucket the links found are reduced to one from each fingerprint to the smallest of its
    component there, which loses no connection.
    """
    branch = len(_masks(list(range(64)), BLOCKS - radius))
    rows, found = distinct.select(F.lit(0).alias("m"), "fp"), None
    for level, masks in enumerate(_levels(radius)):
        own = F.array(*[F.lit(_signed(x)) for x in masks])
        rows = rows.select("fp", F.explode(F.sequence(F.col("m") * branch, F.col("m") * branch + branch - 1)).alias("m"))
        rows = rows.select("fp", "m", F.col("fp").bitwiseAND(F.element_at(own, F.col("m") + 1)).alias("key"))
        sizes = stored(rows.groupBy("m", "key").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
        rows = rows.join(checked_broadcast(sizes), ["m", "key"])
        last = level == 2
        compared = rows if last else rows.where(F.col("n") <= limit)
        new = (compared.select("m", "key", "fp").repartition("m", "key").sortWithinPartitions("m", "key", "fp")
               .mapInArrow(_compare(radius), "a long, b long"))
        found = stored(new, "near") if found is None else found.unionByName(stored(new, "near"))
        if last or sizes.where(F.col("n") > limit).isEmpty():
            return found
        rows = rows.where(F.col("n") > limit).select("m", "fp")


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * 3
        for batch in _and_none(batches):
            if batch is None:
                whole, rest = rest, None
            else:
                rest = [np.concatenate((x, batch.column(k).to_numpy())) for k, x in enumerate(rest)]
                m, key, _ = rest
                other = np.flatnonzero((m != m[-1:]) | (key != key[-1:]))  # rows of buckets that are complete
                cut = int(other[-1]) + 1 if len(other) else 0
                whole, rest = [x[:cut] for x in rest], [x[cut:] for x in rest]
            m, key, fp = whole
            if len(m) < 2:
                continue
            new = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (key[1:] != key[:-1]))))
            ends = np.repeat(np.append(new[1:], len(m)), np.diff(np.append(new, len(m))))
            root = bitslice.local_roots(len(m), bitslice.near_pairs(fp.view(np.uint64), ends, radius))
            linked = np.flatnonzero(root != np.arange(len(m)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], names=["a", "b"])
    return run


def _and_none(batches):
    yield from batches
    yield None


def groups(prints: DataFrame, radius: int, limit: int) -> DataFrame:
    """(fp, component_id) of all fingerprints of the stored table (id, fp) that are shared or linked."""
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")), "distinct-prints")
    members = components(links(distinct.select("fp"), radius, limit))
    joined = distinct.join(members.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    several = stored(joined.where("linked or n > 1"), "near-members")
    least = several.groupBy("root").agg(F.min("first").alias("component_id"))
    return stored(several.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "near-groups")


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3,
                limit: int = LIMIT) -> DataFrame:
    """(id, fingerprint, component_id), one row per input row.

    ``component_id`` is the smallest id that can be reached over links. Null and blank texts have fingerprint zero and are
    linked like any other; a null id is larger than any other; repeated rows are one node each. Other columns are not
    looked at.
    """
    prints = stored(fingerprints(docs, id, text, width).withColumnRenamed(id, "id"), "fingerprints")
    group = groups(prints, radius, limit)
    out = prints.join(checked_broadcast(group.withColumn("grouped", F.lit(True))), "fp", "left")
    return out.select(F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3,
                     limit: int = LIMIT) -> DataFrame:
    """One row of each group of :func:`near_groups`, all columns as they are: the one with the smallest id, of several with that id
    the one whose text comes first."""
    fp = fresh("fp", docs)

    def start():
        return lambda texts: [np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)]

    rows = stored(with_columns(docs, text, f"{fp} long", start), "printed-texts")
    prints = rows.select(F.col(id).alias("id"), F.col(fp).alias("fp"))
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id).alias("id"),
                         F.col(text).alias("t"), F.col(fp).alias("fp"))
    found = packed.join(checked_broadcast(groups(prints, radius, limit)), "fp", "left")
    alone = found.where("root is null").select("row.*")
    first = Window.partitionBy("root").orderBy("t")  # of rows with the group's smallest id: mostly one
    one = found.where(F.col("root").isNotNull() & F.col("id").eqNullSafe(F.col("component_id"))).withColumn(
        "k", F.row_number().over(first)).where("k = 1").select("row.*")
    return alone.unionByName(one)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))

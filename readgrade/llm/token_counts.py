"""Token counts of sections: encode a whole document once and give every token to a section by its character span.

A section is a span of characters. The token spans, which follow from the tokens' byte lengths, are joined with the spans of
the document's own sections by binary search, so no row leaves its task. A token that lies in several sections is
given away by an explicit rule:

* ``start``: to the section that holds its first character,
* ``majority``: to the section that holds most of its characters, the earlier one on a tie,
* ``split``: to all of them, in proportion to its characters there.

What lies in no section is counted for section -1. Bytes of one character that are in two tokens count as that
character for both.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from readgrade.llm.common import ship, slices, table

VOCABULARY = os.environ.get("READGRADE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("start", "majority", "split")


class Encoder:
    """A public byte-level vocabulary, read once a worker."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            self.sizes[rank] = len(piece)
        self.encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character, and the one behind the last, of every token of the whole text."""
        data = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum(self.sizes[np.array(self.encoding.encode_ordinary(text), np.int64)])
        before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters that begin before a byte
        begins = np.concatenate((np.zeros(1, np.int64), ends[:-1]))[:len(ends)]
        return before[begins + 1] - 1 if len(ends) else ends, before[ends] if len(ends) else ends


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sections: lines with their line feed; an empty text is one empty line."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    begins = np.concatenate(([0], np.flatnonzero(points == 10) + 1))
    begins = begins[(begins < len(points)) | (begins == 0)]
    return begins, np.append(begins[1:], len(points))


def attribute(first: np.ndarray, last: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of every section (sorted, apart from each other), and tokens of none."""
    counts = np.zeros(len(begins) + 1)  # the last: no section
    at = np.searchsorted(begins, first, side="right") - 1
    inside = (at >= 0) & (first < ends[at]) if len(begins) else np.zeros(len(first), bool)
    whole = inside & (last <= ends[at]) if len(begins) else inside
    own = np.where(inside, at, len(begins))
    if rule == "start":
        whole = np.ones(len(first), bool)
    counts += np.bincount(own[whole], minlength=len(counts))
    for k in np.flatnonzero(~whole):  # of the few that cross a boundary, the characters in each section
        s = np.arange(max(at[k], 0), np.searchsorted(begins, last[k]))
        share = np.maximum(np.minimum(ends[s], last[k]) - np.maximum(begins[s], first[k]), 0)
        parts, size = np.append(share, last[k] - first[k] - share.sum()), last[k] - first[k]
        to = np.append(s, len(begins))
        if rule == "majority":
            best = int(parts[:-1].argmax()) if len(s) and parts[:-1].max() >= parts[-1] else -1
            counts[to[best]] += 1
        else:
            counts[to] += parts / size
    return counts[:-1], float(counts[-1])


def count_tokens(docs: DataFrame, id: str = "doc_id", text: str = "text", rule: str = "start",
                 sections: Callable[[str], tuple[np.ndarray, np.ndarray]] = lines, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, section, start, end, n_tokens): a row for each section of each document, numbered from 0.

    ``sections`` gives a text's spans of characters, sorted and apart. Null text counts as empty, which is
    one empty section of ``lines``. There is a row for section -1, without a span, only where tokens lie in no section. Of
    repeated rows each gives its own rows. Other columns are not looked at.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    names = [id, "section", "start", "end", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            for begin, end in slices(column):
                rows, of = [], []
                for k, value in enumerate(column.slice(begin, end - begin).to_pylist()):
                    t = (value or b"").decode("utf-8", "replace")
                    begins, ends = sections(t)
                    counts, none = attribute(*encoder.spans(t), begins, ends, rule)
                    number = np.arange(len(begins))
                    if none:
                        number, counts = np.append(number, -1), np.append(counts, none)
                        begins, ends = np.append(begins, -1), np.append(ends, -1)
                    rows.append((number, begins, ends, counts))
                    of.append(np.full(len(number), begin + k))
                number, begins, ends, counts = (np.concatenate(x) for x in zip(*rows, strict=True))
                lost = number < 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(of))), pa.array(number.astype(np.int64)),
                     pa.array(begins.astype(np.int64), mask=lost), pa.array(ends.astype(np.int64), mask=lost), pa.array(counts)],
                    names=names)

    return docs.select(F.col(id), F.col(text).cast("string")).mapInArrow(
        run, f"`{id}` {kind}, section long, start long, end long, n_tokens double")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))

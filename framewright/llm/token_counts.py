"""Token counts by offset-mapped attribution.

Each whole text is encoded once. The tokens' byte lengths give their offsets, which are mapped to characters; sections
(here lines, each with its line end) are intervals in characters too. Both are sorted, so the interval join of tokens
and sections is a merge, done for a text at a time by binary search. A token that crosses a section's end goes to one
section by an explicit rule: 'first' (where it begins), 'last' (where it ends) or 'most' (the section that has most of
its characters, the earlier one on a tie). Counts of a text's sections always add up to the text's tokens.

Nothing is shuffled. The vocabulary is read where the driver runs and sent to the tasks; its path is a parameter.

Nulls and edge cases: a null or empty text is one section of no characters and no tokens; a null doc_id keeps its
rows; repeated rows are counted each; an empty table gives an empty table; other columns are ignored. A section
without a token of its own, as every token that touches it went to a neighbour, is returned with 0.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published split pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, section long, first long, end long, n_tokens long"


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def spans(self, text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and last character of every token; a token inside a character counts as that character."""
        ids = np.asarray(self.encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self.lengths[ids])
        if len(ids) and ends[-1] != len(raw):
            raise ValueError("tokens do not cover the text")
        if len(raw) == len(text):
            return ends - self.lengths[ids], ends - 1
        of = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
        return of[ends - self.lengths[ids]], of[ends - 1]


def sections_of(text: str) -> np.ndarray:
    """Starts of the lines, and the text's end: section k is [out[k], out[k + 1])."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = np.flatnonzero(points == 10) + 1
    return np.r_[0, starts[starts < len(points)], len(points)]


def attribute(first: np.ndarray, last: np.ndarray, edges: np.ndarray, rule: str = "most") -> np.ndarray:
    """Tokens of each section; tokens are [first, last] in characters, sections [edges[k], edges[k + 1])."""
    starts = edges[:-1]
    a = np.searchsorted(starts, first, "right") - 1
    z = np.searchsorted(starts, last, "right") - 1
    if rule == "last":
        a = z
    elif rule == "most":
        for k in np.flatnonzero(a != z):
            parts = np.minimum(edges[a[k] + 1 : z[k] + 2], last[k] + 1) - np.maximum(edges[a[k] : z[k] + 1], first[k])
            a[k] += int(np.argmax(parts))
    elif rule != "first":
        raise ValueError(rule)
    return np.bincount(a, minlength=len(starts))


def count_tokens(docs: DataFrame, id_col="doc_id", text_col="text", rule="most", vocabulary=VOCABULARY) -> DataFrame:
    """(doc_id, section, first, end, n_tokens), a row a line of every text."""
    ranks = docs.sparkSession.sparkContext.broadcast(ranks_of(vocabulary))  # one vocabulary, of fixed size

    def compute(batches):
        encoder = Encoder(ranks.value)
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 256):  # a text has many lines: results leave in small batches
                texts = batch.column(1).slice(at, 256).to_pylist()
                edges = [sections_of(x) for x in texts]
                counts = [attribute(*encoder.spans(x, x.encode()), e, rule) for x, e in zip(texts, edges)]
                n = [len(c) for c in counts]
                which = np.repeat(np.arange(at, at + len(texts)), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(which)),
                        pa.array(np.concatenate([np.arange(k) for k in n])),
                        pa.array(np.concatenate([e[:-1] for e in edges])),
                        pa.array(np.concatenate([e[1:] for e in edges])),
                        pa.array(np.concatenate(counts)),
                    ],
                    names=["doc_id", "section", "first", "end", "n_tokens"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(compute, SCHEMA)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))

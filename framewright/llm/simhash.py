"""SimHash near-dedup with a bit-sliced comparison of fingerprints.

Fingerprints are computed in Arrow batches, then reduced to the distinct ones. The 64 bits are cut into eight
bands; two fingerprints within ``RADIUS`` = 2 bits agree on at least six whole bands. Each fingerprint is
therefore sent once to each of the 28 choices of six bands, keyed by those 48 bits. A group of one key can
differ in 16 bits only, so it holds at most 65,536 distinct fingerprints, however many documents there are:
the bound is proven, no group is capped and no link is lost.

Bit planes are stored vertically: one word operation moves 64 distances on. Differing bits are added into carry-save
counters that start so high that a distance over the radius overflows; a block of lanes is abandoned once all have
(``far_lanes``). In small groups the lanes are pairs, over all groups of a batch; in large ones a tile of fingerprints
is compared with blocks of the others, less those it is connected with already (``linked``). The kernel takes any
radius and width; ``near_copies`` uses it with wide fingerprints of five words.

Nulls and edge cases: the graph's nodes are fingerprints, so rows without an id take part, and rows that repeat an id are
documents of their own. component_id is the smallest id in the component, null where no row of it has one. A null text
counts as empty; a text without words has fingerprint zero and links like any other. An empty table gives an empty
table. Columns other than the two read are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..sources.tables import written
from .common import text_of

RADIUS = 2
BANDS = 8
SEED = 42
#: Groups up to this size are compared pair by pair, the lanes being pairs.
SMALL = 16
TILE, WORDS = 64, 32
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _masks() -> list[int]:
    """The 28 masks that keep six of eight bands, as signed longs."""
    width = 64 // BANDS
    out = []
    for kept in combinations(range(BANDS), BANDS - RADIUS):
        mask = sum(((1 << width) - 1) << (width * k) for k in kept)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only


def shingle_hashes(text: str, words: int = 3) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, repeats included; A-Z lower-cased."""
    from xxhash import xxh64_intdigest

    parts = words_of(text)
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) <= words:
        return np.array([xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1).tolist()
    starts = [0, *ends]
    return np.array([xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)


def majority(octets: np.ndarray) -> np.ndarray:
    """(n, bytes) -> bytes: a bit is one if it is one in over half of the rows."""
    n, width = octets.shape
    ones = np.zeros(8 * width, np.int64)
    for at in range(0, n, 255 * 64):  # uint8 sums of at most 255 rows never overflow
        bits = np.unpackbits(octets[at : at + 255 * 64], axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            ones += np.add.reduce(bits[:whole].reshape(255, -1, 8 * width), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        if whole < len(bits):
            ones += np.add.reduce(bits[whole:], axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > n, bitorder="little")


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is one if it is one in over half of the hashes. Unsigned; zero without hashes."""
    return int(majority(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)).view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed long with the fingerprint's bits."""

    def compute(batches):
        for batch in batches:
            made = np.fromiter(
                (fingerprint(shingle_hashes(x.as_py(), words)) for x in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        compute, "doc_id long, fp long"
    )


# ---- the bit-sliced comparison


def planes_of(bits: np.ndarray) -> np.ndarray:
    """(lanes, bits) of 0 and 1 -> (bits, words): plane k holds bit k of all lanes, 64 to a word."""
    n = -(-len(bits) // 64) * 64
    wide = np.zeros((bits.shape[1], n), np.uint8)
    wide[:, : len(bits)] = bits.T
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def _add3(a, b, c):
    """Carry-save: (low, high) bits of the lanes' sums."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def far_lanes(plane, planes: int, shape: tuple, radius: int, over: np.ndarray | None = None) -> np.ndarray:
    """Words of lanes; a bit is one if more than ``radius`` of the planes have a one there. plane(k): words of plane k.

    Counters of k bits start at 2**k - 1 - radius, so that what is over the radius overflows. Eight planes go through a
    tree of carry-save adders at once where there are three counters or more. over: lanes that count as far anyway.
    """
    k = max(1, int(radius).bit_length())
    count = [np.full(shape, FULL if (1 << k) - 1 - radius >> t & 1 else 0, np.uint64) for t in range(k)]
    over = np.zeros(shape, np.uint64) if over is None else over

    def add(bit, level):
        for t in range(level, k):
            count[t], bit = count[t] ^ bit, count[t] & bit
        np.bitwise_or(over, bit, out=over)

    at = 0
    while at < planes:
        if k >= 3 and planes - at >= 8:
            p = [plane(at + x) for x in range(8)]
            count[0], two_a = _add3(count[0], p[0], p[1])
            count[0], two_b = _add3(count[0], p[2], p[3])
            count[1], four_a = _add3(count[1], two_a, two_b)
            count[0], two_a = _add3(count[0], p[4], p[5])
            count[0], two_b = _add3(count[0], p[6], p[7])
            count[1], four_b = _add3(count[1], two_a, two_b)
            count[2], eight = _add3(count[2], four_a, four_b)
            add(eight, 3)
            at += 8
        else:
            add(plane(at), 0)
            at += 1
        if at > radius and not at % 4 and (over == FULL).all():
            break  # abandoned
    return over


def _near(far: np.ndarray, lanes: int) -> np.ndarray:
    return np.unpackbits((~far).view(np.uint8), axis=-1, bitorder="little")[..., :lanes].astype(bool)


def _forest(octets: np.ndarray, radius: int, sides: np.ndarray | None):
    """Links (i, js) of one group that connect what is linked: at most one for each member. With sides only across."""
    bits = np.unpackbits(octets ^ octets[0], axis=1, bitorder="little")
    bits = bits[:, bits.any(0)]
    label = np.arange(len(bits))
    planes = planes_of(bits)
    for s in range(0, len(bits), TILE):
        rows = np.arange(s, min(s + TILE, len(bits)))
        p, lanes = planes[:, s // 64 :], np.arange(s // 64 * 64, len(bits))
        if (label[rows] == label[s]).all():
            others = lanes[label[lanes] != label[s]]
            if not len(others):
                continue
            if 2 * len(others) < len(lanes):
                p, lanes = planes_of(bits[others]), others
        flips = np.where(bits[rows].T[:, :, None], FULL, np.uint64(0))
        for w in range(0, p.shape[1], WORDS):
            q = p[:, w : w + WORDS]
            here = lanes[w * 64 : (w + WORDS) * 64]
            done = np.ones((len(rows), q.shape[1] * 64), np.uint8)  # padding, and each pair's second look
            done[:, : len(here)] = here <= rows[:, None]
            done = np.packbits(done, axis=1, bitorder="little").view("<u8")
            far = far_lanes(lambda k: q[k] ^ flips[k], len(q), done.shape, radius, done)
            if (far == FULL).all():
                continue
            near = _near(far, len(here))
            for r in np.flatnonzero(near.any(1)):
                i = rows[r]
                js = here[near[r]]
                js = js[label[js] != label[i]]
                if sides is not None:
                    js = js[sides[js] != sides[i]]
                if len(js):
                    old, first = np.unique(label[js], return_index=True)
                    yield int(i), js[first]
                    to = np.arange(len(bits))
                    to[old] = label[i]
                    label = to[label]


def linked(ends: np.ndarray, octets: np.ndarray, radius: int, sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of links within groups of rows that end at ``ends``; octets: (rows, bytes) of fingerprints.

    Small groups give all their links, large ones a spanning forest. sides: 0 and 1 where a group is two blocks, of which
    only pairs across count, else -1.
    """
    size = np.diff(ends, prepend=0)
    a_, b_ = [], []
    small = np.repeat(size <= SMALL, size)
    left = np.repeat(ends, size) - np.arange(len(octets))
    for lag in range(1, SMALL):
        a = np.flatnonzero(small & (left > lag))
        if not len(a):
            break
        for at in range(0, len(a), 1 << 16):
            x = a[at : at + (1 << 16)]
            planes = planes_of(np.unpackbits(octets[x] ^ octets[x + lag], axis=1, bitorder="little"))
            x = x[_near(far_lanes(planes.__getitem__, len(planes), planes.shape[1:], radius), len(x))]
            if sides is not None:
                x = x[(sides[x] < 0) | (sides[x] != sides[x + lag])]
            a_.append(x)
            b_.append(x + lag)
    for g in np.flatnonzero(size > SMALL):
        first = ends[g] - size[g]
        own = None if sides is None or sides[first] < 0 else sides[first : ends[g]]
        for i, js in _forest(octets[first : ends[g]], radius, own):
            a_.append(np.full(len(js), first + i))
            b_.append(first + js)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a_]), np.concatenate([none, *b_])


def compare_groups(keys: int, radius: int, at_once: int = 1 << 17):
    """Function of Arrow batches sorted by their first ``keys`` columns (then side, node, fingerprint) -> links (a, b) of nodes.

    side is -1 for a whole group, or 0 and 1 for two blocks of one. Groups are compared many at once.
    """

    def links(table):
        key = [table.column(k).to_numpy() for k in range(keys)]
        change = np.zeros(table.num_rows, bool)
        change[-1] = True
        for x in key:
            change[:-1] |= x[1:] != x[:-1]
        sides, nodes = (table.column(keys + k).to_numpy() for k in (0, 1))
        raw = table.column(keys + 2).combine_chunks()
        if pa.types.is_binary(raw.type):
            octets = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(table.num_rows, -1)
        else:
            octets = raw.to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
        a, b = linked(np.flatnonzero(change) + 1, octets, radius, sides)
        pairs = np.unique(np.sort(np.stack([nodes[a], nodes[b]], 1), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], names=["a", "b"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < at_once:
                continue
            table = pa.Table.from_batches(held)
            same = np.ones(rows, bool)  # the last group may go on in the next batch
            for k in range(keys):
                x = table.column(k).to_numpy()
                same &= x == x[-1]
            last = int(np.argmax(same))
            if last:
                yield links(table.slice(0, last))
                held, rows = table.slice(last).combine_chunks().to_batches(), rows - last
        if held:
            yield links(pa.Table.from_batches(held))

    return run


# ---- on tables


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """distinct(fp), each once -> (a, b): links that connect all fingerprints within ``RADIUS`` bits."""
    choices = F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(_masks())])
    keyed = distinct.select(F.explode(choices).alias("x"), "fp").select("x.choice", "x.key", F.lit(-1).alias("side"), F.col("fp").alias("node"), "fp")
    return (
        keyed.repartition("choice", "key")
        .sortWithinPartitions("choice", "key", "fp")
        .mapInArrow(compare_groups(2, RADIUS), "a long, b long")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every document: the smallest doc_id reachable by links of at most two bits."""
    marked = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    parts = connected_components(fingerprint_links(distinct.select("fp")))
    final = written(
        distinct.join(parts, distinct.fp == parts.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("part")), "parts"
    )
    least = final.groupBy("part").agg(F.min("least").alias("component_id"))
    return marked.join(final.join(least, "part").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )

"""The SimHash operator for whole texts: near copies by five-word shingles, with an exact check of every link.

Two texts are near copies if their sets of shingles of ``SHINGLE`` = 5 words have a Jaccard similarity of ``LIKE`` = 4/5
or more; groups are the components of those links. Fingerprints are SimHashes of ``WIDTH`` bits, compared bit-sliced as
in ``simhash``; a pair within ``RADIUS`` bits is then confirmed on the exact sets.

1. Equal sets are reduced to one first, so a group of copies costs one row from here on.
2. Blocking loses nothing: two sets of 4/5 share at least 4/5 of each, so that in any fixed order of all shingles the
   first n - ceil(4 n / 5) + 1 of both share one. Frequent shingles come last in the order, so that these prefixes
   seldom share boilerplate. Frequencies are counted over all texts, within blocks, and the ``COMMON`` highest kept;
   any order gives the same links.
3. Texts that share a prefix shingle are compared bit-sliced; a spanning forest of the near ones is kept.
4. Inside the forest's trees, sets of fitting sizes are compared exactly unless they are connected already.

``RADIUS`` = 88 of 256 bits: at a similarity of exactly 4/5 a bit differs with a probability of 0.15 (0.19 for sets of
five), so the expected distance is 39 (48) with a deviation of 6; that of unlike texts is 128 with a deviation of 8. A true
link falls outside with a probability below 1e-9, less for likelier copies.

No key, tree or block is bound to a task: heavy keys and trees are dealt to blocks and compared by pairs of blocks
(``paired_blocks``), so a task holds two blocks. Nothing is sampled or capped.

Nulls and edge cases: rows are nodes, by a number that is written first, so that repeated ids and null ids take part;
a group keeps the row with the smallest id (null last), then the smallest number. A null text counts as empty; texts
without words are copies of each other. A text of five words or fewer is one shingle. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..sources.tables import written
from .common import paired_blocks, pieces, release, text_of, tidied
from .simhash import SEED, compare_groups, majority, words_of

SHINGLE = 5
LIKE = (4, 5)
RADIUS = 88
#: Odd multipliers that give four words of a fingerprint from one 64-bit hash.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
WIDTH = 64 * len(MULTIPLIERS)
COMMON = 1 << 16
COUNTED = 1 << 20
#: Shingles in a block of texts that are compared exactly.
CHECKED = 1 << 21
CACHE = 1 << 18


class _Words(dict):
    """Word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxh64_intdigest(word, SEED)
        return h


_WORDS = _Words()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str, words: int = SHINGLE) -> np.ndarray:
    """The different shingles of a text as 64-bit hashes, ascending."""
    parts = words_of(text)
    if not parts:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    k = min(words, len(own))
    h = np.full(len(own) - k + 1, k, np.uint64)
    for at in range(k):
        h = h * MULTIPLIERS[0] + own[at : at + len(h)]
    return np.unique(_mixed(h))


def wide_fingerprint(shingles: np.ndarray) -> bytes:
    wide = _mixed(shingles[:, None] * MULTIPLIERS + MULTIPLIERS[::-1])
    return majority(wide.astype("<u8", copy=False).view(np.uint8).reshape(len(shingles), WIDTH // 8)).tobytes()


def prefix_length(n: int) -> int:
    """How many first shingles of a set of n must be known to meet every set that is like it."""
    return n - -(-n * LIKE[0] // LIKE[1]) + 1 if n else 0


def like(shared: int, a: int, b: int) -> bool:
    return LIKE[1] * shared >= LIKE[0] * (a + b - shared)


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """texts(text) -> the most frequent shingles, ascending, and the place of each in the order (rarest first)."""

    def count(batches):
        def out(held):
            h, c = np.unique(np.concatenate(held), return_counts=True)
            more = c > 1
            return pa.RecordBatch.from_arrays([pa.array(h[more].view(np.int64)), pa.array(c[more])], names=["h", "c"])

        held, rows = [], 0
        for batch in batches:
            for x in batch.column(0):
                held.append(shingle_set(x.as_py()))
                rows += len(held[-1])
                if rows >= COUNTED:
                    yield out(held)
                    held, rows = [], 0
        if held:
            yield out(held)
        _WORDS.clear()

    total = texts.mapInArrow(tidied(count), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    top = total.orderBy(F.desc("c"), "h").limit(COMMON).toArrow()  # at most COMMON rows
    h = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], (len(h) - order).astype(np.int64)


def marked(rows: DataFrame, text_col: str) -> DataFrame:
    """(row, digest, n, keys, fp) of every row: its set's digest, size, prefix and fingerprint."""
    known = rows.sparkSession.sparkContext.broadcast(common_shingles(rows.select(text_of(text_col).alias("text"))))

    def compute(batches):
        from xxhash import xxh3_128_digest

        common, places = known.value
        for batch in batches:
            digests, sizes, keys, prints = [], [], [], []
            for x in batch.column(1):
                s = shingle_set(x.as_py())
                at = np.minimum(np.searchsorted(common, s), max(len(common) - 1, 0))
                place = np.where(common[at] == s, places[at], 0) if len(common) else np.zeros(len(s), np.int64)
                digests.append(xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                keys.append(s[np.argsort(place, kind="stable")[: prefix_length(len(s))]].view(np.int64))
                prints.append(wide_fingerprint(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(prints, pa.binary())],
                names=["row", "digest", "n", "keys", "fp"],
            )
        _WORDS.clear()

    return rows.select("__row", text_of(text_col).alias("text")).mapInArrow(tidied(compute), "row long, digest binary, n long, keys array<long>, fp binary")


def candidates(reps: DataFrame) -> DataFrame:
    """reps(row, n, keys, fp) -> (node, component) of rows that near fingerprints with a shared prefix shingle connect."""
    by = Window.partitionBy("key").orderBy("n", "row")
    # neighbours by size: where none is of a fitting size, nothing else is
    before = LIKE[1] * F.lag("n").over(by) >= LIKE[0] * F.col("n")
    after = LIKE[1] * F.col("n") >= LIKE[0] * F.lead("n").over(by)
    entries = reps.select("row", "n", F.explode("keys").alias("key"))
    shared = written(entries.withColumn("before", before).withColumn("after", after).where("before OR after").select("key", "row"), "shared")
    release(shared.sparkSession)
    members = shared.join(reps.select("row", "fp"), "row").withColumn("one", F.lit(1))
    keyed = paired_blocks(members, "key", "one", "row").withColumn("side", F.when(F.col("i") == F.col("j"), -1).otherwise(F.col("side")))
    found = (
        keyed.select("key", "i", "j", "side", F.col("row").alias("node"), "fp")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side", "node")
        .mapInArrow(tidied(compare_groups(3, RADIUS)), "a long, b long")
    )
    return connected_components(found)


def links_of(sets: list[np.ndarray], sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is alike, at most one for each set; with sides (0 and 1) only across."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sizes = np.array([len(sets[k]) for k in order], np.int64)
    side = np.array([sides[k] for k in order]) if sides is not None else None
    which = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    own = [which[z - n : z] for n, z in zip(sizes, ends)]
    label = np.arange(len(sets))
    mark = np.zeros(len(which) and int(which.max()) + 1, bool)
    out = []
    for i in range(len(sets) - 1):
        last = np.searchsorted(sizes, sizes[i] * LIKE[1] // LIKE[0], "right")
        todo = i + 1 + np.flatnonzero(label[i + 1 : last] != label[i])
        if side is not None:
            todo = todo[side[todo] != side[i]]
        if not len(todo):
            continue
        mark[own[i]] = True
        for j in todo.tolist():
            if label[j] != label[i] and like(int(np.count_nonzero(mark[own[j]])), len(own[i]), len(own[j])):
                out.append((order[i], order[j]))
                label[label == label[j]] = label[i]
        mark[own[i]] = False
    return out


def _check(batches):
    """Rows (component, i, j, side, row, text) sorted by the first three -> links (a, b) of rows, exact."""
    for (_, i, j), part in pieces(batches, 3, 1 << 62):
        ids = part.column("row").to_pylist()
        sides = part.column("side").to_pylist() if i < j else None
        found = links_of([shingle_set(x.as_py()) for x in part.column("text")], sides)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([ids[x[k]] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
    _WORDS.clear()


def components(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """rows with a unique long ``__row`` -> (row, component), a row of every row; component is the smallest row reachable."""
    found = written(marked(rows, text_col), "prefixes")
    reps = written(found.groupBy("digest").agg(F.min("row").alias("rep")), "sets")
    firsts = found.join(reps.select(F.col("rep").alias("row")), "row", "left_semi")
    trees = candidates(firsts)
    release(rows.sparkSession)
    members = trees.join(found.select("row", "n"), F.col("node") == F.col("row")).select("component", "row", "n")
    blocks = paired_blocks(members, "component", "n", "row", CHECKED)
    links = (
        rows.select("__row", text_of(text_col).alias("text"))
        .join(blocks, F.col("__row") == F.col("row"))
        .select("component", "i", "j", "side", "row", "text")
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j", "row")
        .mapInArrow(tidied(_check), "a long, b long")
    )
    alike = connected_components(links)
    final = reps.join(alike, reps.rep == alike.node, "left").select("digest", F.coalesce("component", "rep").alias("component"))
    return found.select("row", "digest").join(final, "digest").select("row", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group stays. Columns are the input's."""
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    named = components(rows, text_col).join(rows.select("__row", F.col(id_col).alias("id")), F.col("row") == F.col("__row"))
    choice = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    chosen = written(named.groupBy("component").agg(F.min(choice).alias("x")).select(F.col("x.row").alias("__kept")), "kept")
    # always by shuffle: whether the numbers are few enough to be sent whole depends on the corpus
    return rows.join(chosen.hint("shuffle_hash"), rows["__row"] == chosen["__kept"], "left_semi").select(*docs.columns)

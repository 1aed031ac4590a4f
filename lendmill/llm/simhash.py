"""SimHash near-dedup by covering anchors.

A text's fingerprint has a bit set where more than half of its shingles' XXH64
hashes have it. Two fingerprints link if they differ in at most ``distance`` bits;
linked groups are connected components.

Anchors are the words of a covering code of 64 bits: nine blocks of the perfect
Hamming code of length seven and one free bit, 2**37 anchors with covering radius
nine. If two fingerprints differ in at most d bits, some 64-bit word lies within
ceil(d / 2) of both; the anchor nearest to that word is then within covering
radius plus d of both. So each distinct fingerprint is replicated to the anchors
nearest to the words within ceil(d / 2) of it (26 on average for d = 2), and
fingerprints are compared with those at the same anchor only. This loses no link
and leaves out anchors in reach that no partner could share.

An anchor's comparison gives a spanning forest of its links, never all pairs.
Equal fingerprints are one row from the start, whatever number of texts has them.

Defined results: null text or one without words has fingerprint zero, linked like
any other. Fewer words than a shingle: the whole sequence is the one shingle. Null
keys: rows keep their fingerprint; the smallest key reachable ignores nulls and is
null if there is no other. Repeated rows stay. Empty table: empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.llm import columns as C
from lendmill.llm import wordspans as W
from lendmill.llm.components import components
from lendmill.llm.shipping import by_value

by_value(__name__)

SHINGLE = 3
DISTANCE = 2
SEED = 42

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Shingles summed at once, so that a count fits in 16 bits.
_LANE = 65_535

#: Fingerprints at one anchor up to which every two are compared.
_FEW = 128


# ---- fingerprints -------------------------------------------------------------


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run first[i]:first[i+1] of hashes, how many have each bit set."""
    runs = len(first) - 1
    counts = np.zeros((runs, 64), np.int64)
    if not len(hashes):
        return counts
    starts, owner = [], []
    for i in np.flatnonzero(np.diff(first)):
        cut = range(int(first[i]), int(first[i + 1]), _LANE)
        starts.extend(cut)
        owner.extend([i] * len(cut))
    owner = np.array(owner)
    lanes = np.uint64(0x0001000100010001)
    for k in range(16):
        packed = np.add.reduceat((hashes >> np.uint64(k)) & lanes, starts)
        for lane in range(4):
            part = ((packed >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64)
            np.add.at(counts[:, 16 * lane + k], owner, part)
    return counts


def _fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    w = W.spans(_LOWER[data], offsets)
    text, _, starts, ends = W.joined(w)
    raw, first, counts = text.tobytes(), w.first, w.counts
    # one shingle a word that has shingle - 1 successors, or one for a short text
    n = np.where(counts >= shingle, counts - shingle + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(n)])
    begin = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], n)
    last = np.minimum(begin + shingle, np.repeat(first[1:], n)) - 1
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array(
        [digest(raw[i:j], seed) for i, j in zip(starts[begin].tolist(), ends[last].tolist(), strict=True)],
        dtype=np.uint64,
    )
    bits = (2 * _bit_counts(hashes, at) > n[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _fingerprint_batches(
    batches: Iterator[pa.RecordBatch], text: str, shingle: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.flat(batch.column(text))
        found = [
            _fingerprints(data[offsets[i] : offsets[j]], offsets[i : j + 1], shingle)
            for i, j in W.slices(offsets)
        ]
        found = np.concatenate(found) if found else np.zeros(0, np.uint64)
        rest = [i for i, name in enumerate(batch.schema.names) if name != text]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in rest), pa.array(found.view(np.int64))],
            names=[*(batch.schema.names[i] for i in rest), "fingerprint"],
        )


def fingerprints(keys: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """The frame with its text column replaced by ``fingerprint``, 64 bits as a long."""
    schema = T.StructType([f for f in keys.schema if f.name != text]).add("fingerprint", "long")
    return keys.mapInArrow(lambda b: _fingerprint_batches(b, text, shingle), schema)


# ---- anchors ------------------------------------------------------------------


def _nearest_words() -> np.ndarray:
    """For each value of seven bits the only Hamming codeword within one bit."""
    parity = lambda v: np.bitwise_xor.reduce([i + 1 for i in range(7) if v >> i & 1] or [0])
    return np.array([v ^ (1 << s - 1) if (s := int(parity(v))) else v for v in range(128)], np.uint64)


_NEAREST = _nearest_words()


def nearest_anchors(x: np.ndarray) -> np.ndarray:
    """The anchor nearest to each 64-bit word: every block's codeword, and the last bit."""
    out = x & np.uint64(1 << 63)
    for block in range(9):
        shift = np.uint64(7 * block)
        out |= _NEAREST[((x >> shift) & np.uint64(127)).astype(np.int64)] << shift
    return out


def _flips(most: int) -> np.ndarray:
    """Every 64-bit mask of at most ``most`` set bits."""
    return np.array(
        [sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(64), n)], np.uint64
    )


def _replicate(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    masks = _flips((distance + 1) // 2)
    step = max(1, 2_000_000 // len(masks))
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(every), step):
            own = every[i : i + step]
            anchors = np.sort(nearest_anchors(own[:, None] ^ masks[None, :]), axis=1)
            new = np.ones(anchors.shape, bool)
            new[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors[new].view(np.int64)),
                    pa.array(np.repeat(own, new.sum(axis=1)).view(np.int64)),
                ],
                names=["anchor", "fingerprint"],
            )


# ---- comparison per anchor ----------------------------------------------------


def _pairs(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of values that differ in at most ``distance`` bits: all such pairs of a few
    values; of many, enough pairs to join the same groups."""
    n = len(values)
    if n <= _FEW or distance % 2:
        found = [(np.zeros(0, np.int64),) * 2]
        for i in range(0, n, 1024):
            near = np.bitwise_count(values[i : i + 1024, None] ^ values[None, :]) <= distance
            a, b = np.nonzero(near)
            found.append((a + i, b))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return a[a < b], b[a < b]
    # two values share a word within half the distance exactly if they are near enough
    masks = _flips(distance // 2)
    words = (values[:, None] ^ masks[None, :]).ravel()
    owner = np.repeat(np.arange(n), len(masks))
    order = np.argsort(words, kind="stable")
    words, owner = words[order], owner[order]
    same = words[1:] == words[:-1]
    return owner[:-1][same], owner[1:][same]


def _forest(anchors: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links value -> smallest-placed value of its group, for whole anchors in sorted order."""
    edges = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1], [True]]))
    sizes = np.diff(edges)
    left, right = [], []
    for size in np.unique(sizes):
        if size == 1:
            continue
        begin = edges[:-1][sizes == size]
        if size <= 16:  # many small anchors at once
            for i, j in combinations(range(int(size)), 2):
                near = np.bitwise_count(values[begin + i] ^ values[begin + j]) <= distance
                left.append(begin[near] + i)
                right.append(begin[near] + j)
            continue
        for b in begin:
            a, c = _pairs(values[b : b + size], distance)
            left.append(a + b)
            right.append(c + b)
    if not left:
        return (np.zeros(0, np.uint64),) * 2
    left, right = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    hung = np.flatnonzero(label != np.arange(len(values)))
    return values[hung], values[label[hung]]


def _compare(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each anchor; rows come sorted by anchor."""
    rest = [np.zeros(0, np.uint64)] * 2

    def links(anchors, values):
        a, b = _forest(anchors, values, distance)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)]
        anchors, values = (np.concatenate(x) for x in zip(rest, new, strict=True))
        if not len(anchors):
            continue
        others = np.flatnonzero(anchors != anchors[-1])  # the last anchor may go on in the next batch
        whole = int(others[-1]) + 1 if len(others) else 0
        rest = [anchors[whole:], values[whole:]]
        if whole:
            yield links(anchors[:whole], values[:whole])
    if len(rest[0]):
        yield links(*rest)


def link_fingerprints(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` that join all fingerprints within ``distance``; ``distinct`` has one
    column of different fingerprints."""
    placed = distinct.mapInArrow(lambda b: _replicate(b, distance), "anchor long, fingerprint long")
    return (
        placed.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda b: _compare(b, distance), "a long, b long")
    )


def simhash_components(
    keys: DataFrame, key: str, text: str, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``key``, ``fingerprint`` (long) and ``component_id``, the smallest key reachable."""
    inner = keys.select(F.col(key).alias("key"), F.col(text).alias("text"))
    prints = C.written(fingerprints(inner, "text", shingle), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("key").alias("low"))
    roots = components(link_fingerprints(distinct.select("fingerprint"), distance), "a", "b")
    lows = (
        distinct.join(roots, distinct.fingerprint == roots.node, "left")
        .select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root"))
        .checkpoint()
    )
    smallest = lows.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = lows.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select(
        F.col("key").alias(key), "fingerprint", "component_id"
    )


def hex_fingerprint(fingerprint: str = "fingerprint"):
    """Sixteen lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def keep_one(
    docs: DataFrame, key: str, text: str, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each linked group the row with the
    smallest key stays (null last; ties by a hash of the row), of equal rows one."""
    names, inner = docs.columns, C.hidden(docs)
    k, t = C.position(docs, key), C.position(docs, text)
    known = [F.col(c) for c, kind in inner.dtypes if not any(x in kind for x in ("map<", "variant"))]
    inner = inner.withColumn("row", F.xxhash64(*known)).withColumn(
        "more", F.xxhash64(F.lit("more"), *known)
    )
    prints = C.written(
        fingerprints(
            inner.select(
                F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("key"), "row", "more").alias("it"),
                F.col(t).alias("text"),
            ),
            "text",
            shingle,
        ),
        "fingerprints",
    )
    distinct = prints.groupBy("fingerprint").agg(F.min("it").alias("low"))
    roots = components(link_fingerprints(distinct.select("fingerprint"), distance), "a", "b")
    first = (
        distinct.join(roots, distinct.fingerprint == roots.node, "left")
        .groupBy(F.coalesce("root", "fingerprint").alias("root"))
        .agg(F.min("low").alias("low"))
        .select(F.col("low.row").alias("s_row"), F.col("low.more").alias("s_more"))
    )
    stay = inner.join(
        first, (F.col("row") == F.col("s_row")) & (F.col("more") == F.col("s_more")), "left_semi"
    )
    return C.shown(stay.dropDuplicates(["row", "more"]), names, {})

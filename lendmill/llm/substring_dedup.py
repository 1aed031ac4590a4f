"""Substring dedup: words inside passages that also stand elsewhere are removed.

Every run of ``window`` consecutive words of one text is a window. Rabin-Karp
sums give its hash; a window whose hash also belongs to another window, in the
same text or any other, is repeated. Repeated windows of a text merge into
maximal intervals of words, which are removed, first occurrence included.
Windows are judged on the input, not on what is left.

How it runs
    Texts are dealt into blocks by a hash of key and text. A block sends each
    part, a slice of the hashes, the sorted distinct hashes it holds of it: eight bytes a
    window, packed, so that a passage found in a third of all texts is one
    number per block. A part answers each block with one bit per number: also
    sent by another block. Repeats inside a block the block knows itself. Blocks
    then read their texts again from the same shuffle and cut.

    The part comes from a second, independent Rabin-Karp sum, so a window is
    known by 64 bits and those of the part number. Parts grow with the input, so
    two different windows hardly ever meet: 10**13 windows in 10**6 parts make
    three such pairs on average, 10**10 in 10**4 parts none.

Defined results
    Null text: no words, kept text empty. Fewer words than the window: nothing
    removed. Repeated rows are repeated passages, so long ones lose their words.
    Null or repeated keys are allowed: rows are judged one by one. Input columns
    are kept; one that has a result's name is replaced. Empty table: empty.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.llm import columns as C
from lendmill.llm import wordspans as W
from lendmill.llm.shipping import by_value

by_value(__name__)

WINDOW = 35

#: Text bytes of a block and windows of a part: memory of one task. Larger
#: inputs than about a hundred gigabytes want larger ones of both.
BLOCK_BYTES = 8 << 20
PART_WINDOWS = 1 << 20

_FIRST, _SECOND = W.Rolling(0xA24BAED4963EE407), W.Rolling(0x9FB21C651E98DF25)


def _window_hashes(w: W.Words, values: np.ndarray, window: int, parts: int) -> tuple[np.ndarray, ...]:
    """First word, 64-bit hash and part of each window."""
    last = np.repeat(w.first[1:], w.counts)
    starts = np.flatnonzero(np.arange(len(values)) + window <= last)
    hashes = W.mixed(_FIRST.runs(values, starts, starts + window))
    other = W.mixed(_SECOND.runs(W.mixed(values + np.uint64(1)), starts, starts + window))
    return starts, hashes, (other % np.uint64(parts)).astype(np.int32)


class _Block:
    """One block's texts in a fixed order, and its windows."""

    def __init__(self, block: pa.Table, text: str, window: int, parts: int):
        self.rows = block.sort_by([("key_hash", "ascending"), ("key_more", "ascending")])
        self.texts = self.rows.column(text)
        data, offsets = W.flat(self.texts)
        self.slices, firsts, hashes, part = [], [], [], []
        for i, j in W.slices(offsets):
            w = W.spans(data[offsets[i] : offsets[j]], offsets[i : j + 1])
            starts, h, p = _window_hashes(w, W.word_hashes(w), window, parts)
            self.slices.append(w)
            firsts.append(starts)
            hashes.append(h)
            part.append(p)
        self.starts = firsts
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        p = np.concatenate(part) if part else np.zeros(0, np.int32)
        order = np.argsort(h, kind="stable")
        order = order[np.argsort(p[order], kind="stable")]
        h, p = h[order], p[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
        #: Distinct windows by part and hash; which of them each window is.
        self.distinct, self.part = h[new], p[new]
        self.which = np.empty(len(h), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.times = np.bincount(self.which, minlength=len(self.distinct))


def _sent(block: pa.Table, text: str, window: int, parts: int) -> pa.Table:
    """The distinct hashes of a block, packed per part."""
    b = _Block(block.select(["key_hash", "key_more", text]), text, window, parts)
    ids, begin = np.unique(b.part, return_index=True)
    edges = np.append(begin, len(b.part)).astype(np.int32) * 8
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(ids),
        [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(b.distinct)],
    ).cast(pa.binary())
    number = block.column("block")[0].as_py()
    return pa.table(
        {"block": pa.array([number] * len(ids), pa.int64()), "part": pa.array(ids, pa.int32()), "packed": packed}
    )


def _answered(sent: pa.Table) -> pa.Table:
    """For each block of a part, a bit per hash: another block has sent it too."""
    numbers = [np.frombuffer(x.as_buffer(), np.uint64) for x in sent.column("packed")]
    every = np.sort(np.concatenate(numbers))
    twice = every[1:][every[1:] == every[:-1]]
    bits = []
    for own in numbers:
        at = np.searchsorted(twice, own)
        found = np.zeros(len(own), bool)
        inside = at < len(twice)
        found[inside] = twice[at[inside]] == own[inside]
        bits.append(np.packbits(found).tobytes() if found.any() else None)
    return pa.table(
        {"block": sent.column("block"), "part": sent.column("part"), "bits": pa.array(bits, pa.binary())}
    ).filter(pa.array([b is not None for b in bits], pa.bool_()))


def _cut(
    block: pa.Table, answers: pa.Table, text: str, window: int, parts: int, join_clean: bool
) -> pa.Table:
    """The block's rows without the words of repeated windows."""
    b = _Block(block, text, window, parts)
    again = b.times > 1
    for part, bits in zip(answers.column("part").to_pylist(), answers.column("bits").to_pylist(), strict=True):
        i, j = np.searchsorted(b.part, [part, part + 1])
        again[i:j] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
    repeated = again[b.which]
    texts, at, seen, n_all, n_gone, cuts = [], [0], 0, [], [], []
    for w, starts in zip(b.slices, b.starts, strict=True):
        hit = starts[repeated[seen : seen + len(starts)]]
        seen += len(starts)
        step = np.zeros(len(w.starts) + 1, np.int32)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + window, -1)
        gone = np.cumsum(step[:-1]) > 0
        data, offsets, _, _ = W.joined(w, ~gone)
        texts.append(data)
        at.extend((offsets[1:] + at[-1] - offsets[0]).tolist())
        total = np.concatenate([[0], np.cumsum(gone)])
        n_all.append(w.counts)
        n_gone.append(total[w.first[1:]] - total[w.first[:-1]])
        cuts.extend(_intervals(gone, w.first))
    joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    kept = W.as_strings(joined(texts).astype(np.uint8), np.array(at, np.int64)).cast(pa.string())
    removed = pa.array(joined(n_gone), pa.int64())
    if not join_clean:
        kept = pc.if_else(pc.equal(removed, 0), b.texts.combine_chunks().cast(pa.string()), kept)
    result = b.rows.drop_columns([text, "block", "key_hash", "key_more"])
    for name, column in (
        ("out_text", kept),
        ("out_words", pa.array(joined(n_all), pa.int64())),
        ("out_removed", removed),
        ("out_intervals", pa.array(cuts, pa.list_(pa.list_(pa.int32())))),
    ):
        result = result.append_column(name, column)
    return result


def _intervals(gone: np.ndarray, first: np.ndarray) -> Iterator[list[list[int]]]:
    """Removed words of each text as [from, to) pairs, counted within the text."""
    for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = gone[i:j]
        if not own.any():
            yield []
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
        yield edge.reshape(-1, 2).tolist()


def substring_dedup(
    docs: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    join_clean: bool = True,
    block_bytes: int = BLOCK_BYTES,
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """Input columns with ``text`` cut down to the kept words, joined by one space, then
    ``n_words``, ``n_removed`` and ``removed`` (intervals of words as [from, to) pairs).

    ``join_clean=False`` leaves a text that loses nothing as it was.
    """
    names = docs.columns
    inner = C.hidden(docs)
    column = C.position(docs, text)
    total = inner.agg(F.sum(F.octet_length(column)).alias("n_bytes")).first()
    n_bytes = total["n_bytes"] or 0
    blocks = max(1, math.ceil(n_bytes / block_bytes))
    parts = max(1, math.ceil(n_bytes / 6 / part_windows))
    known = [F.col(c) for c, kind in inner.dtypes if not re.search("map<|variant", kind)]
    dealt = (
        inner.withColumn("key_hash", F.xxhash64(*known))
        .withColumn("key_more", F.xxhash64(F.lit("more"), *known))
        .withColumn("block", F.pmod("key_hash", F.lit(blocks)))
        .repartition(blocks, "block")
    )
    sent = dealt.groupBy("block").applyInArrow(
        lambda t: _sent(t, column, window, parts), "block long, part int, packed binary"
    )
    answers = sent.groupBy("part").applyInArrow(_answered, "block long, part int, bits binary")
    schema = T.StructType([f for f in inner.schema if f.name != column])
    for name, kind in (
        ("out_text", T.StringType()),
        ("out_words", T.LongType()),
        ("out_removed", T.LongType()),
        ("out_intervals", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ):
        schema = schema.add(name, kind)
    cut = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(lambda t, a: _cut(t, a, column, window, parts, join_clean), schema)
    )
    results = {"n_words": "out_words", "n_removed": "out_removed", "removed": "out_intervals"}
    back = cut.withColumnRenamed("out_text", column).select(
        *inner.columns, *results.values()
    )
    return C.shown(back, names, results)

"""Conflict-constrained best-fit packing of documents into bins of fixed length.

A bin holds at most ``capacity`` words, at most one document of a duplicate cluster
and, unless told otherwise, at most one of a source. Each open bin carries a bitmap
of its sources and clusters. Bins are ordered by what is left in them; a document
takes the tightest bin that holds it, and when that one conflicts the search goes on
to the next in order until a bin is compatible. A tree over the order keeps, per
range of residuals, the bits that all its bins have in common, so ranges without a
compatible bin are passed over whole. Only then a new bin is opened. Documents come
longest first; ties by a hash of the row.

A document longer than a bin is cut into pieces: whole bins, and a rest that is
packed like a document.

How it runs: only keys, sizes and cluster numbers are shuffled, never texts. Rows are
dealt by a hash into groups of about ``GROUP_ROWS``, each packed in one task of
bounded memory; a group leaves its last bins open, a share that shrinks with
the group. A source or cluster with a third of all rows is spread evenly over the
groups, since rows are dealt by row, not by source or cluster.

Defined results: null or empty text has no words and is in no bin (bin, place and
offset null). Null source: a source of its own. Without a cluster column, equal
texts are a cluster; a null cluster conflicts with none. Equal rows are packed each,
never into one bin. Empty table: empty.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.llm import columns as C
from lendmill.llm.shipping import by_value

by_value(__name__)

#: Words of a bin, about two thousand tokens of a byte-level vocabulary.
CAPACITY = 1024

#: Rows packed in one task.
GROUP_ROWS = 4096

#: Result columns of a piece inside its group.
PIECE = ("piece", "from_word", "n_words", "bin", "place", "offset")

_NONE = -1  # all bits: what the bins of an empty range have in common


class Bins:
    """Open bins by residual, each with the bitmap of what it holds."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.common = [_NONE] * (2 * self.leaves)
        self.at: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]

    def _refresh(self, residual: int) -> None:
        node, bits = self.leaves + residual, _NONE
        for bitmap in self.at[residual]:
            bits &= bitmap
        while self.common[node] != bits:
            self.common[node] = bits
            if node == 1:
                break
            bits &= self.common[node ^ 1]
            node //= 2

    def add(self, residual: int, bitmap: int, number: int) -> None:
        self.at[residual].setdefault(bitmap, []).append(number)
        self._refresh(residual)

    def take(self, size: int, bits: int) -> tuple[int, int, int] | None:
        """The tightest bin with ``size`` left and none of ``bits``: residual, bitmap, number."""
        stack = [(1, 0, self.leaves)]
        while stack:
            node, low, width = stack.pop()
            if low + width <= size or self.common[node] & bits or self.common[node] == _NONE:
                continue
            if width > 1:
                half = width // 2
                stack.append((2 * node + 1, low + half, half))
                stack.append((2 * node, low, half))
                continue
            for bitmap, numbers in self.at[low].items():
                if not bitmap & bits:
                    number = numbers.pop()
                    if not numbers:
                        del self.at[low][bitmap]
                        self._refresh(low)
                    return low, bitmap, number
        return None


def _bit_numbers(values: list, shared_only: bool) -> dict:
    """A bit for each value; only for values that occur twice where ``shared_only``."""
    counts = Counter(v for v in values if v is not None)
    return {v: i for i, v in enumerate(v for v, n in counts.items() if n > 1 or not shared_only)}


def best_fit(
    sizes: list[int], sources: list, clusters: list, capacity: int, distinct_sources: bool
) -> list[tuple]:
    """(document, piece, from_word, words, bin, place, offset) of every piece.

    Documents are numbered by their place in the lists, which also breaks ties.
    """
    source_bits = _bit_numbers(sources, False) if distinct_sources else {}
    cluster_bits = _bit_numbers(clusters, True)
    shift = len(source_bits)
    bins, used, pieces, rests = Bins(capacity), 0, [], []
    for k, (size, source, cluster) in enumerate(zip(sizes, sources, clusters, strict=True)):
        bits = 1 << source_bits[source] if source in source_bits else 0
        if cluster in cluster_bits:
            bits |= 1 << shift + cluster_bits[cluster]
        whole = size // capacity
        for piece in range(whole):
            pieces.append((k, piece, piece * capacity, capacity, used, 0, 0))
            used += 1
        if size % capacity:
            rests.append((size % capacity, k, whole, bits))
        elif not size:
            pieces.append((k, 0, 0, 0, None, None, None))
    held: dict[int, tuple[int, int]] = {}  # bin -> documents in it, words in it
    for size, k, piece, bits in sorted(rests, key=lambda x: (-x[0], x[1])):
        found = bins.take(size, bits)
        if found is None:
            found, used = (capacity, 0, used), used + 1
        residual, bitmap, number = found
        place, offset = held.get(number, (0, 0))
        pieces.append((k, piece, piece * capacity, size, number, place, offset))
        held[number] = (place + 1, offset + size)
        if residual > size:
            bins.add(residual - size, bitmap | bits, number)
    return pieces


def _pack_group(rows: pa.Table, kept: list[str], capacity: int, distinct_sources: bool) -> pa.Table:
    rows = rows.sort_by([("row", "ascending"), ("more", "ascending")])
    lists = [rows.column(c).to_pylist() for c in ("size", "source", "cluster")]
    pieces = best_fit(*lists, capacity, distinct_sources)
    number, *columns = zip(*pieces, strict=True)
    out = rows.select([*kept, "group"]).take(pa.array(number, pa.int64()))
    for name, values in zip(PIECE, columns, strict=True):
        out = out.append_column(name, pa.array(values, pa.int64()))
    return out


def pack(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    cluster: str | None = None,
    capacity: int = CAPACITY,
    distinct_sources: bool = True,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """A row per piece: input columns without ``text``, then ``piece``, ``from_word``, ``n_words``,
    ``bin_id``, ``place`` (in the bin, from 0) and ``bin_offset`` (words before it in the bin)."""
    names = [n for n in docs.columns if n != text]
    inner = C.hidden(docs)
    t, s = C.position(docs, text), C.position(docs, source)
    known = [F.col(c) for c, kind in inner.dtypes if not any(k in kind for k in ("map<", "variant"))]
    copies = F.xxhash64(F.coalesce(t, F.lit(""))) if cluster is None else F.xxhash64(C.position(docs, cluster))
    if cluster is not None:
        copies = F.when(F.col(C.position(docs, cluster)).isNotNull(), copies)
    sized = inner.select(
        *[c for c in inner.columns if c != t],
        F.coalesce(F.col(s).cast("string"), F.lit("\0")).alias("source"),  # null is one too
        copies.alias("cluster"),
        C.n_words(t).alias("size"),
        F.xxhash64(*known).alias("row"),
        F.xxhash64(F.lit("more"), *known).alias("more"),
    )
    sized = C.written(sized, "pack-sizes")
    groups = max(1, math.ceil(sized.count() / group_rows))
    kept = [c for c in inner.columns if c != t]
    dealt = sized.withColumn("group", F.pmod("row", F.lit(groups)).cast("long"))
    schema = T.StructType([dealt.schema[c] for c in (*kept, "group")])
    for name in PIECE:
        schema = schema.add(name, "long")
    packed = dealt.groupBy("group").applyInArrow(
        lambda rows: _pack_group(rows, kept, capacity, distinct_sources), schema
    )
    order = {c: f"in_{i}" for i, c in enumerate(kept)}
    packed = packed.select(
        *[F.col(c).alias(n) for c, n in order.items()],
        "piece",
        "from_word",
        "n_words",
        (F.col("group") * F.lit(1 << 32) + F.col("bin")).alias("bin_id"),
        "place",
        F.col("offset").alias("bin_offset"),
    )
    return C.shown(
        packed, names, {c: c for c in ("piece", "from_word", "n_words", "bin_id", "place", "bin_offset")}
    )

"""Token counts per section, attributed by offsets.

A document is encoded whole, once. A byte-level vocabulary's tokens spell the text's
bytes, so running sums of token lengths give each token's span of characters. Spans and
sections, intervals of characters of the same document, are joined as intervals, and
a token that crosses a section's border is allocated by an explicit rule:

``start``  the section that holds the token's first character
``most``   the section that holds most of its characters; ties to the earlier section
``split``  every section, by its share of the token's characters

Counting a section's text by itself would differ, as tokens do not end at its borders.
Sections may leave gaps, and may overlap, in which case each counts its own.

How it runs: one pass without a shuffle; memory is a batch of texts and one text's
tokens. Sections of a table of their own are first gathered per document.

Defined results: null text is empty. Without a column of sections, every line is one,
with its line break, and an empty text is one empty section. A document without
sections (null or empty list) gives no rows. A null bound is the text's start or end;
bounds beyond the text are cut, and a reversed section is empty. Repeated rows are
counted each. Texts may be of any length and hold runs of any length, blanks and
line breaks too. Empty table: empty.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.llm import columns as C
from lendmill.llm.shipping import by_value

by_value(__name__)

#: Where the rank file lies on every machine, and the pattern that goes with it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: What the pattern takes for white space.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Blanks in a row from which they are encoded apart from the text around them.
LONG_GAP = 10_000

RULES = ("start", "most", "split")


class Encoder:
    """A byte-level vocabulary with the byte length of each token.

    The pattern looks ahead behind a gap, which takes a stack as deep as the gap is long and
    fails on some hundred thousand blanks. Where it cuts a gap is known: all but the last
    blank are one piece, and the last goes with what follows; a gap that ends the text is
    one piece. So a long gap is handed to the merges as that piece, and tokens stay the
    same. A ``pattern`` of one's own is applied as it is.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            self.lengths[number] = len(token)
        self._encoding = tiktoken.Encoding(
            "given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._gaps = re.compile(f"[{BLANK}]{{{LONG_GAP},}}") if pattern == PATTERN else None

    def tokens(self, text: str) -> np.ndarray:
        """The numbers of all tokens, in order."""
        parts, done = [], 0
        for gap in self._gaps.finditer(text) if self._gaps else ():
            end = gap.end() if gap.end() == len(text) else gap.end() - 1
            parts.append(self._encoding.encode_ordinary(text[done : gap.start()]))
            parts.append(self._encoding._encode_single_piece(text[gap.start() : end]))
            done = end
        parts.append(self._encoding.encode_ordinary(text[done:]))
        return np.concatenate([np.array(p, np.int64) for p in parts])

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of each token, in order."""
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        ids = self.tokens(text)
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        if len(raw) == len(text):  # ASCII
            return starts, ends
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        return character[starts], character[ends - 1] + 1


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Every line with its line break."""
    at = [i + 1 for i, c in enumerate(text) if c == "\n"] if "\n" in text else []
    if not at or at[-1] < len(text):
        at.append(len(text))
    return np.array([0, *at[:-1]], np.int64), np.array(at, np.int64)


def attribute(
    starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section [low, high) by the rule, and tokens that cross its borders."""
    # tokens wholly inside: starts and ends never decrease
    first, last = np.searchsorted(starts, low, "left"), np.searchsorted(ends, high, "right")
    count = np.maximum(last - first, 0).astype(np.float64)
    # the token that spans a border, if one does: its start lies before, its end behind
    pairs = []
    for border in (low, high):
        token = np.searchsorted(starts, border, "left") - 1
        crosses = (token >= 0) & (low < high)
        crosses[crosses] = ends[token[crosses]] > border[crosses]
        section = np.flatnonzero(crosses)
        pairs.append(np.stack([token[section], section]))
    token, section = np.unique(np.concatenate(pairs, axis=1), axis=1)
    overlap = np.minimum(ends[token], high[section]) - np.maximum(starts[token], low[section])
    token, section, overlap = token[overlap > 0], section[overlap > 0], overlap[overlap > 0]
    crossing = np.bincount(section, minlength=len(low))
    if rule == "split":
        count += np.bincount(section, overlap / (ends[token] - starts[token]), minlength=len(low))
    elif rule == "start":
        own = (low[section] <= starts[token]) & (starts[token] < high[section])
        count += np.bincount(section[own], minlength=len(low))
    else:
        order = np.lexsort((section, low[section], -overlap, token))
        best = np.ones(len(order), bool)
        best[1:] = token[order][1:] != token[order][:-1]
        count += np.bincount(section[order][best], minlength=len(low))
    return count, crossing


def _counted(
    batches: Iterator[pa.RecordBatch],
    text: str,
    sections: str | None,
    path: str,
    pattern: str,
    rule: str,
    out_names: list[str],
) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path, pattern)
    for batch in batches:
        row, names, values, n_row = [], [], [[], [], [], []], 0
        given = batch.column(sections).to_pylist() if sections else None
        for n_row, content in enumerate(batch.column(text)):
            content = content.as_py() or ""
            if given is None:
                low, high = line_sections(content)
                name = [str(i) for i in range(len(low))]
            else:
                own = [s for s in given[n_row] or [] if s is not None]
                if not own:
                    continue
                name = [s["name"] for s in own]
                size = len(content)
                low = np.array([min(max(s["start"] or 0, 0), size) for s in own], np.int64)
                high = np.array(
                    [size if s["end"] is None else min(max(s["end"], 0), size) for s in own], np.int64
                )
                high = np.maximum(low, high)
            count, crossing = attribute(*encoder.spans(content), low, high, rule)
            row.append(np.full(len(low), n_row))
            names.extend(name)
            for list_, x in zip(values, (low, high, count, crossing), strict=True):
                list_.append(x)
        take = pa.array(np.concatenate(row) if row else np.zeros(0, np.int64), pa.int64())
        out = [
            batch.column(c).take(take) for c in batch.schema.names if c not in (text, sections)
        ]
        out.append(pa.array(names, pa.string()))
        for x, kind in zip(values, ("int64", "int64", "float64", "int64"), strict=True):
            out.append(pa.array(np.concatenate(x) if x else [], kind))
        yield pa.RecordBatch.from_arrays(out, names=out_names)


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    sections: str | None = None,
    rule: str = "most",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """A row per section: input columns without text and sections, then ``section``, ``start`` and ``end``
    (characters), ``n_tokens`` (long; double for ``split``) and ``n_crossing``.

    ``sections`` names a column of arrays of (name, start, end).
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    inner = C.hidden(docs)
    t = C.position(docs, text)
    s = C.position(docs, sections) if sections else None
    kept = [f for f in inner.schema if f.name not in (t, s)]
    schema = T.StructType(list(kept))
    for name, kind in (
        ("section", T.StringType()),
        ("start", T.LongType()),
        ("end", T.LongType()),
        ("n_tokens", T.DoubleType()),
        ("n_crossing", T.LongType()),
    ):
        schema = schema.add(name, kind)
    names = schema.names
    counted = inner.mapInArrow(
        lambda b: _counted(b, t, s, vocabulary, pattern, rule, names), schema
    )
    if rule != "split":
        counted = counted.withColumn("n_tokens", F.col("n_tokens").cast("long"))
    counted = counted.toDF(*[f"in_{i}" for i in range(len(kept))], *names[len(kept) :])
    shown = [n for n in docs.columns if n not in (text, sections)]
    return C.shown(counted, shown, {c: c for c in names[len(kept) :]})


def with_sections(docs: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``sections``, an array of the rows (key, name, start, end) of a table of sections."""
    gathered = sections.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "name"))).alias("sections")
    )
    gathered = gathered.withColumn(
        "sections",
        F.transform(
            "sections", lambda x: F.struct(x["name"].alias("name"), x["start"].alias("start"), x["end"].alias("end"))
        ),
    )
    return docs.join(gathered, key, "left")

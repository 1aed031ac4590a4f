"""Plain Python versions of the operators, as direct as can be, and awkward documents."""

import collections
import hashlib
import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: doc_id, text, source and columns whose names operators use inside.
SCHEMA = "doc_id long, text string, source string, block long, fingerprint string, size string"


def words(text):
    return WORD.findall(text or "")


def awkward():
    """Nulls, empty and very long texts, copies, shared passages, repeated rows, odd blanks."""
    rng = random.Random(3)
    say = lambda n, k=400: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    passage, base = say(60), say(300)
    near = base.split()
    near[150] = "otherword"
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "Two words",
        "tabs\tand\nlines\r\nand\x0bmore\x0cend ",
        passage,
        say(40) + "\n" + passage + " " + say(70),
        passage.replace(" ", "\n") + "\n" + say(10),
        base,
        base,
        base.upper(),
        " ".join(near),
        say(20_000, 50_000),
        "same words " * 120,
        "é漢字 😀 " * 60,
        "x" * 70_000 + " " + say(50),
        "line one here\n" * 5 + say(60),
        "#$%& ***" * 40,
    ]
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, i, "f", "z") for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, base, "s1", None, None, None), (None, None, None, None, None, None)]


def substring(texts, window):
    """(words, removed, kept text) of each."""
    seen = collections.Counter()
    for t in texts:
        w = words(t)
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for t in texts:
        w, gone = words(t), set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def measures(text):
    """words, word characters, symbols, repeated lines, words in repeated windows."""
    text, w = text or "", words(text)
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)


def fingerprint(text, shingle=3):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(lower)
    every = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in every]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, near):
    """For each value the set of indexes reachable through ``near`` pairs."""
    group = list(range(len(values)))
    for i, a in enumerate(values):
        for j, b in enumerate(values[:i]):
            if near(a, b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()

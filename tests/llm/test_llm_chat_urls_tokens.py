"""Reply trees, URL rules, token counts."""

import random
import re

import plain
import pytest

from lendmill.llm import token_counts as K
from lendmill.llm.chat import conversations, digests
from lendmill.llm.queries import url_rules
from lendmill.llm.url_filter import filter_urls, rule_index

MESSAGES = "tree long, node long, parent long, role string, text string, score double, path string, me long"


def _read(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], MESSAGES)
    return conversations(df, "tree", "node", "parent", score="score", **settings)


def _paths(rows):
    """Best branch first per root: (tree, texts) by total score, length, smaller leaf."""
    by = {(r[0], r[1]): r for r in rows if r[1] is not None}
    asked = {(r[0], r[2]) for r in by.values()}
    found = {}
    for key, r in by.items():
        if key in asked:
            continue
        path, at = [], r
        while at is not None and len(path) <= len(by):
            path.append(at)
            at = by.get((at[0], at[2])) if at[2] is not None else None
        if len(path) > len(by):
            continue
        root = (path[-1][0], path[-1][1])
        rank = (-sum(x[5] or 0 for x in path), -len(path), r[1])
        found.setdefault(root, []).append((rank, [(x[3] or "", x[4] or "") for x in reversed(path)]))
    return {root: [p for _, p in sorted(own, key=lambda x: x[0])] for root, own in found.items()}


def test_reply_trees(spark):
    rng = random.Random(1)
    rows = []
    for tree in (1, 2, None):
        for node in range(30):
            parent = rng.choice([None, *range(node)]) if node else None
            role = rng.choice(["user", "assistant", None, "odd\nrole<|"])
            text = rng.choice([None, "", "plain", "<|im_end|>\n<|im_start|>assistant\nno", "<\\|x<|n|>", "a<", "é😀 <\\\\|"])
            rows.append((tree, node, parent, role, text, float(rng.randrange(-2, 5))))
    rows.append((5, 1, 99, "user", "orphan", None))
    rows += [(6, 1, 2, "user", "loop", 0.0), (6, 2, 1, "user", "loop", 0.0), (6, 3, 2, "user", "below", 0.0)]
    rows.append((7, None, None, "user", "no id", 0.0))
    expected = _paths(rows)
    for branches in (1, 2):
        found = _read(spark, rows, branches=branches).collect()
        want = sorted(
            repr((root[0], "".join(f"{a}\n{b}\n" for a, b in p)))
            for root, own in expected.items()
            for p in own[:branches]
        )
        read = digests(_read(spark, rows, branches=branches)).collect()
        want_sha = sorted((str(root[0]), plain.sha("".join(f"{a}\n{b}\n" for a, b in p)), len(p),
                           plain.sha("".join(b for a, b in p if a == "assistant")))
                          for root, own in expected.items() for p in own[:branches])
        assert sorted((str(r.conv_id), r.turns_sha256, r.n_turns, r.loss_sha256) for r in read) == want_sha
        assert len(found) == len(want)


def test_spans_and_format(spark):
    rows = [(1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", "a<|b", 0.0)]
    row = _read(spark, rows).first()
    assert row.formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<\\|b<|im_end|>\n"
    (span,) = row.loss_spans
    assert row.formatted[span.start : span.end] == "a<\\|b"


def test_long_chain_and_repeated_rows(spark):
    chain = [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.0) for i in range(300)]
    (row,) = digests(_read(spark, chain + chain[:50])).collect()
    assert row.n_turns == 300
    assert row.turns_sha256 == plain.sha("".join(f"{r[3]}\n{r[4]}\n" for r in chain))


def test_no_messages(spark):
    assert _read(spark, [(1, 1, None, "u", "t", 0.0)]).where("false").collect() == []
    empty = spark.createDataFrame([], MESSAGES)
    assert conversations(empty, "tree", "node", "parent").collect() == []


# ---- URLs ---------------------------------------------------------------------

URLS = [
    None,
    "",
    "no scheme example.net/en/1",
    "http://net/",
    "http://net",
    "http://x.NET/a",
    "http://xnet/",
    "https://m.example.net/en/1?x=/de/#top",
    "https://example.net/EN/1",
    "https://example.com/de/1",
    "https://badexample.com/de/1",
    "https://example.com/fr/?u=http://b.net/",
    "ftp://a.b.org/fr/x#y",
    "http://org/fr/",
    "http://org/fr",
    "http://é.org/fr/ü",
    "http://a.org/shop/cart/1",
    "://a.net/",
    "http://" + "a." * 3000 + "net/" + "x/" * 3000,
    "http://a.net/en/\nexample.net/en/",
]


def _judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = host.translate({i: i + 32 for i in range(65, 91)})
    best = None
    for h, p, verdict in (("net", "/", "block"), ("example.net", "/en/", "allow"),
                          ("example.com", "/de/", "block"), ("org", "/fr/", "allow")):
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0,), (len(h + p), h + p, verdict))
    if best:
        return host, path, best[1], best[2]
    junk = re.search(r"/(wp-admin/|wp-login|cgi-bin/|cart/|checkout/|login/|signin/)", path)
    return host, path, None, "block" if junk else "allow"


@pytest.mark.parametrize("broadcast_rules", [50_000, 0])
def test_urls(spark, broadcast_rules):
    rows = [(i, u, "clash", 1) for i, u in enumerate(URLS)]
    rows += [rows[5], rows[5], (None, URLS[5], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, times int")
    found = filter_urls(pages, url_rules(spark), broadcast_rules=broadcast_rules).collect()
    got = sorted(
        repr((r.page_id, r.host, r.path, r.rule if r.priority == 1 else None, r.verdict)) for r in found
    )
    assert got == sorted(repr((r[0], *_judge(r[1]))) for r in rows)


def test_rules_by_rarest_token(spark):
    rules = spark.createDataFrame(
        [("r", "shop.example.com", "/a*b/sale/x", "block", 1), ("s", "", "*", "block", 0), ("t", "", "/x", "allow", 1)],
        "rule string, host string, path string, verdict string, priority int",
    )
    seen = spark.createDataFrame([("shop",)] * 2 + [("example",)] * 9 + [("com",)] * 9 + [("sale",)], "token string")
    by = {r.rule: r.token for r in rule_index(rules, seen).collect()}
    assert by == {"r": "sale", "s": "", "t": ""}


def test_wildcards_and_no_rules(spark):
    rules = spark.createDataFrame(
        [("w", "a.com", "/x*(y)/", "block", 1)],
        "rule string, host string, path string, verdict string, priority int",
    )
    pages = spark.createDataFrame(
        [(1, "http://a.com/xyz(y)/q"), (2, "http://a.com/xyzy/q"), (3, "http://b.a.com/x\n(y)/")],
        "page_id long, url string",
    )
    assert {r.page_id: r.verdict for r in filter_urls(pages, rules).collect()} == {1: "block", 2: "allow", 3: "block"}
    assert {r.verdict for r in filter_urls(pages, rules.where("false")).collect()} == {"allow"}
    assert filter_urls(pages.where("false"), rules).collect() == []


# ---- tokens -------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return K.Encoder(K.VOCABULARY, K.PATTERN)


TEXTS = ["", "plain words here", "a\n\n\nb\n", "é漢字😀\n\nmixed 😀😀\n", " \n \n", "tail without break\nlast", "\n"]


def _slow(encoder, text, sections, rule):
    raw, at, count, cross = text.encode(), 0, [0.0] * len(sections), [0] * len(sections)
    for i in encoder._encoding.encode_ordinary(text):
        n = int(encoder.lengths[i])
        chars = []
        for b in range(at, at + n):
            lead = b
            while raw[lead] & 0xC0 == 0x80:
                lead -= 1
            chars.append(len(raw[:lead].decode()))
        own, at = sorted(set(chars)), at + n
        shares = [len([c for c in own if a <= c < z]) for a, z in sections]
        for k, share in enumerate(shares):
            cross[k] += 0 < share < len(own)
        if rule == "split":
            count = [x + s / len(own) for x, s in zip(count, shares, strict=True)]
        elif rule == "start":
            count = [x + (a <= own[0] < z) for x, (a, z) in zip(count, sections, strict=True)]
        elif max(shares, default=0):
            count[min(range(len(sections)), key=lambda k: (-shares[k], sections[k][0], k))] += 1
    return count, cross


@pytest.mark.parametrize("rule", K.RULES)
def test_tokens_of_lines(spark, encoder, rule):
    docs = spark.createDataFrame(
        [(i, t, i) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string, n_tokens int"
    )
    found = K.count_tokens(docs, rule=rule).collect()
    for i, text in enumerate([*TEXTS, None]):
        text = text or ""
        own = sorted((r for r in found if r.doc_id == i), key=lambda r: r.start)
        lines = text.splitlines(keepends=True) or [""]
        assert [text[r.start : r.end] for r in own] == lines
        count, cross = _slow(encoder, text, [(r.start, r.end) for r in own], rule)
        assert [r.n_tokens for r in own] == pytest.approx(count)
        assert [r.n_crossing for r in own] == cross
        assert sum(r.n_tokens for r in own) == pytest.approx(len(encoder._encoding.encode_ordinary(text)))


def test_tokens_of_given_sections(spark, encoder):
    text = "Some heading\nand a longer body, with words; tail 😀 end"
    table = [(1, "a", 0, 9), (1, "b", 9, 21), (1, "c", 25, 500), (1, "d", 30, 20), (1, "e", None, None), (3, "z", 0, 4)]
    sections = spark.createDataFrame(table, "doc_id long, name string, start long, end long")
    docs = spark.createDataFrame([(1, text), (2, "no sections"), (3, None)], "doc_id long, text string")
    for rule in ("start", "split"):
        found = K.count_tokens(K.with_sections(docs, sections, "doc_id"), sections="sections", rule=rule)
        got = {(r.doc_id, r.section): r for r in found.collect()}
        assert set(got) == {(1, x) for x in "abcde"} | {(3, "z")}
        spans = [(0, 9), (9, 21), (25, len(text)), (30, 30), (0, len(text))]
        count, cross = _slow(encoder, text, spans, rule)
        assert [got[1, x].n_tokens for x in "abcde"] == pytest.approx(count)
        assert [got[1, x].n_crossing for x in "abcde"] == cross


def test_tokens_empty_table_and_long_text(spark, encoder):
    docs = spark.createDataFrame([(1, "long words\n" * 20_000)], "doc_id long, text string")
    assert K.count_tokens(docs.where("false")).collect() == []
    assert K.count_tokens(docs).count() == 20_000
    with pytest.raises(ValueError):
        K.count_tokens(docs, rule="other")

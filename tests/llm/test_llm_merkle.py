"""The manifest against plain Python, proofs that hold and proofs that do not."""

import hashlib
import zlib

from pyspark.sql import functions as F

from lendmill.llm import merkle as M
from lendmill.llm.queries import QUERIES

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([h("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return out


def siblings(levels, i, arity):
    for level in levels[:-1]:
        start = i - i % arity
        run = level[start : start + arity]
        yield "".join(run[: i - start]), "".join(run[i - start + 1 :])
        i //= arity


def plain(rows, arity=3, tampered=lambda r: r):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: levels_of([leaf_of(r) for r in groups[g]], arity) for g in order}
    top = levels_of([trees[g][-1][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = [*siblings(trees[g], i, arity), *siblings(top, k, arity)]
            own = leaf_of(tampered(r))
            for before, after in path:
                own = h(before + own + after)
            proof = h("".join(b + a for b, a in path))
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], proof, own, own == top[-1][0]))
    return sorted(out, key=repr)


def without_breaks(r):
    bent = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
    return (*r[:4], r[4].replace("\n", "")) if bent else r


def awkward():
    """A third is one row; null groups, order and texts; lone groups; a very long text."""
    rows = [(i, f"s{i % 4}", "en", i, f"text\n{i}\n") for i in range(60)]
    rows += [(7, "s3", "en", 7, "text\n7\n")] * 40
    rows += [(None, None, None, None, None)] * 3 + [(1, None, "é", 3, ""), (None, "s1", None, None, "")]
    rows += [(500, "alone", "漢", -4, "x\n" * 200_000), (2, "", "en", 0, "😀\n"), (2, "", "en", 0, "other")]
    return rows


def stored(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_query_equals_plain_python(spark, tmp_path):
    got = QUERIES["op11_merkle_manifest"](spark, stored(spark, tmp_path, awkward()))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == plain(awkward(), tampered=without_breaks)
    # tampering is found wherever it changed something, and only there
    changed = {leaf_of(r) for r in awkward() if without_breaks(r) != r}
    assert changed and all((leaf in changed) != fine for _, leaf, *_, fine in rows)


def leaves(df):
    return df.withColumn("leaf", M.row_digest(*NAMES))


def proofs(found):
    path = F.col("path")
    own = M.fold(F.col("leaf"), path)
    return sorted(
        map(tuple, found.select("doc_id", "leaf", "subroot", "root", M.path_digest(path), own, own == F.col("root")).collect()),
        key=repr,
    )


def test_runs_of_two_and_of_five(spark):
    df = leaves(spark.createDataFrame(awkward(), SCHEMA))
    for arity in (2, 5):
        assert proofs(M.manifest(df, arity=arity)) == plain(awkward(), arity)


def test_small_tables(spark):
    for rows in ([], awkward()[:1], awkward()[:4], [(i, "one", None, None, "") for i in range(3)]):
        found = M.manifest(leaves(spark.createDataFrame(rows, SCHEMA)))
        assert proofs(found) == plain(rows)


def test_clashing_names_go_through(spark):
    more = "root string, path string, g long, i long, n long, h string, level int, top string, tag int, place int"
    extra = ("r", "p", 1, 2, 3, "h", 4, "t", 5, 6)
    df = leaves(spark.createDataFrame([(*r, *extra) for r in awkward()[:20]], f"{SCHEMA}, {more}"))
    found = M.manifest(df)
    assert proofs(found) == plain(awkward()[:20])
    kept = ("g", "i", "n", "h", "level", "top", "tag", "place")
    assert {tuple(r) for r in found.select(*kept).collect()} == {(1, 2, 3, "h", 4, "t", 5, 6)}
    assert found.columns == [c for c in df.columns if c not in ("root", "path")] + ["subroot", "root", "path"]


def test_any_changed_value_is_found(spark):
    rows = awkward()[:30]
    found = M.manifest(leaves(spark.createDataFrame(rows, SCHEMA)))
    for column in ("n_chars", "lang", "source"):
        other = {"n_chars": F.col("n_chars") + 1, "lang": F.lit("fr"), "source": F.concat("source", F.lit(" "))}
        changed = M.row_digest(*[other[c] if c == column else c for c in NAMES])
        assert found.where(M.fold(changed, F.col("path")) == F.col("root")).isEmpty()

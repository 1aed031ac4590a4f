"""The packing query keeps near copies apart."""

import random

from lendmill.llm.queries import QUERIES


def test_no_bin_holds_two_near_copies(spark, tmp_path):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    near = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in (0, 299)]
    far = " ".join(f"v{rng.randrange(10**6)}" for _ in range(300))
    rows = [(1, near[0], "a"), (2, near[1], "b"), (3, far, "c"), (3, far[:40], "d"), (4, None, "e")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    linked = {r.doc_id: r.component_id for r in QUERIES["op8_simhash_near_dedup"](spark, str(tmp_path)).collect()}
    assert linked[1] == linked[2]
    found = QUERIES["op3_best_fit_packing"](spark, str(tmp_path))
    assert found.columns[:2] == ["doc_id", "source"] and "component_id" not in found.columns
    pieces = found.collect()
    assert sorted(r.source for r in pieces) == ["a", "b", "c", "d", "e"]
    bins = {r.source: r.bin_id for r in pieces}
    assert bins["a"] != bins["b"] and bins["e"] is None

"""Mixing a source whose rows are equal in every column."""

from lendmill.llm.mixing import mix


def test_equal_rows_hit_the_target(spark):
    rows = [(1, "five words are in here", "a")] * 1000
    rows += [(10 + i, "four words in each", "b") for i in range(200)]
    rows += [(2, "four words in each", "b")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(docs, keep_text=False).collect()
    assert len(found) == len(rows)
    for source, size in (("a", 5), ("b", 4)):
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= size
        assert max(r.times for r in own) - min(r.times for r in own) <= 1
    again = mix(docs.repartition(7), keep_text=False).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))

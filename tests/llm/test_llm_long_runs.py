"""Token counts of texts with very long runs of one character, and of repeated rows."""

import numpy as np
import pytest

from lendmill.llm import token_counts as K

PLACES = ("{run}", "word{run}", "{run}word", "one {run} two'll", "a\n{run}b {run}!", "{run}\n{run}", " {run} x{run}7")


@pytest.fixture(scope="module")
def encoder():
    return K.Encoder(K.VOCABULARY, K.PATTERN)


@pytest.mark.parametrize("run", [" ", "\n", " \n", "\t", "　", "\x85\xa0", "x", "漢", "!", "\x1f "])
@pytest.mark.parametrize("n", [K.LONG_GAP - 1, K.LONG_GAP, K.LONG_GAP + 1, 60_001])
def test_tokens_stay_the_same(encoder, run, n):
    for place in PLACES:
        text = place.format(run=run * n)
        assert np.array_equal(encoder.tokens(text), encoder._encoding.encode_ordinary(text)), (place, n)


@pytest.mark.parametrize("run, per", [(" ", 1), ("\n", 0.5), ("\t", None), ("x", 1 / 8), ("漢", 3)])
@pytest.mark.parametrize("n", [1_000_000, 10_000_000])
def test_runs_of_any_length(encoder, run, per, n):
    found = encoder.tokens(run * n)
    assert encoder.lengths[found].sum() == n * len(run.encode())
    assert per is None or len(found) == n * per


def test_spans_of_a_long_run(encoder):
    text = "é " + " " * 1_000_000 + "word"
    starts, ends = encoder.spans(text)
    assert starts[0] == 0 and ends[-1] == len(text) and text[starts[-1] : ends[-1]] == " word"
    assert (starts[1:] <= ends[:-1]).all()


def test_one_such_text_does_not_stop_the_table(spark):
    texts = ["\n" * 400_000, " " * 1_000_000, "a b", "a b", None, "x" * 1_000_000 + "\n"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(2, "a b")], "doc_id long, text string")
    found = K.count_tokens(df).groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in found} == {0: 200_000, 1: 1_000_000, 2: 4, 3: 2, 4: 0, 5: 125_001}

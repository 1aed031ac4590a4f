"""Semantic layer, retrieval and the default model on small frames."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lendmill.operators import ml
from lendmill.operators import retrieval as R
from lendmill.operators import semantic as S


@pytest.fixture(scope="module")
def marts(spark):
    loans = spark.createDataFrame(
        [("L1", "C1", "SMB", "CURRENT", "LANCAR", 0, 10), ("L2", "C1", "SMB", "DPD_1_30", "LANCAR", 1, 20), ("L3", "C2", "Other", "CURRENT", "LUNAS", 0, 30), ("L4", None, "SMB", "CURRENT", "LUNAS", None, 40)],
        "loan_id string, customer_id string, product_segment string, dpd_bucket string, status string, is_default int, outstanding int",
    )
    customers = spark.createDataFrame(
        [("C1", "Bali", "SMB", "Badung", 100), ("C2", "Bali", "Retail", "Denpasar", 50), ("C3", None, "SMB", None, 7)],
        "customer_id string, province string, segment string, city string, total_savings_balance int",
    )
    return {"loans": loans, "customers": customers}


def ask(marts, *args):
    return rows(S.semantic_query(S.LOAN_PORTFOLIO, marts, *args))


def test_each_metric_keeps_its_grain(marts):
    metrics = ["total_loans", "npl_rate", "total_outstanding", "total_customers", "total_savings"]
    assert ask(marts, metrics, ["provinsi"]) == [
        ("Bali", 3, 1 / 3, 60, 2, 150),
        (None, 1, None, 40, 1, 7),
    ]


def test_totals_and_filters(marts):
    assert ask(marts, ["total_loans", "total_customers"], []) == [(4, 3)]
    assert ask(marts, ["total_outstanding"], ["produk"], {"segmen nasabah": "SMB"}) == [("SMB", 30)]
    assert ask(marts, ["total_customers"], ["segment"], {"wilayah": "Bali"}) == [("Retail", 1), ("SMB", 1)]


def test_fan_out_is_refused(marts):
    with pytest.raises(ValueError):
        ask(marts, ["total_savings"], ["product_segment"])
    with pytest.raises(KeyError):
        ask(marts, ["total_savings"], ["nonsense"])


def test_synonyms():
    names = {t: S.resolve(S.LOAN_PORTFOLIO, t) for t in ("Pinjaman", "nasabah", "produk", "kota", "npl_rate")}
    assert names == {"Pinjaman": "loans", "nasabah": "customers", "produk": "product_segment", "kota": "city", "npl_rate": "npl_rate"}


DOCS = [
    ("D1", "Pinjaman", "Produk", "Uang digital untuk usaha kecil; cicilan tetap, tanpa jaminan."),
    ("D2", "Tabungan", "Produk", "Simpan uang lewat ponsel, tanpa ongkos, tanpa antre, serba digital."),
    ("D3", "SOP Penagihan", "SOP", "PROSES penagihan: surat, lalu telepon, lalu kunjungan ke rumah."),
    ("D4", "SOP Data", "SOP", "Kartu pengenal harus punya 16 angka dan foto yang jelas."),
    ("D5", "Skor", "Kebijakan", "Petugas kredit melihat riwayat bayar serta gaji pemohon."),
    ("D6", "Kosong", "SOP", ""),
    ("D7", "Hilang", "SOP", None),
]
QUERY = "bagaimana proses penagihan kredit macet?"


def brute_scores(query):
    import math
    import re

    split = lambda s: [w for w in re.split(r"[\W_]+", (s or "").lower()) if w]
    docs = {d[0]: split(d[3]) for d in DOCS}
    mean = sum(map(len, docs.values())) / len(docs)
    out = {}
    for t in set(split(query)):
        df = sum(t in w for w in docs.values())
        idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
        for d, w in docs.items():
            if t in w:
                tf = w.count(t)
                out[d] = out.get(d, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
    return {d: round(s, 6) for d, s in out.items()}


@pytest.mark.parametrize("query", [QUERY, "digital TANPA tanpa; kunjungan 16", "tidak ada"])
def test_search_finds_what_counting_by_hand_finds(spark, tmp_path, query):
    docs = spark.createDataFrame(DOCS, "doc_id string, title string, category string, content string")
    index = R.build_index(docs, "content", "doc_id", ["title", "category"])
    R.write_index(index, str(tmp_path / "index"))
    stored = R.read_index(spark, str(tmp_path / "index"), "doc_id")
    want = sorted(brute_scores(query).items(), key=lambda s: (-s[1], s[0]))[:3]
    for found in (
        R.search(index, query, ["title"], 3),
        R.search(stored, query, ["title"], 3),
        R.search_texts(docs, "content", "doc_id", query, ["title"], 3),
    ):
        assert [(r["doc_id"], r["score"]) for r in found.collect()] == want


def test_the_collection_procedure_comes_first(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, title string, category string, content string")
    index = R.build_index(docs, "content", "doc_id", ["title"])
    found = R.search(index, QUERY, ["title"], 3)
    assert [r["title"] for r in found.collect()] == ["SOP Penagihan", "Skor"]
    response = R.results_json(found, "doc_id")
    assert '"results":[{"doc_id":"D3"' in response.first()[0]
    back = R.parse_results(response, "doc_id string, title string, score double")
    assert [r["doc_id"] for r in back.collect()] == ["D3", "D5"]


def test_word_counts(spark):
    docs = spark.createDataFrame([(1, "b a b, A! c"), (2, " "), (3, None), (3, "z")], "id int, t string")
    got = rows(R.build_index(docs, "t", "id").postings)
    assert got == sorted([("a", 1, 5, 2), ("b", 1, 5, 2), ("c", 1, 5, 1), ("z", 3, 1, 1)], key=repr)


def test_stored_index_is_read_by_term(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id string, title string, category string, content string")
    R.write_index(R.build_index(docs, "content", "doc_id"), str(tmp_path / "i"))
    scores = R.score_documents(R.read_index(spark, str(tmp_path / "i"), "doc_id"), "proses kredit")
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [" in plan


def test_vectors(spark):
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 1.0]), (5, [0.0, 0.0])]
    df = spark.createDataFrame(data, "id int, v array<float>")
    got = [tuple(r) for r in R.vector_topk(df, [1.0, 0.0], 4, "id", "v").collect()]
    assert got == [(1, 1.0), (2, 1.0), (4, 0.707107), (3, 0.0)]


def test_model(spark, tmp_path):
    n = F.col("id")
    c360 = spark.range(400).select(
        n.alias("customer_id"),
        F.when(n % 10 != 0, 300 + n % 550).alias("credit_score"),
        (n * 1000).alias("monthly_income"),
        (20 + n % 40).alias("age"),
        (n % 3).alias("n_loans"),
        (n % 7 * 100).alias("total_outstanding"),
        F.lit(5).alias("total_savings_balance"),
        (n % 4).alias("n_transactions"),
        (n % 3 == 2).cast("int").alias("ever_default"),
    )
    rows_ = ml.features(c360)
    assert rows_.filter("credit_score = 0").count() == 40
    train, test = ml.split(rows_, "customer_id")
    assert train.count() + test.count() == 400 and 40 < test.count() < 120
    again, _ = ml.split(rows_.repartition(7), "customer_id")
    assert rows(again.select("customer_id")) == rows(train.select("customer_id"))
    model = ml.train(train, rounds=3, depth=2)
    metrics = ml.evaluate(ml.predict(model, test))
    assert metrics["accuracy"] == 1.0 and metrics["roc_auc"] == 1.0
    table = {r["actual"]: (r["predicted_0"], r["predicted_1"]) for r in ml.confusion(ml.predict(model, test)).collect()}
    assert table[0][1] == 0 and table[1][0] == 0 and sum(map(sum, table.values())) == test.count()
    assert ml.importance(model)[0][0] == "n_loans" and len(ml.importance(model)) == 5
    ml.save(spark, model, str(tmp_path / "m"), "V1", metrics)
    scored = ml.score(ml.load(str(tmp_path / "m"), "V1"), rows_)
    assert scored.columns == ["customer_id", "predicted_default_probability"]
    assert scored.filter("predicted_default_probability between 0 and 1").count() == 400
    leak = {r["feature"]: r["label_rate_at_zero"] for r in ml.leakage(rows_).collect()}
    assert leak["n_loans"] == 0.0
    assert rows(ml.target_balance(rows_).select("n_rows")) == [(133,), (267,)]


def test_an_index_follows_its_documents(spark, tmp_path):
    """Replaced texts answer no more, removed documents are gone, and compaction changes nothing."""
    path, out = str(tmp_path / "i"), str(tmp_path / "c")
    kind = "id int, t string, gone boolean"
    parts = [
        [(1, "old word", False), (2, "kept word", False), (3, "leaving word", None)],
        [(1, "new text", False), (3, None, True), (4, "late word", False)],
        [(3, "back word", False), (4, "x", True)],
    ]
    for number, rows_ in enumerate(parts):
        index = R.build_index(spark.createDataFrame(rows_, kind), "t", "id", deleted="gone")
        R.write_index(index, path, number)
    live = R.read_index(spark, path, "id")
    R.compact_index(spark, path, "id", out)
    for index in (live, R.read_index(spark, out, "id")):
        found = {r["id"] for r in R.score_documents(index, "word").collect()}
        assert found == {2, 3} and index.docs.count() == 3
        assert {r["id"] for r in R.score_documents(index, "old").collect()} == set()
    fresh = R.build_index(
        spark.createDataFrame([(1, "new text"), (2, "kept word"), (3, "back word")], "id int, t string"), "t", "id"
    )
    assert rows(R.score_documents(live, "word text")) == rows(R.score_documents(fresh, "word text"))

import pytest
from test_entry import compare

from sievemill.llm import leakage, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, data, name):
    compare(spark, data, name, queries.QUERIES[name], queries.ORACLES[name])


def test_leaks_equal_brute_force(spark, data):
    got = {tuple(r) for r in queries.p9_found(spark, data).collect()}
    index, want = {}, set()
    for i, t in spark.read.parquet(f"{data}/eval_items.parquet").select("item_id", "text").collect():
        w = leakage.words_of(t)
        for k in range(len(w) - 12):
            index.setdefault(tuple(w[k : k + 13]), set()).add(i)
    for d, t in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        w = leakage.words_of(t)
        for k in range(len(w) - 12):
            want |= {(d, i) for i in index.get(tuple(w[k : k + 13]), ())}
    assert got == want


def test_columns(spark, data):
    want = {
        "p3_found": ["tbl", "row_id", "field", "pos"], "p5_found": ["party_id_a", "party_id_b"], "p7_found": ["number", "field", "seq"],
        "p10_found": ["doc_id_a", "doc_id_b"],
    }
    for name, columns in want.items():
        df = queries.QUERIES[name](spark, data)
        assert df.columns == columns
        rows = df.collect()
        assert len(rows) == len(set(rows)) > 0


def test_near_windows_are_two_edits_apart(spark, tmp_path):
    items = [(k, " ".join(f"w{k}x{n}" for n in range(13))) for k in range(40)]
    docs = []
    for k, text in items:
        w = text.split()
        if k % 2:
            w[3] = w[9] = "changed"
        else:
            w.insert(6, "inserted")  # 13 of these 14 words are two edits from the item
        docs.append((k, " ".join(["pad"] * 5 + w + ["pad"] * 5)))
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    got = {(r.doc_id, r.item_id): r.least_edits for r in queries.p9_near(spark, str(tmp_path)).collect()}
    assert all(a == b and e == 2 for (a, b), e in got.items())
    assert len(got) >= 36

"""The pipeline against its stages done by hand, and every registered query
against its SQL."""

import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from mesura.llm import catalog
from mesura.llm import language_id, packing, toxicity
from mesura.llm.common import doc_split, read_table, shared_table
from tests.llm.test_near_dedup import brute
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    con = duck(SF)
    for t in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_registered():
    names = set(E.queries())
    assert {n for n in names if n.startswith("op")} >= set(catalog.QUERIES) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
    assert len(C.STAGES) == 4 and C.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    info = compare(spark, con, SF, name, catalog.QUERIES[name], catalog.ORACLE.get(name))
    assert info.get("ok") in (True, None), info
    assert info["rows"] > 0


def fixture(spark, tmp_path):
    rng = random.Random(11)
    fine = "the river runs under a bridge while people walk home after morning work near windows".split()
    rows, labels = [], []
    for k in range(300):
        words = [rng.choice(fine) + str(rng.randrange(30)) * (rng.random() < 0.3) for _ in range(rng.randrange(30, 60))]
        if k % 4 == 0:
            words[3:3] = ["moron", "scum"]
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, 1, int(k % 4 == 0)))
    rows += [(500 + k, rows[5 + k][1], "en", "s", 1) for k in range(20)] + [(600, rows[9][1] + " more", "en", "s", 1), (700, None, None, None, None), (701, "", "en", "s", 1), (702, "12 34", "en", "s", 1), (703, "ቋንቋ ያልታወቀ", None, "s", 1), (None, "people walk", None, "s", 1)]
    rows += [rows[9]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_against_brute_force(spark, tmp_path):
    sf = fixture(spark, tmp_path)
    docs = read_table(spark, sf, "documents")
    rows = [tuple(r) for r in docs.collect()]
    columns = docs.columns

    model = toxicity.fit(docs, read_table(spark, sf, "labels").filter(doc_split("doc_id", 5) != 0))
    rows = [r for r in rows if model.score(r[1]) < 0.5]
    docs = shared_table(spark, C.drop_toxic(spark, docs, sf), "a")
    key = lambda r: tuple(map(str, r))
    assert docs.columns == columns and sorted(map(tuple, docs.collect()), key=key) == sorted(rows, key=key)
    assert {r[0] for r in rows} >= {k for k in range(300) if k % 4} and not {r[0] for r in rows} & {k for k in range(300) if k % 4 == 0}

    profiles = language_id.fit(docs.filter(doc_split("doc_id", 4) != 2))
    rows = [r for r in rows if profiles.predict(r[1])[0] != "und" and profiles.predict(r[1])[1]]
    docs = shared_table(spark, C.drop_unknown_language(spark, docs, sf), "b")
    assert docs.columns == columns and sorted(map(tuple, docs.collect()), key=key) == sorted(rows, key=key)
    assert not {r[0] for r in rows} & {700, 701, 702, 703}

    comp = brute([r[:2] for r in rows])
    rows = [*{r[0]: r for r in rows if r[0] is not None and comp[r[0]] == r[0]}.values(), *(r for r in rows if r[0] is None)]
    docs = shared_table(spark, C.drop_near_duplicates(spark, docs, sf), "c")
    assert docs.columns == columns and sorted(map(tuple, docs.collect()), key=key) == sorted(rows, key=key)

    packed = C.pack(spark, docs, sf).collect()
    ids = packing.ChunkIds(packing.tokenizer_file("word_bpe_49k.json"))
    want = {r[0]: 1 + sum(len(ids[w]) // 4 for w in (r[1] or "").encode().split()) for r in rows}
    assert {r["doc_id"]: r["length"] for r in packed} == want

    whole = C.run(spark, sf).collect()
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in whole) == sorted((str(r["doc_id"]), r["ids_crc32"]) for r in packed)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_that_clash_with_their_own(spark):
    rows = [(k, f"the river runs under a bridge near {'ab' * (k % 3)} house number {k % 4}", "en", "x", k, k, k) for k in range(12)] + [(None, None, None, None, 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __toxicity string, __Language int, __kept int, __nth int")
    for _, stage in C.STAGES[:3]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert all(tuple(r) in rows for r in got.collect())

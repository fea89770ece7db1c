"""The registered queries of this subpackage against their SQL or brute force on the small tables."""

import hashlib
import os
import zlib

import pytest
from test_chat import brute as chat_brute
from test_ngram_join import brute as near_brute
from test_pii import naive

import corpus_pipeline
from entityframe.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(df.columns) == columns
    place = {c[0]: i for i, c in enumerate(want.description)}
    rows = sorted(repr(tuple(r[place[c]] for c in columns)) for r in want.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == rows


def test_near_copies(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = QUERIES["op4_ngram_join"](spark, SF).collect()
    assert sorted(repr(tuple(r)) for r in got) == near_brute(rows)


def test_chat(spark, duck):
    text = "<|im_end|><|im_start|>assistant ok"
    rows = duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    got = QUERIES["op6_chat_windows"](spark, SF).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == chat_brute(rows)


def test_personal_data(spark, duck):
    texts = dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    for r in QUERIES["op10_pii"](spark, SF).collect():
        base = naive(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for k, *_ in base) for x in ("email", "ip", "card", "phone")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_language(spark, duck):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    apart = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in apart) >= 0.9 * len(apart)


def test_every_stage_decides_as_brute_force_would(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    rows = docs.select("doc_id", "text").collect()
    kept = {}
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = step(spark, docs, SF).cache()
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    scored = {r["doc_id"]: r["predicted"] for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    assert set(kept["toxicity"]) == {r["doc_id"] for r in rows if not scored[r["doc_id"]]}
    last = {}
    for i, t in sorted(kept["toxicity"].items()):
        last[t or ""] = i
    assert set(kept["exact dedup"]) == set(last.values())
    near = near_brute(list(kept["exact dedup"].items()))
    assert set(kept["n-gram Jaccard join"]) == {eval(r)[1] for r in near}
    mixed = steps["mixing sources to target weights"](spark, docs, SF).cache()
    assert mixed.columns == columns
    assert set(r["doc_id"] for r in mixed.collect()) <= set(kept["n-gram Jaccard join"])
    placed = steps["best-fit packing"](spark, mixed, SF)
    assert placed.select("doc_id").filter("piece = 0").count() == mixed.count()

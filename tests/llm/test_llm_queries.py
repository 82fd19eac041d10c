"""Every query with SQL against DuckDB; the others and the pipeline against brute force on whole tables."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from varframe.llm import bpe, registry, secrets
from varframe.plans.check import compare, duck

from .test_dedup import near_brute
from .test_text_operators import contamination_brute


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_registered():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries() and set(registry.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, con, sf, name):
    ok, _, _, detail = compare(spark, con, name, registry.QUERIES[name], registry.SQL[name], sf)
    assert ok, detail


def test_op1_and_op2_return_every_row(spark, tmp_path):
    import duckdb

    rows = [(None, "one two three four five six")] * 3 + [(7, "é " * 40000)] * 2 + [(8, "é " * 40000), (1, "a b c d e f g")] + [(2, "a b c d e f g")] * 2500
    rows += [(3, None), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = duckdb.sql(registry.SQL["op1_exact_dedup"].replace("from documents", f"from '{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    got = registry.QUERIES["op1_exact_dedup"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    near = registry.QUERIES["op2_near_dedup"](spark, str(tmp_path)).collect()
    size = {None: (None, 3), 7: (8, 3), 8: (8, 3), 1: (2, 2501), 2: (2, 2501), 3: (3, 1), 4: (4, 1)}
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in near), key=str) == sorted(((i, *size[i]) for i, _ in rows), key=str)


def test_op2(spark, con, sf):
    rows = con.sql("select doc_id, text from documents").fetchall()
    got = registry.QUERIES["op2_near_dedup"](spark, sf).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == near_brute(rows)


def test_op5(spark, con, sf):
    texts = dict(con.sql("select doc_id, coalesce(text, '') from documents").fetchall())
    got = registry.QUERIES["op5_secret_scan"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        base = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in secrets.base_spans(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k + ":") for x in base) for k in secrets.KINDS[:3])


def test_op6_and_op9(spark, con, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_file())
    texts = dict(con.sql("select doc_id, coalesce(text, '') from documents").fetchall())
    for r in registry.QUERIES["op6_bpe"](spark, sf).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert registry.QUERIES["op9_token_counts"](spark, sf).filter("n_tokens > 0").count() == len(texts)


def test_pipeline_by_hand(spark, con, sf):
    rows = con.sql("select doc_id, text from documents").fetchall()
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    last = {t: i for i, t in sorted(rows)}
    rows = [(i, t) for i, t in rows if last[t] == i]
    keep = {c for _, c, _ in near_brute(rows)}
    rows = [(i, t) for i, t in rows if i in keep]
    found = contamination_brute([t for _, t in rows], con.sql("select item_id, text from benchmark").fetchall(), 13)
    rows = [r for k, r in enumerate(rows) if not found[k][3]]
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows}
    assert len(got) == len(rows)


def test_stages_take_odd_tables(spark, sf):
    odd = spark.createDataFrame([(1, None, None, None, None, "x"), (1, None, None, None, None, "x"), (None, "words here", "en", "s", 3, "x"),
                                 (2, "", "en", "s", 0, "x"), (3, "only words in here now", "en", "s", 1, "x")],
                                "doc_id long, text string, lang string, source string, n_chars long, sha string")
    for docs, most in ((odd, 2), (odd.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        assert docs.count() <= most

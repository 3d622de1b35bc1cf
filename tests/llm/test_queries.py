"""The registered corpus queries against SQL and brute force, on given tables and on odd ones."""

import hashlib
import os
import re
import zlib
from collections import Counter

import brute
import fixtures
import numpy as np
import oracle
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from saldoflow.llm import language_id, quality
from saldoflow.llm.queries import ORACLES, QUERIES, TOKENIZER

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BUILT_BY_HAND = {"op1_language_id", "op5_quality", "op7_main_text", "op8_packing", "op13_hash_forest"}


@pytest.fixture(scope="module", params=["given", "odd", "clashing"])
def tables(request, tmp_path_factory):
    return SF_DIR if request.param == "given" else fixtures.write(tmp_path_factory.mktemp(request.param), request.param)


def rows_of(tables, name):
    return pq.read_table(f"{tables}/{name}.parquet").to_pylist()


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())
    assert set(QUERIES) == set(ORACLES) | BUILT_BY_HAND


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, tables, name):
    got, con = QUERIES[name](spark, tables), oracle.connect(tables)
    assert oracle.difference(got, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    assert QUERIES[name](spark, fixtures.write(tmp_path, "empty")).count() == 0


def test_language(spark, tables):
    docs = rows_of(tables, "documents")
    got = QUERIES["op1_language_id"](spark, tables).collect()
    key = lambda x: (x[0], x[1])
    assert sorted((r.doc_id, r.held_out) for r in got) == sorted(
        ((d["doc_id"], zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) for d in docs), key=key)
    langs = {d["lang"] for d in docs} - {None}
    assert all(0 <= r.score <= 1 and r.lang_pred in langs | {"und"} for r in got)
    none = {d["doc_id"] for d in docs if not re.search(r"[^\W\d_]", d["text"] or "")}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == none
    if tables == SF_DIR:
        true = {d["doc_id"]: d["lang"] for d in docs}
        held = [r for r in got if r.held_out]
        assert sum(true[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_of_one_family_or_one_language(spark):
    texts = {"es": "el perro y la casa de los niños", "fr": "le chien et la maison des enfants", "en": "the dog and the house of the children"}
    for langs in (["es", "fr"], ["en"], ["en", "es"], []):
        docs = spark.createDataFrame([(i, texts[x] + f" {i}", x) for i, x in enumerate(langs * 4)], "doc_id bigint, text string, lang string")
        model = language_id.fit(docs, docs.doc_id >= 0)
        got = language_id.predict(docs.select("doc_id", "text", "lang"), model).collect()
        assert all(r.lang_pred == r.lang for r in got)
    assert language_id.predict(docs.sparkSession.sql("SELECT 1 AS doc_id, 'word' AS text"), model).first().lang_pred == "und"


def test_near_duplicates(spark, tables):
    docs = rows_of(tables, "documents")
    expected = brute.near_duplicates([(d["doc_id"], d["text"]) for d in docs])
    got = QUERIES["op3_ngram_join"](spark, tables).collect()
    assert sorted(r.doc_id for r in got) == sorted(d["doc_id"] for d in docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_quality(spark, tables):
    docs, labels = rows_of(tables, "documents"), rows_of(tables, "labels")
    got = QUERIES["op5_quality"](spark, tables).collect()
    assert sorted(r.doc_id for r in got) == sorted(d["doc_id"] for d in docs)
    if len({d["doc_id"] for d in docs}) == len(docs):
        good = {x["doc_id"] for x in labels if x["quality"] == 1}
        expected = brute.quality_weights({d["doc_id"]: d["text"] for d in docs}, good, quality.BUCKETS)
        assert all(abs(r.log_weight - expected[r.doc_id]) < 1e-6 * max(1, abs(r.log_weight)) for r in got)
    kept = sorted(r.key for r in got if r.kept)
    assert kept and all(r.key < kept[0] for r in got if not r.kept)  # the top k
    known = {x["doc_id"]: x["quality"] for x in labels}
    right = [r.kept == (known[r.doc_id] == 1) for r in got if r.doc_id in known]
    assert sum(right) >= 0.9 * len(right)


def test_packing(spark, tables):
    docs = rows_of(tables, "documents")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {d["doc_id"]: tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2] for d in docs}
    got = QUERIES["op8_packing"](spark, tables).toPandas()
    times = {i: sum(d["doc_id"] == i for d in docs) for i in ids}
    for i, pieces in got.groupby("doc_id"):
        whole = ids[i]
        assert pieces["length"].sum() == len(whole) * times[i]
        for p in pieces.itertuples():
            part = whole[p.start:p.start + p.length]
            assert (len(part), len(whole), zlib.crc32(np.array(part, "<u4").tobytes())) == (p.length, p.doc_tokens, p.ids_crc32)
    assert set(got["doc_id"]) == set(ids)
    ordered = got.sort_values(["sequence_id", "offset"])
    filled = ordered.groupby("sequence_id")["length"]
    assert (filled.cumsum() - ordered["length"] == ordered["offset"]).all()
    used = filled.sum()
    assert used.max() <= 4096 and used.sum() / (4096 * len(used)) > 0.95


def test_main_text(spark, tables):
    from html import unescape

    got = {r.page_id: r for r in QUERIES["op7_main_text"](spark, tables).collect()}
    for page in rows_of(tables, "pages"):
        article = re.search("<article>(.*?)</article>", page["html"] or "", re.S)
        if article:
            blocks = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article[1])]
            assert got[page["page_id"]].text == "\n\n".join(b for b in blocks if b)
        assert got[page["page_id"]].n_chars == len(got[page["page_id"]].text)


def test_turn_repair(spark, tables):
    expected = brute.repaired_conversations([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in rows_of(tables, "conversations")])
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_turn_repair"](spark, tables).collect()}
    lost = {r["conv_id"] for r in rows_of(tables, "conversations")} - set(expected)
    assert got == expected | {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in lost}


def test_spelling(spark, tables):
    got = {r.word: tuple(r)[1:] for r in QUERIES["op12_spelling"](spark, tables).collect()}
    assert got == brute.spelling([(d["doc_id"], d["text"]) for d in rows_of(tables, "documents")])
    if tables != SF_DIR:
        assert got["recive"][:2] == ("receive", "receive") and got["facade"][:2] == ("façade", "façades")
        assert got["z" * 70][0] == "z" * 69 and got["z" * 64][0] == "z" * 63


def test_nearest(spark, tables):
    rows = [(r["vec_id"], r["embedding"]) for r in rows_of(tables, "embeddings")]
    expected, got = sorted(brute.nearest(rows, 20), key=repr), {}
    found = QUERIES["op13_hash_forest"](spark, tables).collect()
    ids = Counter(q for q, _ in expected)
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(ids)
    hits = total = 0
    for q, best in expected:
        if ids[q] == 1:
            own = sorted(got[q])
            assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
            assert [(i, s) for _, i, s in own] == sorted(((i, s) for _, i, s in own), key=lambda x: (-x[1], x[0] is None, x[0]))
            hits, total = hits + len({*[(i, s) for _, i, s in own]} & set(best)), total + len(best)
    assert hits >= (0.9 if tables == SF_DIR else 0.99) * total

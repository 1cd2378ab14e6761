"""Registered queries: against their DuckDB SQL, and the pipeline's stages
against what each must keep."""
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import common, decontam, langid, simhash
from basketry.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("name, columns", [
    ("op3_simhash_pivots", "doc_id fingerprint component_id"), ("op5_language_crf", "doc_id held_out lang_pred score"),
    ("op8_pack_sequences", "doc_id start length ids_crc32 doc_tokens sequence_id offset"),
    ("op9_token_planes", "doc_id start n_tokens ids_crc32")])
def test_other_queries_cover_their_table(spark, name, columns):
    df = QUERIES[name](spark, SF)
    assert df.columns == columns.split()
    ids = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r[0] for r in df.select("doc_id").collect()} == ids


def docs_sf():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM read_parquet('{SF}/documents.parquet') ORDER BY doc_id").fetchall()


def test_simhash_query_value_by_value(spark):
    fps = {i: simhash.fingerprint(t, 3) for i, t, _ in docs_sf()}
    assert simhash.fingerprint("A b") == int(xxhash.xxh64_hexdigest(b"a b", 42), 16)  # one shingle: its hash
    low = {i: i for i in fps}
    while True:
        new = {i: min(low[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2) for i in fps}
        if new == low:
            break
        low = new
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op3_simhash_pivots"](spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", low[i]) for i in fps}


def test_language_query_value_by_value(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()).select("lang", "text"))
    got = {r["doc_id"]: r for r in QUERIES["op5_language_crf"](spark, SF).collect()}
    right = 0
    for i, text, lang in docs_sf():
        label, score = langid.label_texts([text], model)[0][:2]
        assert got[i]["lang_pred"] == label and abs(got[i]["score"] - score) < 1e-9
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        right += got[i]["held_out"] and label == lang
    assert right >= 0.9 * sum(r["held_out"] for r in got.values())


def library_ids(name, end):
    code = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    return {i: np.array([*code.encode(t or "", add_special_tokens=False).ids, end], "<u4") for i, t, _ in docs_sf()}


def test_packing_query_value_by_value(spark):
    ids = library_ids("byte_bpe_50k.json", 0)
    by_doc, by_sequence = {i: [] for i in ids}, {}
    for r in QUERIES["op8_pack_sequences"](spark, SF).collect():
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(piece.tobytes()) and len(piece) == r["length"]
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans, total in [(s, len(ids[i])) for i, s in by_doc.items()] + [(s, None) for s in by_sequence.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= 1024
    assert len(by_sequence) <= 1.02 * sum(map(len, ids.values())) / 1024 + 2


def test_token_file_query_value_by_value(spark):
    start, want = 0, {}
    for i, x in library_ids("word_bpe_49k.json", 1).items():
        want[i] = (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op9_token_planes"](spark, SF).collect()}
    assert got == want


def test_edit_counts_query_equals_full_encoding(spark):
    from basketry.llm.encode import Encoder
    from basketry.llm.queries import revision
    code = Encoder("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {}
    for r in docs.withColumn("edits", revision(F.col("text"))).collect():
        text = r["text"]
        for e in r["edits"]:
            text = text[:e["start"]] + e["new"] + text[e["start"] + e["length"]:]
        want[r["doc_id"]] = tuple(len(code.tokenizer.encode(t, add_special_tokens=False).ids) for t in (r["text"], text))
    got = {r["doc_id"]: (r["n_tokens_before"], r["n_tokens_after"]) for r in QUERIES["op7_edit_counts"](spark, SF).collect()}
    assert got == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(1)
    words = "the of and that with ing tion were here more".split()
    fresh = lambda n: " ".join(rng.choice(words) + str(rng.choice(words)) for _ in range(n))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").first()["text"]
    base = fresh(300)
    planted = [(10_001, None), (10_002, "12 34 --"), (10_003, base), (10_004, base), (10_005, base.upper()),
               (10_006, fresh(80) + " " + item + " " + fresh(80)), (10_007, fresh(120)), (10_007, fresh(120)), (10_008, base + " x"), (10_008, base + " x")]
    more = spark.createDataFrame([(i, t, None, "s", 0) for i, t in planted], docs.schema)
    docs = docs.unionByName(more).withColumn("score", F.lit(1.5)).withColumn("text_key", F.lit("x"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.written(stage(spark, docs, SF), "stage")
        seen[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            assert docs.exceptAll(before).count() == 0  # rows stay as they were
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    gone = {name: ids(a) - ids(b) for name, (a, b) in seen.items()}
    assert gone["language_id"] == {10_001, 10_002}
    assert {10_004, 10_005} <= gone["near_dedup"] and 10_003 not in gone["near_dedup"]
    before, after = seen["near_dedup"]
    parts = simhash.near_duplicates(before)
    assert after.count() == parts.select("class_fp").distinct().count()
    before, after = seen["decontaminate"]
    bad = decontam.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated")
    assert gone["decontaminate"] == ids(bad) and 10_006 in gone["decontaminate"]
    assert gone["pack"] == set() and {10_003, 10_007} <= ids(docs)


def test_pipeline_of_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), "stage")
    assert docs.count() == 0

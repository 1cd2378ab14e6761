"""Each operator against a brute-force version on small tables with nulls,
empty and long texts, ties, repeated rows, empty tables and extra columns."""
import collections
import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import chat, common, decontam, embeddings, langid, packing, sharding, simhash, tokencount
from basketry.llm import tokenfile, warc
from basketry.llm.encode import Encoder

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use for themselves
CLASH = ("fp", "row_number", "shard", "class", "part", "text_key", "kept_id", "language", "hit_at", "_tie", "score")
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = ["", " ", "\n", "a  b", "a   b \n c\n\n d", "don't IT'S", "  x  y", "İstanbul ΣΑΣ ΟΔΟΣ.", "é ́x",
       "<|endoftext|> <|startoftext|>", "\x1c a\x1d b\r\n c", "日本語 テスト 123 45", "🙂 👩‍👩‍👧 x", "²³ ½ x٣"]


def docs_of(spark, texts, ids=None, lang=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit(1) for c in CLASH})


def plain_rows(df):
    return [tuple(r) for r in df.collect()]


# --- chat formatting ------------------------------------------------------

NASTY = [r"\### Assistant: </turn> ok", "<turn user>x</turn>\n", r"<\turn", r"<\\/turn>", "<", "turn>", "&lt;", "", None,
         "a\nb", "<</turn>", "é🙂</turn", "x" * 5000]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in NASTY if t is not None], "t string")
    e = df.select("t", chat.escape_text(F.col("t")).alias("e")).withColumn("u", chat.unescape_text(F.col("e")))
    for t, e_, u in plain_rows(e):
        assert u == t and "<turn" not in e_ and "</turn" not in e_


def test_threads_match_brute_force(spark):
    rows = [(c, k, ("user", "assistant", "sys>&<", None)[k % 4], NASTY[(c + k) % len(NASTY)]) for c in range(4) for k in range(13)]
    rows += [(None, 0, "assistant", "no id"), (9, None, "user", "null turn"), (9, 1, "assistant", "a"), (9, 1, "assistant", "a")]
    got = {r["conv_id"]: r for r in chat.format_digest(chat.format_trees(chat.threads(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    ))).collect()}
    conv = collections.defaultdict(list)
    for c, k, role, text in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        conv[c].append((role or "", text or ""))
    assert set(got) == set(conv)
    for c, turns in conv.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), len(loss))


def test_reply_tree_paths_and_ranks(spark):
    #      1 - 2 - 4 (5.0)        6 - 7 - 6: a cycle, no root      8: its parent is unknown
    #        \ 3 - 5 (7.0)
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 2.0), ("t", 3, 1, 4.0), ("t", 4, 2, 2.0), ("t", 5, 3, 2.0),
            ("t", 6, 7, 1.0), ("t", 7, 6, 1.0), ("t", 8, 99, None), ("t", 5, 3, 2.0), ("u", 1, None, 0.0)]
    m = spark.createDataFrame([(a, b, c, "user", f"m{b}", s) for a, b, c, s in rows],
                              "tree string, node long, parent long, role string, text string, score double")
    found = {(r["tree"], r["leaf"]): r for r in chat.format_trees(m, top_k=None).collect()}
    assert {k: (r["branch_rank"], r["branch_score"], re.findall(r"m\d", r["formatted"])) for k, r in found.items()} == {
        ("t", 5): (1, 7.0, ["m1", "m3", "m5"]), ("t", 4): (2, 5.0, ["m1", "m2", "m4"]), ("t", 8): (3, 0.0, ["m8"]),
        ("u", 1): (1, 0.0, ["m1"])}
    assert {(r["tree"], r["leaf"]) for r in chat.format_trees(m, top_k=1).collect()} == {("t", 5), ("u", 1)}
    assert chat.format_trees(m.limit(0)).count() == 0


def test_long_conversation(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(700)]
    r = chat.format_digest(chat.format_trees(chat.threads(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()
    assert len(r) == 1 and r[0]["n_turns"] == 700
    assert r[0]["loss_sha256"] == hashlib.sha256("".join(t for *_, a, t in rows if a == "assistant").encode()).hexdigest()


# --- sharding -------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 25, 100, 1000, 4097])
def test_feistel_is_a_permutation(spark, n):
    got = sorted(r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 42)).collect())
    assert got == list(range(n))


def test_feistel_matches_plain_arithmetic(spark):
    n, keys, (a, b) = 1000, sharding.round_keys(42), sharding.domain(1000)

    def mix(v, k):
        x = (v + k) % sharding.PRIME * 1103515245 % sharding.PRIME
        x ^= x >> 15
        x = (x * 1812433253 + k) % sharding.PRIME
        return x ^ x >> 13

    def place(x):
        while True:
            left, right = x % a, x // a
            for i, k in enumerate(keys):
                left, right = ((left + mix(right, k)) % a, right) if i % 2 == 0 else (left, (right + mix(left, k)) % b)
            x = right * a + left
            if x < n:
                return x
    got = dict(plain_rows(spark.range(n).select("id", sharding.permute(F.col("id"), n, 42))))
    assert got == {x: place(x) for x in range(n)}


def test_document_shards(spark):
    texts = ["a", None, "", "é" * 10, LONG] + ["same"] * 45
    d = docs_of(spark, texts, ids=[None, 3, 3, *range(10, 12), *[7] * 45])
    rows = sharding.document_shards(d, 24).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {2, 3}
    again = sharding.document_shards(d.repartition(5), 24)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert sharding.document_shards(d.limit(0), 24).count() == 0


def test_write_shards(spark):
    placed = sharding.assign_shards(spark.range(100).withColumnRenamed("id", "doc_id"), ["doc_id"], 4)
    back = spark.read.parquet(sharding.write_shards(placed))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4


# --- SimHash --------------------------------------------------------------

def brute_fingerprint(text):
    import xxhash
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    texts = [*ODD, None, "one", "One TWO", "a b c", "a b c a b c a b c", "É B c \x0b d", LONG]
    got = dict(plain_rows(simhash.with_fingerprint(docs_of(spark, texts)).select("doc_id", simhash.hex16(F.col("fp")))))
    assert got == {i: f"{brute_fingerprint(t):016x}" for i, t in enumerate(texts)}


def brute_components(fps):
    fps = [int(f) & (1 << 64) - 1 for f in fps]
    group = list(range(len(fps)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_between_fingerprints_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 64, 60, dtype=np.uint64)]
    fps = set(base) | {0, (1 << 64) - 1, 1, 3, 7}
    for f in base:  # chains of steps of 1 to 4 bits
        for _ in range(4):
            f ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False))
            fps.add(f)
    crowd = base[0]  # a crowded cell: many variants within a few bits of one fingerprint
    for _ in range(400):
        fps.add(crowd ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
    fps = sorted(fps)
    links = simhash.fingerprint_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"))
    edges = plain_rows(links.distinct())
    assert all((a ^ b).bit_count() <= 2 if (a ^ b) >= 0 else ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
    found = dict(plain_rows(common.components(links, "a", "b", "t")))
    want = brute_components(fps)
    got = [found.get(signed(f), signed(f)) for f in fps]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_crowded_cells_are_streamed_in_pieces():
    import pandas as pd
    fps = np.arange(300, dtype=np.int64)
    rows = pd.DataFrame({"cell": [1, *[5] * 300, 6, 6], "fp": [9, *fps, 8, 9]})
    out = pd.concat(simhash._compare(iter([rows[i:i + 37] for i in range(0, len(rows), 37)])))
    assert set(out[out["b"].isna()]["a"]) == set(fps)
    assert set(map(tuple, out[out["b"].notna()].to_numpy())) == {(8, 9)}


def test_near_duplicates_and_drop(spark):
    texts = ["a b c d", "A B C D", None, "", " \t", LONG, LONG, "other words in here", None]
    d = docs_of(spark, texts, ids=[5, 4, 3, 2, None, 20, 20, 6, 3])
    rows = simhash.near_duplicates(d).select("doc_id", "component_id").collect()
    assert sorted(map(str, rows)) == sorted(f"Row(doc_id={a}, component_id={b})" for a, b in [
        (5, 4), (4, 4), (3, 2), (2, 2), (None, 2), (20, 20), (20, 20), (6, 6), (3, 2)])
    kept = simhash.drop_near_duplicates(d)
    assert kept.columns == d.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["20", "4", "6", "None"]
    assert simhash.drop_near_duplicates(d.limit(0)).count() == 0


# --- WARC -----------------------------------------------------------------

def test_warc_round_trip(spark):
    big, other = "<p>" + "x" * 1000, "é" * 500
    pages = [(1, "http://a/ b\r\nc", "<html>1"), (2, None, None), (3, "u", ""), (4, "u", big), (5, "u", big), (6, "u", big),
             (7, "u", other), (8, "u", "y" * 999), (9, "u", "y" * 999), (None, "u", other), (10, "u", LONG)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    folder = common.fresh_path(spark, "warc-test")
    got = {r["page_id"]: r for r in warc.read_archives(warc.write_archives(df.repartition(3), folder), folder).collect()}
    assert len(got) == len(pages)
    top = {big: 6, other: 7}
    for page, _, html in pages:
        body, r = (html or "").encode(), got[page]
        revisit = html in top and page != top[html]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (top[html] if revisit else None)
    empty = warc.write_archives(df.limit(0))
    assert empty.count() == 0 and warc.read_archives(empty, folder).count() == 0


def archive(records, dictionary=b""):
    out = io.BytesIO()
    w = warc.ArchiveWriter(out, dictionary)
    for r in records:
        w.add(r)
    return out.getvalue()


def test_archive_reader_checks():
    import zstandard
    bodies = [b"<html>%d common words here</html>" % i * 20 for i in range(300)]
    dictionary = zstandard.train_dictionary(2048, bodies).as_bytes()
    records = [warc.make_record(i, "u", b, hashlib.sha1(b).hexdigest(), None) for i, b in enumerate(bodies)]
    data = archive(records, dictionary)
    assert data[:4] == warc.SKIPPABLE and list(warc.read_archive(io.BytesIO(data), piece=100)) == records
    assert list(warc.read_archive(io.BytesIO(archive(records)))) == records  # no dictionary
    raw = warc.SKIPPABLE + len(dictionary).to_bytes(4, "little") + dictionary  # a dictionary that is not compressed
    size = 8 + int.from_bytes(data[4:8], "little")
    assert list(warc.read_archive(io.BytesIO(raw + data[size:]))) == records
    for cut in (10, size - 1, len(data) - 5):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(data[:cut])))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(data + b"junk")))


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"HTTP/1.1"), (b"WARC-Type", b"X-Type"), (b"Content-Length: 1", b"Content-Length: 2"),
    (b"\r\n\r\n<p>", b"\r\n\r\n<q>"), (b"WARC-Date: ", b"WARC-Date "), (b"sha1:", b"md5:"), (b"WARC-Date", b"WARC-Type")])
def test_record_checks(change):
    body = b"<p>" + b"z" * 50
    record = warc.make_record(1, "u", body, hashlib.sha1(body).hexdigest(), None)
    headers, block = warc.parse_record(record)
    assert warc.payload_facts(headers, block) == (len(body), hashlib.sha1(body).hexdigest())
    with pytest.raises(warc.WarcError):
        headers, block = warc.parse_record(record.replace(*change, 1))
        warc.payload_facts(headers, block)


# --- language ID ----------------------------------------------------------

VOCAB = {"aa": "lorem ipsum dolor amet sit elit sed".split(), "bb": "zwisch kraut pfund schtz oder grund".split(),
         "cc": "queux aille ment ouvre eau".split()}


def sentence(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang]) + rng.choice(VOCAB[lang])[:3] for _ in range(n))


@pytest.fixture(scope="module")
def lid():
    rng = np.random.default_rng(5)
    langs = ["aa", "bb", "cc"] * 40
    return langid.fit([sentence(rng, x, 60) for x in langs], langs), rng


def test_language_accuracy_and_code_switching(lid):
    model, rng = lid
    langs = ["aa", "bb", "cc"] * 20
    got = langid.label_texts([sentence(rng, x, 30) for x in langs], model)
    assert [g[0] for g in got] == langs and all(0 < g[1] <= 1 for g in got)
    mixed = sentence(rng, "aa", 40) + " " + sentence(rng, "cc", 60)
    (best, score, runs), = langid.label_texts([mixed], model, spans=True)
    assert best == "cc" and 0.5 < score < 0.7 and [r[0] for r in runs] == ["aa", "cc"] and abs(runs[1][1] - 40) <= 2
    assert (np.diag(model.move) > model.move.mean(axis=1)).all()


def test_forward_backward_matches_brute_force():
    rng = np.random.default_rng(1)
    lengths = np.array([5, 0, 1, 64, 65, 200, 128])
    scores, move = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got, at = langid.marginals(scores, lengths, move), 0
    for n in lengths:
        e, t = np.exp(scores[at:at + n]), np.exp(move)
        a, b = np.ones((n, 3)), np.ones((n, 3))
        for i in range(n):
            a[i] = e[i] * (t.sum(axis=0) if i == 0 else a[i - 1] @ t)
            a[i] /= a[i].sum()
        for i in range(n - 2, -1, -1):
            b[i] = t @ (e[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        if n:
            want = a * b / (a * b).sum(axis=1, keepdims=True)
            assert np.allclose(got[at:at + n], want)
        at += n


def test_language_edge_cases(spark, lid):
    model, rng = lid
    texts = [None, "", "123 !?", "«»", "日本", sentence(rng, "aa", 20_000), sentence(rng, "bb", 1), "x" * 300_000]
    d = docs_of(spark, texts)
    rows = langid.identify(d, model, spans=True)
    assert rows.columns == d.columns  # a clashing name is replaced
    got = {r["doc_id"]: r["language"] for r in rows.select("doc_id", "language").collect()}
    assert [got[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and got[0]["score"] == 0.0
    assert got[4]["lang_pred"] in model.labels and got[5]["lang_pred"] == "aa" and got[6]["lang_pred"] == "bb"
    nothing = langid.train(d.select("lang", "text"))  # no label at all
    assert {r[0] for r in langid.identify(d, nothing).select("language.lang_pred").collect()} == {"und"}
    assert langid.identify(d.limit(0), model).count() == 0


def test_even_mixtures_stay_in_the_pipeline(spark):
    import corpus_pipeline
    rng = np.random.default_rng(15)
    langs = [list(VOCAB)[i % 3] for i in range(150)]
    rows = [(i, sentence(rng, x, 40), x, "s", 0) for i, x in enumerate(langs)]
    rows += [(900, " ".join(sentence(rng, x, 40) for x in VOCAB), None, "s", 0), (901, "12 --", None, "s", 0)]
    left = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, DOC), "").collect()
    assert {r["doc_id"] for r in left} == {r[0] for r in rows} - {901}


def test_language_contract(spark):
    rng = np.random.default_rng(9)
    langs = [list(VOCAB)[i % 3] for i in range(150)]
    rows = [(i, sentence(rng, x, 40), x) for i, x in enumerate(langs)] + [(200, None, "aa"), (201, "...", "bb"), (None, "kraut", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = langid.predict_languages(df).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held if r["doc_id"] < 150) >= 0.95 * len([r for r in held if r["doc_id"] < 150])
    # copies of one text do not crowd the sample
    many = df.filter("lang = 'aa'").limit(1).select("text").crossJoin(spark.range(500)).select("text", F.lit("aa").alias("lang"))
    assert langid.training_sample(many.union(df.select("text", "lang")), limit=10).groupBy("lang").count().agg(
        F.max("count")).first()[0] <= 10


# --- decontamination ------------------------------------------------------

def brute_contamination(docs, bench):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = collections.defaultdict(set)
    for item, t in bench:
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(item)
    out = []
    for doc, t in docs:
        w, hit, items = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if found := grams.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(map(str, items - {None}))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items - {None}), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(10, " ".join(f"q{i}" for i in range(25))), (9, " ".join(f"q{i}" for i in range(10))), (2, "Alpha, BETA!"), (3, None),
         (4, "..."), (5, "Été is A b c d e f g h"), (2, "Alpha beta"), (None, "lone item")]


def contaminated_texts():
    q = " ".join(f"Q{i}" for i in range(25))
    return [None, "", "...", "x " + q + " y", q.replace(" ", ", "), "alpha beta alpha beta", "alpha-beta", "alpha xbeta",
            "Été IS a b c d e f g h", "été is a b c d e f g h", " ".join(f"q{i}" for i in range(3, 14)),
            "a lone item", LONG + " alpha beta " + LONG, "clean words only", "clean words only"]


@pytest.mark.parametrize("block", [decontam.BLOCK, 4])
def test_contamination_matches_brute_force(spark, monkeypatch, block):
    texts = contaminated_texts()
    monkeypatch.setattr(decontam.find_hits, "__defaults__", (10, "doc_id", block))
    ids = [*range(len(texts) - 2), 50, 50]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("h", F.lit(1))
    got = plain_rows(decontam.contamination(docs_of(spark, texts, ids), bench))
    assert sorted(got, key=str) == brute_contamination(list(zip(ids, texts)), ITEMS)


def test_remove_documents_and_spans(spark):
    texts = contaminated_texts()
    d = docs_of(spark, texts)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = {r[0] for r in brute_contamination(list(enumerate(texts)), ITEMS) if r[-1]}
    left = decontam.remove_contaminated(d, bench)
    assert left.columns == d.columns and {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - bad
    spans = decontam.remove_spans(d, bench)
    cut = {r["doc_id"]: r["text"] for r in spans.collect()}
    assert spans.columns == d.columns and all(cut[i] == texts[i] for i in cut if i not in bad)
    assert cut[3].split() == ["x", "y"] and not any(r[-1] for r in brute_contamination(list(cut.items()), ITEMS))
    assert decontam.remove_contaminated(d, bench.limit(0)).count() == len(texts)
    assert decontam.contamination(d.limit(0), bench).count() == 0


def test_what_is_broadcast_of_a_benchmark_is_small(spark):
    """Only narrow masks are broadcast, 64 bits for two windows, never the words
    of a benchmark that is not small."""
    n = 60_000
    bench = spark.range(n).select(F.col("id").alias("item_id"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(10)), lambda k: F.concat(F.lit("w"), F.col("id") * 10 + k)), " ").alias("text"))
    grams = decontam.benchmark_windows(bench)
    masks = decontam.window_filter(grams, n // 2)
    assert masks.dtypes == [("slot", "bigint"), ("mask", "bigint")] and masks.count() <= n // 2
    texts = [f"x {bench.filter('item_id = 59999').first()['text']} y", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w11", "nothing " * 40]
    hits = decontam.find_hits(docs_of(spark, texts), bench)
    assert "strategy=broadcast" not in hits._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: [(h["pos"], h["len"], h["items"]) for h in r["hits"]] for r in hits.collect()} == {
        0: [(1, 10, [59999])], 1: [], 2: []}


# --- token counts ---------------------------------------------------------

@pytest.fixture(scope="module")
def byte_code():
    return Encoder("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    code, rng = Encoder(name), np.random.default_rng(2)
    parts = ["a", "b", " ", "  ", "\n", "'", "'re", "1", "é", "日", "!", "…", " the", "\t", " ", "́", "Σ", "İ"]
    texts = [*ODD, LONG[:5000], *("".join(rng.choice(parts, 40)) for _ in range(300))]
    for t in texts:
        want = code.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(code.ids(t), "<u4").tolist() == want, repr(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_library_reads_them(name):
    import public_tokenizers
    import tokenizers
    library, code = tokenizers.Tokenizer.from_file(public_tokenizers.path(name)), Encoder(name)
    rng = np.random.default_rng(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "|>", "<|ENDOFTEXT|>", "a", " ", "  ", "\n", "'", "é", "́", "Σ", "!"]
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a  <|endoftext|>  b", *("".join(rng.choice(parts, 25)) for _ in range(300))]
    for t in texts:
        assert np.frombuffer(code.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_edits_make_and_break_added_tokens(byte_code):
    import public_tokenizers
    import tokenizers
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(5)
    parts = ["<|endoftext|>", "<|endof", "text|>", "<|", "|>", ">", "end", "a ", "  ", "!!", "\n"]
    for _ in range(150):
        tree = tokencount.CountTree("".join(rng.choice(parts, 200)), byte_code)
        for _ in range(8):
            at = int(rng.integers(0, len(tree.text) + 1))
            tree.edit(at, int(rng.choice([0, 1, 2, 9])), "".join(rng.choice(parts, rng.integers(0, 3))))
            assert tree.total == len(library.encode(tree.text, add_special_tokens=False).ids)


def test_edited_trees_equal_full_encoding(byte_code):
    rng = np.random.default_rng(4)
    parts = ["a", "b", " ", "  ", "\n", "'", "'re", "'s", "1", "é", "日", "!", " the", "\t", "x y z", "word " * 300]
    for t in ["", LONG[:20_000], *("".join(rng.choice(parts[:-1], rng.integers(0, 300))) for _ in range(60))]:
        tree = tokencount.CountTree(t, byte_code)
        for _ in range(8):
            n = len(tree.text)
            tree.edit(int(rng.integers(-1, n + 3)), int(rng.choice([0, 1, 2, 40, n])), "".join(rng.choice(parts, rng.integers(0, 30))))
            tree = tokencount.CountTree(tree.text, byte_code, tree.chars, tree.tokens)
            assert tree.total == len(byte_code.tokenizer.encode(tree.text, add_special_tokens=False).ids)
            assert tree.chars[1] == len(tree.text)


def test_small_edit_encodes_little(byte_code):
    tree = tokencount.CountTree(LONG, byte_code)
    tree.encoded = 0
    tree.edit(200_000, 3, "new")
    assert 0 < tree.encoded <= 3 * tokencount.LEAF


def test_counts_and_edits_tables(spark, byte_code):
    texts = [None, "", "hello world", LONG, "same", "same"]
    d = docs_of(spark, texts, ids=[1, 2, 3, 4, 5, 5])
    state = common.written(tokencount.build_state(d), "t")
    edits = spark.createDataFrame([(3, 2, 0, 5, "bye"), (3, 1, 5, 1, "  "), (1, 1, 9, 9, "new text"), (2, 1, None, None, None),
                                   (5, 1, 4, 0, "!"), (77, 1, 0, 0, "x")], "doc_id long, seq int, start int, length int, new string")
    got = sorted((r["doc_id"], r["text"], r["n_tokens"], r["n_edits"]) for r in tokencount.apply_edits(state, edits).collect())
    want = [(1, "new text"), (2, ""), (3, "bye  world"), (4, LONG), (5, "same!"), (5, "same!")]
    assert got == [(i, t, len(byte_code.ids(t)) // 4, {3: 2, 4: 0}.get(i, 1)) for i, t in want]
    assert tokencount.build_state(d.limit(0)).count() == 0


# --- packing --------------------------------------------------------------

def test_packing_places_every_id_once(spark, byte_code):
    rng = np.random.default_rng(8)
    texts = [None, "", LONG, *["same text"] * 40, *(" ".join(["tok"] * int(n)) for n in rng.integers(1, 1500, 150))]
    d = docs_of(spark, texts)
    rows = packing.pack(d, with_ids=True)
    out = rows.collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append((r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"]
    for i, t in enumerate(texts):
        ids = byte_code.ids(t) + b"\0\0\0\0"
        assert b"".join(p[2] for p in sorted(by_doc[i])) == ids and {p[3] for p in by_doc[i]} == {len(ids) // 4}
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in out)
    assert len(by_seq) <= total / 1024 * 1.02 + 2
    seqs = packing.sequences(rows).collect()
    assert sum(s["n_tokens"] for s in seqs) == total
    assert all(len(s["ids"]) == 4 * (s["n_tokens"] if s["n_tokens"] & s["n_tokens"] - 1 == 0 else 1024) for s in seqs)
    assert packing.pack(d.limit(0)).count() == 0


def test_pieces_are_read_from_written_token_rows(spark, byte_code, monkeypatch):
    texts = [None, "", LONG, "a <|endoftext|> b", *[f"text {i} " * (i % 90) for i in range(120)]]
    d = docs_of(spark, texts, ids=[None, *range(1, len(texts))])
    want = packing.pack(d).collect()
    got = packing.pack_and_read(d, with_ids=True)
    assert got.columns == [*packing.pack(d).columns, "ids"]
    assert sorted(map(repr, plain_rows(got.drop("ids")))) == sorted(repr(tuple(r)) for r in want)
    by_doc = collections.defaultdict(bytes)
    for r in sorted(got.collect(), key=lambda r: r["start"]):
        by_doc[r["doc_id"]] += bytes(r["ids"])
    assert all(by_doc[i or None] == byte_code.ids(t) + b"\0\0\0\0" for i, t in enumerate(texts))
    # the registered query reads what was written: other rows there give other digests
    def spoiled(df, name, **options):
        out = common.written(df, name, **options)
        return out.withColumn("ids", F.reverse(F.col("ids").cast("string")).cast("binary")) if name == "pack-sequences" else out
    monkeypatch.setattr(packing, "written", spoiled)
    from basketry.llm.queries import QUERIES
    monkeypatch.setattr("basketry.llm.queries.table", lambda *a: d)
    bad = QUERIES["op8_pack_sequences"](spark, "")
    assert sorted(r["ids_crc32"] for r in bad.collect()) != sorted(r["ids_crc32"] for r in want)


@pytest.mark.parametrize("demand", [{128: 7}, {1: 5}, {65: 100, 63: 99}, {c: 1000 + c for c in range(1, 129)},
                                    {43: 1_000_000, 42: 3, 1: 10}, {90: 10, 38: 10, 19: 21}])
def test_patterns_cover_the_histogram(demand):
    patterns = packing.plan_patterns(demand, 128)
    used = collections.Counter()
    for counts, times in patterns:
        assert sum(c * a for c, a in counts.items()) <= 128
        for c, a in counts.items():
            used[c] += a * times
    assert used == demand
    least = -(-sum(c * n for c, n in demand.items()) // 128)
    big = sum(n for c, n in demand.items() if c > 64)
    third = -(-sum(n for c, n in demand.items() if c > 42) // 2)
    assert sum(t for _, t in patterns) <= max(least, big, third) * 1.01 + len(demand)


# --- token-id files -------------------------------------------------------

@pytest.mark.parametrize("bits", [False, True])
def test_plane_files(bits):
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, m, n).astype("<u4") for m, n in ((1, 1), (50_000, 300), (70_000, 5), (2**32, 9), (10, 0))]
    out = io.BytesIO()
    w = tokenfile.PlaneWriter(out, bits, chunk=64)
    for i, x in enumerate(docs):
        w.add(None if i == 3 else i, x.tobytes())
    w.close()
    r = tokenfile.PlaneReader(io.BytesIO(out.getvalue()))
    assert np.concatenate([r.chunk(k) for k in range(len(r.index["chunks"]))]).tolist() == np.concatenate(docs).tolist()
    starts = np.cumsum([0, *map(len, docs)])
    assert list(r.documents()) == [(len(x), int(s), zlib.crc32(x.tobytes())) for x, s in zip(docs, starts)]
    assert r.nulls.tolist() == [False, False, False, True, False]
    damaged = bytearray(out.getvalue())
    damaged[len(tokenfile.MAGIC) + 12] ^= 255
    with pytest.raises(Exception):
        list(tokenfile.PlaneReader(io.BytesIO(bytes(damaged))).documents())
    with pytest.raises(ValueError):
        tokenfile.PlaneReader(io.BytesIO(out.getvalue()[:-1]))


def test_token_files_round_trip(spark):
    code = Encoder("word_bpe_49k.json")
    texts = [*ODD, None, LONG, "dup", "dup"]
    ids = [*range(100, 100 + len(ODD)), None, 5, 7, 7]
    d = docs_of(spark, texts, ids).repartition(4)
    folder = common.fresh_path(spark, "ids-test")
    got = sorted(plain_rows(tokenfile.read_files(tokenfile.write_files(d, folder=folder), folder)), key=lambda r: r[1])
    at, want = 0, []
    for i, t in sorted(zip(ids, texts), key=lambda x: -1 if x[0] is None else x[0]):
        data = code.ids(t) + b"\1\0\0\0"
        want.append((i, at, len(data) // 4, zlib.crc32(data)))
        at += len(data) // 4
    assert got == want
    assert tokenfile.read_files(tokenfile.write_files(d.limit(0)), folder).count() == 0


# --- embeddings -----------------------------------------------------------

def brute_links(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v is not None
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = np.zeros((len(ok), len(ok)), bool)
    for d in {len(rows[i][1]) for i in ok}:
        at = np.array([k for k, i in enumerate(ok) if len(rows[i][1]) == d])
        x = np.array([rows[ok[k]][1] for k in at], dtype=np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near[np.ix_(at, at)] = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    group = np.arange(len(ok))
    while True:
        new = np.array([min(g, group[near[i]].min(initial=10**9)) for i, g in enumerate(group)])
        if (new == group).all():
            break
        group = new
    out = {i: (r[0], 0, r[0]) for i, r in enumerate(rows)}
    for k, i in enumerate(ok):
        out[i] = (rows[i][0], int(near[k].sum()), min(rows[ok[j]][0] for j in np.flatnonzero(group == group[k])))
    return sorted((a, b, c, a == c) for a, b, c in out.values())


@pytest.mark.parametrize("block, rare", [(embeddings.BLOCK, embeddings.RARE), (16, 20)])
def test_embedding_links_match_brute_force(spark, monkeypatch, block, rare):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "RARE", rare)
    monkeypatch.setattr(embeddings, "KEY_BITS", (3, 28))  # eight dimensions: enough tables of three bits
    monkeypatch.setattr(embeddings, "ROTATIONS", 16)
    monkeypatch.setattr(embeddings.learn_rotations, "__defaults__", (16, 20, 11))
    rng = np.random.default_rng(12)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(150)]
    rows += [(200 + i, [float(np.float32(x + rng.normal() * 0.02)) for x in rows[3][1]]) for i in range(90)]  # a crowd
    rows += [(400 + i, list(rows[5][1])) for i in range(30)]  # copies
    rows += [(500, [2 * x for x in rows[7][1]]), (501, None), (502, [0.0] * 8), (503, [float("nan")] * 8), (504, [None] * 8),
             (505, [1.0]), (506, []), (507, [float("inf")] + [0.0] * 7), (508, [-0.0] + rows[9][1][1:]), (509, [0.0] + rows[9][1][1:])]
    rows += [(600 + i, [float(np.float32(x)) for x in rng.normal(size=2)]) for i in range(60)]  # other lengths, one frequent
    rows += [(700, [3.0, 4.0]), (701, [3.0, 4.0]), (702, [6.0, 8.0]), (710, [1.0] * 5), (711, [2.0] * 5), (712, [-1.0] * 5), (713, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cls", F.lit(1)).withColumn("n", F.lit(2))
    got = plain_rows(embeddings.near_duplicates(df))
    assert sorted(got) == brute_links(rows)


@pytest.mark.parametrize("width", [17, 20, 24])
def test_long_keys_find_pairs_at_the_threshold(monkeypatch, width):
    """Production parameters, keys as long as on tables of millions of rows."""
    monkeypatch.setattr(embeddings, "KEY_BITS", (width, width))
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sample, a = (unit(rng.normal(size=(embeddings.SAMPLE, 64))) for _ in range(2))
    away = rng.normal(size=a.shape)
    away = unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    b = 0.951 * a + np.sqrt(1 - 0.951 ** 2) * away
    mean, rotation, used, reach = embeddings.learn_tables(sample, 1 << (width + 4), 0.95)
    ka, kb = (embeddings.table_keys(x, mean, rotation, used) for x in (a, b))
    recall = (ka == kb).any(axis=1).mean()
    assert used == width and recall >= 0.998
    ca, cb = (embeddings.codes(x, mean, rotation) for x in (a, b))
    assert (embeddings.code_keys(ca, used, rotation.shape[1]) == ka).all()
    apart = np.bitwise_count(ca ^ cb).sum(axis=1)
    assert (apart <= reach).mean() >= 0.9999  # the filter on codes loses no pairs worth speaking of
    strangers = np.bitwise_count(ca ^ np.roll(cb, 1, axis=0)).sum(axis=1)
    assert (strangers <= reach).mean() < 0.01


@pytest.mark.parametrize("dim", [1, 2, 3])
def test_short_vectors_have_tables(dim):
    rng = np.random.default_rng(7)
    sample = rng.normal(size=(300, dim))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    mean, rotation, width, _ = embeddings.learn_tables(sample, len(sample), 0.95)
    keys = embeddings.table_keys(sample, mean, rotation, width)
    near = sample @ sample.T >= 0.95
    assert (keys[:, None] == keys[None]).any(axis=2)[near].mean() >= 0.998


def test_embeddings_without_usable_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")
    assert sorted(plain_rows(embeddings.near_duplicates(df))) == [(1, 0, 1, True), (2, 0, 2, True)]
    zero = spark.createDataFrame([(1, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert plain_rows(embeddings.near_duplicates(zero)) == [(1, 0, 1, True)]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


# --- components -----------------------------------------------------------

def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (500, 499)]
    got = dict(plain_rows(common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b", "t")))
    assert got == {**{i: 0 for i in range(61)}, **{1000 + k: 1000 for k in range(50)}, 500: 499, 499: 499}
    assert common.components(spark.createDataFrame([], "a long, b long"), "a", "b", "t").count() == 0


# --- names and keys that clash or are null --------------------------------

def test_null_trees_and_nodes_are_formatted(spark):
    rows = [(None, 1, None, "user", "a", 1.0), (None, 2, 1, "assistant", "b", 1.0),
            ("t", None, None, "user", "null node", 5.0), ("t", 7, None, "user", "c", 1.0), ("t", 8, 7, "assistant", "d", 1.0),
            ("u", 1, None, "user", "e", 0.0), ("u", None, 1, "assistant", "f", 1.0), ("u", 3, 1, "assistant", "g", 3.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["leaf"]): (r["branch_rank"], [t["text"] for t in r["turns"]]) for r in
           chat.format_trees(df, top_k=None).withColumn("turns", chat.parse_chat(F.col("formatted"))).collect()}
    assert got == {(None, 2): (1, ["a", "b"]), ("t", None): (1, ["null node"]), ("t", 8): (2, ["c", "d"]),
                   ("u", 3): (1, ["e", "g"]), ("u", None): (2, ["e", "f"])}
    assert {(r["tree"], r["leaf"]) for r in chat.format_trees(df).collect()} == {(None, 2), ("t", None), ("u", 3)}
    paths = chat.reply_paths(df, None)
    assert paths.columns == ["tree", "leaf", "branch_rank", "branch_score", "node", "up"] and paths.count() == 9


def test_shards_keep_columns_of_clashing_names(spark):
    names = ["_part", "_tie", "_local", "_n", "_before", "row_number", "position", "shard", "SLOT"]
    df = spark.range(30).select("id", *[F.col("id").alias(c) for c in names])
    out = sharding.assign_shards(df, ["id"], 4)
    assert out.columns == ["id", *names[:6], "_position", "_shard", "_SLOT", "position", "shard", "slot"]
    plain = {r["id"]: (r["position"], r["shard"], r["slot"]) for r in sharding.assign_shards(spark.range(30), ["id"], 4).collect()}
    for r in out.collect():
        assert all(r[c] == r["id"] for c in out.columns[1:10]) and tuple(r[c] for c in ("position", "shard", "slot")) == plain[r["id"]]


def test_fingerprint_keeps_a_column_of_its_name(spark):
    df = spark.createDataFrame([("a b c", 5, 6)], "text string, fp long, _fp long")
    r = simhash.with_fingerprint(df).first().asDict()
    assert r == {"text": "a b c", "__fp": 5, "_fp": 6, "fp": r["fp"]} and r["fp"] & (1 << 64) - 1 == simhash.fingerprint("a b c")


def test_token_files_refuse_ids_that_are_no_integers(spark):
    with pytest.raises(TypeError):
        tokenfile.write_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_language_sample_is_bounded_in_bytes(spark):
    rows = [(lang, f"{lang} {i} " + "x" * 100) for lang in "ab" for i in range(50)] + [("a", "y" * 5000), ("c", "z" * 9000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = langid.training_sample(df, limit=20).collect()
    assert sorted(r["lang"] for r in got).count("a") == 20 and len(got) == 41
    got = langid.training_sample(df, limit=40, most_bytes=6000).collect()
    assert {r["lang"] for r in got} == {"a", "b"} and sum(len(r["text"]) for r in got) <= 4000 and len(got) > 30


def test_pretokens_below_u0250_split_as_the_library_does():
    """The pattern of plain classes against the general one and the library."""
    from basketry.llm import encode
    code = encode.encoder("byte_bpe_50k.json")
    rng = random.Random(11)
    low = [chr(c) for c in range(0x250)]
    texts = ["".join(rng.choices(low, k=40)) for _ in range(500)] + [a + " " + a + "b" + a for a in low]
    texts += ["".join(rng.choices("ab '.,\n\t 1é²s ", k=25)) for _ in range(500)]
    for text in texts:
        assert encode._NEAR_BYTE.findall(text) == code.split.findall(text), repr(text)
        ids = np.array(code.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert code.ids(text) == ids, repr(text)

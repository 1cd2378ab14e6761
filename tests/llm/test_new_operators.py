"""R-tree hard negatives, prefix trie and toxicity against brute-force
versions, with nulls, ties, repeated rows, long inputs and empty tables."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import prefixtrie, rtree, toxicity
from basketry.llm.queries import QUERIES

#: names that operators use for themselves
CLASH = ("ref", "slab", "d", "anchor", "k1", "path", "at", "shard", "row_number", "_part", "_tie", "toxicity", "score")


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in CLASH})


# --- hard negatives -------------------------------------------------------

EMB = "vec_id long, embedding array<float>, label int"


def brute_negatives(rows):
    ok = [(i, (l + 1) % 10 if i % 7 == 0 else l, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, l in rows
          if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (aid, al, av) in enumerate(ok):
        if aid % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(av, v)), i, l) for k, (i, l, v) in enumerate(ok) if k != a and len(v) == len(av)]
        for s, pid, _ in sorted((s, i, l) for s, i, l in scored if l == al)[:5]:
            hard = sorted((t, i) for t, i, l in scored if l != al and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(aid, pid, r + 1, i, -s, -t) for r, (t, i) in enumerate(hard)]
    return sorted(out)


def odd_vectors():
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=6).round(1).tolist(), int(rng.integers(0, 3))) for i in range(200)]
    rows += [(i, [1.0] * 6, i % 2) for i in range(200, 260)]  # many ties
    rows += [(50, rng.normal(size=6).tolist(), 1), (50, [0.0] * 6, 1), (100, [1.0, 2.0], 0), (150, [2.0, 1.0], 1), (151, [1.0, 1.0], 1),
             (350, [], 1), (351, [], 1), (352, [], 2), (None, [1.0] * 6, 1), (400, None, 1), (450, [1.0, None], 1),
             (500, [1.0] * 5 + [float("nan")], 1), (550, [float("inf")] * 6, 1), (600, [1.0] * 6, None), (-50, [1.0] * 6, 1),
             (300, [1.0] * 6, 1), (300, [1.0] * 6, 1)]
    return rows


@pytest.mark.parametrize("shard_rows", [None, 70])
def test_hard_negatives_match_brute_force(spark, shard_rows, monkeypatch):
    if shard_rows:
        monkeypatch.setattr(rtree, "SHARD_ROWS", (shard_rows, shard_rows))
        monkeypatch.setattr(rtree, "ANCHORS", 3)
    rows = odd_vectors()
    got = rtree.hard_negatives(clashing(spark.createDataFrame(rows, EMB)))
    assert [f for f, _ in got.dtypes] == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    for rows in ([], [(1, [1.0], 1)], [(50, [1.0], 1)]):
        assert rtree.hard_negatives(spark.createDataFrame(rows, EMB)).collect() == []


def test_score_that_does_not_fit_fails(spark):
    rows = [(50, [1e30], 1), (51, [1.0], 1)]
    with pytest.raises(Exception, match="32 bits"):
        rtree.hard_negatives(spark.createDataFrame(rows, EMB)).collect()


def test_boxes_bound_every_score_and_pages_cover_all_rows():
    rng = np.random.default_rng(1)
    q = rng.integers(-300, 300, (1000, 5))
    order = rtree.str_order(q)
    assert sorted(order) == list(range(1000))
    tree = rtree.Tree(q[order], order, order % 3, order)
    a = rng.integers(-300, 300, 5)
    for level, (lo, hi, *_) in enumerate(tree.levels):
        step = rtree.LEAF * rtree.FANOUT ** level
        for k in range(len(lo)):
            s = tree.q[k * step:(k + 1) * step] @ a
            assert np.minimum(a * lo[k], a * hi[k]).sum() <= s.min() and s.max() <= np.maximum(a * lo[k], a * hi[k]).sum()


def test_search_leaves_most_pages_out():
    rng = np.random.default_rng(2)
    q = rng.integers(-1000, 1000, (20_000, 2))
    order = rtree.str_order(q)
    tree = rtree.Tree(q[order], order, np.zeros(len(q), np.int64), order)
    seen = []
    best = rtree.Best(1, 3)
    a = np.array([[700, 300]])
    rtree.search(tree, a, np.array([0]), best, lambda w, *_: np.ones(len(w), bool),
                 lambda w, rows, score: seen.append(len(rows)) or np.ones(score.shape, bool))
    want = sorted(zip(-(q @ a[0]), range(len(q))))[:3]
    assert list(zip(-best.score[0], best.id[0])) == want and sum(seen) < 2000


# --- prefix trie ----------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = collections.defaultdict(list)
    sha = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (-10 ** 9 if r[1] is None else r[1], sha(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    ids = {(): 0}
    members, parent, ends = collections.defaultdict(list), {}, collections.defaultdict(list)
    for c in sorted(built):
        node = 0
        members[0].append(c)
        for k, t in enumerate(built[c]):
            child = ids.setdefault((node, t), len(ids))
            parent[child], node = (node, t), child
            members[node].append(c)
        ends[node].append(c)
    kids = collections.defaultdict(list)
    for child, (up, _) in parent.items():
        kids[up].append(child)
    leaves, saved, depth = {}, {}, {0: 0}
    for n in sorted(members):
        if n:
            depth[n] = depth[parent[n][0]] + 1
    for n in sorted(members, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", parent[n][1][1])) if n else 0
        leaves[n] = sum(leaves[k] for k in kids[n]) + (not kids[n])
        saved[n] = sum(saved[k] for k in kids[n]) + (len(members[n]) - 1) * words
    return sorted((members[n][0], depth[n], members[parent[n][0]][0] if n else None, len(members[n]), len(kids[n]), leaves[n],
                   saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def odd_conversations():
    r = random.Random(3)
    text = ["", None, "a b", "a  b\tc\x0b d", "ä b", "x" * 3000]
    rows = [(c, t, r.choice(["user", None]), r.choice(text)) for c in range(90) for t in range(r.choice([1, 1, 2, 3, 5]))]
    rows += [(c, t, "user", f"same {t % 3}") for c in range(100, 140) for t in range(6)]  # copies
    rows += [(c, t, "user", f"long {min(t, 200)} " + "w " * (c == 7000 and t > 60)) for c in (7000, 7020, 7040) for t in range(300)]
    rows += [(5, None, None, "null turn"), (5, 0, "user", "tie"), (5, 0, "user", "tie"), (None, 0, "user", "none"), (-40, 0, "u", "n")]
    return rows


@pytest.mark.parametrize("piece, shard", [(prefixtrie.PIECE, prefixtrie.SHARD), (150, 40)])
def test_trie_matches_brute_force(spark, piece, shard):
    rows = odd_conversations()
    got = prefixtrie.conversation_trie(clashing(spark.createDataFrame(rows, CONV)), piece, shard)
    assert got.columns == ("conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256").split()
    assert ordered(got.collect()) == ordered(brute_trie(rows))


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefixtrie.conversation_trie(spark.createDataFrame([], CONV)).collect() == []
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    rows = [(turnless, 0, "user", "only")]
    assert [tuple(r) for r in prefixtrie.conversation_trie(spark.createDataFrame(rows, CONV)).collect()] == brute_trie(rows)


def test_prefix_keys_do_not_depend_on_blocks(spark):
    turns = spark.createDataFrame([(c, k + 1, k % 5, c % 2, 1) for c in range(4) for k in range(40)],
                                  "conv long, at long, t1 long, t2 long, words long")
    keys = [sorted(map(tuple, prefixtrie.prefix_rows(turns, block).collect())) for block in (3, 4096)]
    assert keys[0] == keys[1]
    assert len({r[5:7] for r in keys[0]}) == 80  # conversations 0, 2 and 1, 3 are alike


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 50_000):
        k1, k2 = rng.integers(-2 ** 62, 2 ** 62, (2, n))
        t = prefixtrie.PerfectHash(k1, k2)
        assert sorted(t.find(k1, k2)) == list(range(n))
        assert (t.find(k1 + 1, k2) == -1).all()
    with pytest.raises(ValueError, match="distinct"):
        prefixtrie.PerfectHash(np.zeros(2, np.int64), np.zeros(2, np.int64))


def test_two_prefixes_with_one_key_fail(spark):
    rows = spark.createDataFrame([(1, 1, 2, 1, 5, 5, 0, 0, 9, 9), (2, 1, 1, 1, 5, 5, 0, 0, 8, 8)],
                                 "path long, copies long, at long, words long, k1 long, k2 long, p1 long, p2 long, t1 long, t2 long")
    with pytest.raises(Exception, match="two prefixes share a key"):
        prefixtrie._distinct_nodes(rows, []).collect()


# --- toxicity -------------------------------------------------------------

def planted(n, seed, bad=("vrakol", "zuntiq")):
    r = random.Random(seed)
    syl = "ta re mo li su pen dor ka vi lan".split()
    sentence = lambda: " ".join("".join(r.choice(syl) for _ in range(r.choice([2, 3]))) for _ in range(r.randrange(4, 12)))
    texts, toxic, spots = [], [], []
    for i in range(n):
        parts = [sentence() for _ in range(r.randrange(2, 9))]
        hit = r.randrange(len(parts)) if i % 5 == 0 else None
        if hit is not None:
            w = parts[hit].split()
            w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", "en", "ta"]))
            parts[hit] = " ".join(w)
        texts.append(". ".join(parts) + ".")
        toxic.append(int(hit is not None))
        spots.append(hit)
    return texts, toxic, spots


def test_mil_finds_the_offending_sentences(spark):
    texts, toxic, _ = planted(600, 1)
    model = toxicity.fit(texts, toxic)
    texts, toxic, spots = planted(300, 2)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(clashing(df), model).collect()}
    predicted = [int(got[i]["toxicity"]["score"] >= 0.3) for i in range(len(texts))]
    assert np.mean(np.array(predicted) == np.array(toxic)) > 0.97
    right = total = 0
    for i, hit in enumerate(spots):
        found = [texts[i][s["start"]:s["start"] + s["length"]].strip() for s in got[i]["toxicity"]["sentences"]]
        if hit is not None and predicted[i]:
            total += 1
            right += found == [texts[i].split(". ")[hit].strip(". ")]
    assert right > 0.9 * total > 0


def test_document_score_is_noisy_or_of_all_sentences():
    texts, toxic, _ = planted(300, 3)
    model = toxicity.fit(texts, toxic)
    for t in (texts[0], texts[1], "one. two! three?", " ".join(texts) * 20):
        each = np.concatenate([p for _, p in model.sentence_scores(t)])
        words = [w for _, _, w in toxicity.sentences_of(t)]
        assert len(each) == len(words)
        z = [model.bias + float(model.weights[toxicity.word_features(w)].sum()) for w in words]
        assert np.allclose(each, 1 / (1 + np.exp(-np.clip(z, -40, 40))), atol=1e-5)
        assert np.isclose(model.score(t), 1 - np.prod(1 - np.minimum(each, 1 - 1e-12)))
    late = "quiet words here. " * 30_000 + texts[0]  # an offence at the end of a very long text counts
    assert toxic[0] and model.score(late) >= 0.3 or model.score(texts[0]) < 0.3


def test_instances_are_cut_at_sentences_and_length():
    text = "A b A. c\nd! " + " ".join(f"w{i}" for i in range(40))
    got = list(toxicity.sentences_of(text))
    assert [g[2] for g in got[:3]] == [["a", "b"], ["c"], ["d"]]
    assert [len(g[2]) for g in got[3:]] == [16, 16, 8]
    assert text[got[3][0]:got[3][1]] == " ".join(f"w{i}" for i in range(16))
    assert list(toxicity.sentences_of(None)) == list(toxicity.sentences_of(" .!\n")) == []


DOC, LABEL = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def test_odd_documents_and_labels(spark):
    texts, toxic, _ = planted(200, 5)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], None), (7, None, None), (8, "", "x"), (3, texts[3], "x")]
    marks = [(i, 1, y) for i, y in enumerate(toxic)] + [(0, 1, 0), (None, 1, 1), (4, 1, None), (999, 1, 1)]
    docs, labels = clashing(spark.createDataFrame(rows, DOC)), clashing(spark.createDataFrame(marks, LABEL))
    got = toxicity.document_toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert toxicity.document_toxicity(docs.limit(0), labels).collect() == []
    for some in (labels.limit(0), labels.filter("toxic = 1")):
        assert {r["score"] for r in toxicity.document_toxicity(docs, some).collect()} == {0.0}


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    seen = []
    old, toxicity.fit = toxicity.fit, lambda texts, toxic, share: seen.append((texts, toxic, share)) or toxicity.Model()
    try:
        toxicity.train(docs, labels, limit=20)
        toxicity.train(docs, labels, limit=100, most_bytes=300)
    finally:
        toxicity.fit = old
    assert [sum(seen[0][1]), len(seen[0][1])] == [20, 40] and seen[0][2] == (0.5, 0.5)
    assert sum(map(len, seen[1][0])) <= 300 and len(seen[1][0]) > 10


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op12_toxicity_mil"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id") \
        .filter("held_out").select("toxic", "predicted").collect()
    clean, bad = ([r["predicted"] for r in got if r["toxic"] == y] for y in (0, 1))
    assert len(bad) > 50 and np.mean(bad) > 0.75 and np.mean(clean) < 0.02

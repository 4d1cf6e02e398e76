"""Decontamination, ranked search and the conversation trie against brute force."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import compare
from reelhouse.llm import prefix_trie, queries, signatures, suffix_arrays, terms
from tests.llm.conftest import dicts


def items_of(spark, *rows):
    frame = spark.createDataFrame(list(rows), "item_id long, text string")
    for name in ("id", "item", "key", "words", "raw", "name", "score", "_bucket"):
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


def prose(rng, n, size=30):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


# -- words


def test_terms():
    assert terms.split("Ab-9 É_é\x00x~\xa0".encode()) == [b"ab", b"9", "É".encode(), "é".encode(), b"x", "\xa0".encode()]
    assert terms.split(None) == [] == terms.split(b" .,")


# -- op13


def windows(words, size=10):
    return [tuple(words[p : p + size]) for p in range(max(1, len(words) - size + 1))] if words else []


def hit_by_hand(docs, items):
    out = []
    tests = defaultdict(set)
    for name, text in items:
        for run in windows(terms.split((text or "").encode())):
            tests[run].add(name)
    for doc, text in docs:
        words = terms.split((text or "").encode())
        covered, named = set(), set()
        for size in {len(run) for run in tests}:
            for p in range(len(words) - size + 1):
                if (run := tuple(words[p : p + size])) in tests:
                    covered |= set(range(p, p + size))
                    named |= tests[run]
        out.append((doc, len(words), sorted(covered), sorted(str(x) for x in named if x is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard", "block"), [(1 << 20, 1 << 20), (300, 150)])
def test_hits_match_brute_force(spark, docs, shard, block):
    rng = random.Random(7)
    items = [(k, " ".join(prose(rng, rng.choice([0, 3, 9, 10, 11, 25])))) for k in range(20)]
    items += [(20, None), (None, items[5][1]), (21, "w1"), (5, items[5][1]), (7, "alone in here"), (22, "Ünder The")]
    rows = []
    for i in range(60):
        words = [f"u{i}x{k}" if rng.random() < 0.3 else rng.choice(["w2", "w3", "zz"]) for k in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            found = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(found) + 1)
            words[len(words) // 2 : len(words) // 2] = found[a : a + 14]
        rows.append((i, rng.choice([" ", "\n", ", "]).join(words).upper(), "s"))
    rows += [(60, None, "s"), (61, "", "s"), (3, rows[3][1], "s"), (None, "Alone, IN here w9", None), (62, "ünder the Ünder the", "s")]
    found = dicts(suffix_arrays.hits(docs(*rows), items_of(spark, *items), shard=shard, block=block))
    told = [(r["doc_id"], r["n_words"], [p for s in r["spans"] for p in range(s["start"], s["end"])], r["items"]) for r in found]
    assert sorted(told, key=str) == hit_by_hand([r[:2] for r in rows], items)
    assert any(len(r["items"]) > 1 for r in found) and any(len(r["spans"]) > 1 for r in found)


def test_longest_matches_and_clean_documents(spark, docs):
    text = [f"t{k}" for k in range(40)]
    own = [f"o{k}" for k in range(30)]
    items = items_of(spark, (1, " ".join(text)), (2, "t5 t6 t7"), (None, " ".join(text[30:40])))
    table = docs(
        (1, " ".join(own[:5] + text[3:33] + own[5:] + text[0:12]), "s"),
        (2, " ".join(own), "s"),
        (3, " ".join(text[3:12]) + " x", "s"),
        (4, None, None),
    )
    found = {(r["doc_id"], r["item_id"], r["doc_start"], r["item_start"], r["length"]) for r in dicts(suffix_arrays.matches(table, items))}
    assert found == {
        (1, "1", 5, 3, 30), (1, "1", 60, 0, 12), (1, "2", 7, 0, 3), (1, "2", 65, 0, 3), (3, "2", 2, 0, 3),
    }
    clean = suffix_arrays.without_hits(table, items)
    assert clean.columns == table.columns
    assert sorted(r["doc_id"] for r in dicts(clean)) == [2, 4]


def test_long_texts_and_items(spark, docs, monkeypatch):
    monkeypatch.setattr(suffix_arrays, "PIECE", 50)
    rng = random.Random(3)
    item = prose(rng, 400, 2000)
    long = prose(rng, 60_000, 4000)
    long[30_000:30_000] = item[100:300]
    found = dicts(suffix_arrays.hits(docs((1, " ".join(long), "s"), (2, " ".join(item), "s")), items_of(spark, (1, " ".join(item))), block=2000))
    assert {r["doc_id"]: r["spans"] for r in found} == {1: [{"start": 30_000, "end": 30_200}], 2: [{"start": 0, "end": 400}]}


def test_empty_tests_and_documents(spark, docs):
    table, none = docs((1, "a b", "s"), (2, None, None)), items_of(spark)
    assert [(r["n_words"], r["spans"], r["items"]) for r in dicts(suffix_arrays.hits(table, none).orderBy("doc_id"))] == [(2, [], []), (0, [], [])]
    assert suffix_arrays.hits(table.limit(0), items_of(spark, (1, "a"))).count() == 0
    assert suffix_arrays.without_hits(table, none).count() == 2
    assert suffix_arrays.matches(table, none).count() == 0


# -- op12


def ranked_by_hand(docs, items, top):
    held = [(doc, Counter(terms.split((text or "").encode()))) for doc, text in docs]
    held = [(doc, tf, sum(tf.values())) for doc, tf in held if tf]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(term for _, tf, _ in held for term in tf)
    out = []
    for name, text in set(items):
        asked = Counter(terms.split((text or "").encode()))
        scores = []
        for doc, tf, n in held:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, times in asked.items()
                if tf[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(name, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 600])
def test_search_matches_brute_force(spark, docs, block):
    rng = random.Random(11)
    words = [f"v{int(rng.paretovariate(0.6))}" for _ in range(60_000)]
    rows, at = [], 0
    for i in range(400):
        n = rng.choice([1, 5, 40, 80, 300])
        rows.append((i, " ".join(words[at : at + n]), "s"))
        at += n
    # many equal rows: ties, and a hot text
    rows += [(1000 + i, "v2 v3 V5, v8", "s") for i in range(60)] + [(1000, "v2 v3 V5, v8", "s")]
    rows += [(2000, None, "s"), (2001, "..", "s"), (None, "v5 v8 v8", None), (2002, "v8 " * 5000, "s")]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for k in range(30)]
    items += [(30, None), (31, "never seen"), (3, items[3][1]), (4, "v8 v8"), (None, "v2 v8")]
    found = signatures.ranked(docs(*rows).repartition(5), items_of(spark, *items), block=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    told = sorted([tuple(r) for r in found.collect()], key=str)
    assert told == ranked_by_hand([r[:2] for r in rows], items, signatures.TOP)


def test_bounds_never_fall_short(spark, docs):
    rng = random.Random(5)
    rows = [(i, " ".join(prose(rng, rng.randrange(1, 300), 80)), "s") for i in range(200)]
    asked = signatures.Queries.of([" ".join(prose(rng, 12, 80)).encode() for _ in range(10)])
    asked.n_docs, asked.n_terms = 200, sum(len(r[1].split()) for r in rows)
    asked.weight[:] = 1 + rng.randrange(900)
    text = dict((r[0], r[1]) for r in rows)
    seen = tight = 0
    for group in dicts(signatures.index(docs(*rows))):
        upper = signatures._upper(group, asked)
        for k, doc in enumerate(group["ids"]):
            tf = Counter(terms.split(text[doc].encode()))
            times = signatures.np.array([tf[w] for w in asked.known])
            m = asked.scale(signatures.np.array([sum(tf.values())]))
            exact = asked.sums(asked.weight * signatures._impact(times, m))
            assert (upper[:, k] >= exact).all()
            seen, tight = seen + len(exact), tight + int((upper[:, k] <= 1.2 * exact + 1).sum())
    assert seen == 2000 and tight > 0.7 * seen


def test_search_in_empty_tables(spark, docs):
    assert signatures.ranked(docs((1, "a", "s")), items_of(spark)).count() == 0
    assert signatures.ranked(docs((1, "a", "s")).limit(0), items_of(spark, (1, "a"))).count() == 0
    assert signatures.ranked(docs((1, None, "s")), items_of(spark, (1, "a"))).count() == 0


# -- op11


def talks(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "depth", "at", "a", "up", "n", "h", "run"):
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


def agrees_with_sql(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    return compare.differences(queries.op11_prefix_trie(spark, str(tmp_path)), con, queries.SQL["op11_prefix_trie"])


def test_trie_of_odd_rows_agrees_with_sql(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 230), 777, -3]:
        for t in range(rng.randrange(1, 9)):
            # gaps, ties of one turn, repeated rows, nulls anywhere
            turn = None if rng.random() < 0.1 else t - (rng.random() < 0.2)
            rows.append((c, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "yes", "no", None, "", "é" * 70, "é" * 70 + "x"])))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rows += [(None, 1, "user", "nobody")] * 50
    assert agrees_with_sql(spark, talks(spark, rows).repartition(3), tmp_path) == []


def test_empty_trie(spark):
    assert prefix_trie.trie(talks(spark, []).limit(0)).count() == 0
    assert prefix_trie.trie(talks(spark, [(None, 1, "user", "x")])).count() == 0


def test_long_conversation_over_many_tasks(spark, tmp_path):
    # a third of all rows in one conversation, and another that shares half of it
    rows = [(250, t, "user", f"t{t % 7}") for t in range(3000)] + [(350, t, "user", f"t{t % 7}") for t in range(1500)]
    rows += [(350, t, "user", "own") for t in range(1500, 1510)] + [(c, 0, "user", "t0") for c in range(1, 60)]
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = talks(spark, rows)
        places = prefix_trie.turns(frame).where("conv = 250").agg(F.count("at"), F.min("at"), F.max("at"), F.countDistinct("at", "s0", "s1")).first()
        assert tuple(places) == (3000, 1, 3000, 3000)
        found = prefix_trie.trie(frame)
        deep = found.where("depth > 0").agg(F.max("depth"), F.sum(F.expr("cast(n_children > 1 as int)"))).first()
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in (250, 350)}
        assert deep[0] == 3000 - h[250]
        # conv 250 and 350 without their first turns: alike if shifted by whole periods only
        root = found.where("depth = 0").first()
        assert root["n_convs"] == 61 and root["parent_conv_id"] is None
        spine = found.where("conv_id = 250 and n_convs = 1 and n_children = 0").first()
        assert spine["n_leaves"] == 1 and spine["saved_tokens"] == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_contraction_matches_brute_force(spark):
    """Caterpillars, long chains and bushes; small blocks make many rounds."""
    rng = random.Random(9)
    paths = [("a" * 150,), ("a" * 70 + "b" * 40,), ("",), ("c",)]
    paths += [("a" * k + rng.choice("xyz") * rng.randrange(1, 20),) for k in range(0, 140, 3)]
    paths += [("".join(rng.choice("pq") for _ in range(rng.randrange(12))),) for _ in range(60)]
    member: dict[str, int] = {}
    for c, (text,) in enumerate(paths):
        for d in range(len(text) + 1):
            member.setdefault(text[:d], c)
    kids = Counter(node[:-1] for node in member if node)
    tree = [(member[node], len(node), member[node[:-1]] if node else None, kids[node], 1 + len(node) % 5) for node in member]
    frame = spark.createDataFrame(tree, "conv long, depth long, up long, n_children long, v long")
    expected = defaultdict(lambda: [0, 0])
    for node in member:
        for d in range(len(node) + 1):
            expected[member[node[:d]], d][0] += 1 + len(node) % 5
            expected[member[node[:d]], d][1] += kids[node] == 0
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    sums = prefix_trie.subtree_sums(frame, {"v": F.col("v"), "leaves": leaf}, block=4)
    assert {(r["conv"], r["depth"]): [r["v"], r["leaves"]] for r in sums.collect()} == dict(expected)


def test_ids_of_a_common_end_are_hashed_in_order(spark):
    ids = [*range(9_990, 25_000), 5, -7]
    ends = spark.createDataFrame([(c, 2, 1, 1) for c in ids] + [(3, 2, 1, 2)], "conv long, depth long, a long, b long").repartition(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    found = {r["b"]: r["ends_sha256"] for r in prefix_trie._joined_ids(ends).collect()}
    import hashlib

    assert found == {1: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), 2: hashlib.sha256(b"3").hexdigest()}

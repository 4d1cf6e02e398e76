"""Near duplicates, repeated passages, packing and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelhouse.llm import components, mixing, near, packing, quality_gam, shingles, substrings
from tests.llm.conftest import SF_DIR, dicts


def sets_of(texts):
    out = {}
    for i, text in texts.items():
        words = shingles.split(text, lower=True)
        out[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def brute_components(texts):
    found, parent = sets_of(texts), {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(found[a] & found[b])
            if both and 100 * both >= 75 * (len(found[a]) + len(found[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, {i: len(found[i]) for i in ids}


def edited(words, n, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.random()}"
    return " ".join(out)


def test_near_copies_of_all_distances(docs):
    rng = random.Random(5)
    texts = {}
    for group in range(6):
        base = [f"g{group}w{k}" for k in range(150)]
        for copy in range(12):
            texts[100 * group + copy] = edited(base, copy, rng)
    # a chain whose ends are not linked, short texts, case, texts without words
    chain = [f"c{k}" for k in range(100)]
    for k in range(6):
        texts[900 + k] = " ".join(chain[4 * k : 4 * k + 80])
    texts |= {950: "a b c", 951: "A  B c", 952: "a b c d", 953: "", 954: None, 955: " \n"}
    expected, sizes = brute_components(texts)
    found = {r["doc_id"]: r for r in dicts(near.components(docs(*[(i, t, "s") for i, t in texts.items()])))}
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert {i: r["n_shingles"] for i, r in found.items()} == sizes
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())
    assert expected[951] == 950 and expected[955] == 955


def test_large_groups_and_a_passage_all_share(docs, monkeypatch):
    monkeypatch.setattr(near, "SMALL", 4)  # makes nodes branch
    monkeypatch.setattr(near, "DEPTH", 3)
    rng = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = {i: passage + " " + " ".join(f"d{i}x{k}" for k in range(60)) for i in range(60)}
    base = [f"b{k}" for k in range(120)]
    texts |= {100 + i: edited(base, i % 7, rng) for i in range(80)}
    other = [f"o{k}" for k in range(60)]
    texts |= {300 + i: passage + " " + edited(other, i % 3, rng) for i in range(20)}
    expected, _ = brute_components(texts)
    found = near.components(docs(*[(i, t, "s") for i, t in texts.items()]))
    assert {r["doc_id"]: r["component_id"] for r in dicts(found)} == expected


def test_near_copies_of_odd_rows(docs):
    text = " ".join(f"w{k}" for k in range(50))
    table = docs((4, text, "s"), (4, text, "s"), (None, text, "s"), (4, "else " * 9, "s"), (2, text + " end", None))
    found = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in dicts(near.components(table)))
    assert found == {(4, 2, False): 2, (None, 2, False): 1, (4, 4, True): 1, (2, 2, True): 1}
    kept = near.without_near_copies(table)
    assert kept.columns == table.columns
    assert near.components(table.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [components.CHUNK, 30])
def test_components_of_a_long_chain(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)  # with the smaller one stars are needed
    links = spark.range(50).selectExpr("id + 1 as a", "id as b").unionByName(spark.createDataFrame([(90, 80)], "a long, b long"))
    found = {r["row"]: r["class"] for r in dicts(components.smallest_reachable(links))}
    assert found == {**dict.fromkeys(range(51), 0), 80: 80, 90: 80}


@pytest.mark.parametrize("chunk", [components.CHUNK, 30])
def test_links_over_many_tasks(spark, monkeypatch, chunk):
    """A hub, a chain and chance links, dealt over tasks that each see some of them."""
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + k, 1001 + k) for k in range(200)] + [(3000 + k, 2000) for k in range(200)]
    links += links[:50]
    rng.shuffle(links)
    least = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in range(len(least)):
        before = dict(least)
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    table = spark.createDataFrame(links, "a long, b long").repartition(12)
    found = [(r["row"], r["class"]) for r in dicts(components.smallest_reachable(table))]
    assert len(found) == len(least) and dict(found) == least
    assert components.smallest_reachable(table.limit(0)).count() == 0


def test_links_within_a_task():
    u, v = np.array([5, 9, 7, 30, 9]), np.array([3, 5, 6, 20, 3])
    hung, on = components.contracted(u, v)
    assert dict(zip(hung.tolist(), on.tolist(), strict=True)) == {5: 3, 9: 3, 7: 6, 30: 20}
    assert len(components.contracted(u[:0], v[:0])[0]) == 0


# -- repeated passages


def brute_removals(texts, window=50):
    first = {}
    split = {i: shingles.split(t) for i, t in texts.items()}
    for i in sorted(texts):
        for k in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][k : k + window]), i)
    out = {}
    for i, words in split.items():
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_passages(docs):
    rng = random.Random(7)
    passages = [[f"p{n}w{k}" for k in range(size)] for n, size in enumerate((49, 50, 51, 75, 120, 300))]
    fresh = lambda n: [f"f{rng.random()}" for _ in range(n)]
    texts = {}
    for i in range(60):
        parts = fresh(rng.randrange(60))
        for p in rng.sample(passages, rng.randrange(4)):
            cut = rng.randrange(20) if rng.random() < 0.5 else 0
            parts += p[cut:] + fresh(rng.randrange(30))
        texts[i] = " ".join(parts)
    longest = max(texts.values(), key=len)
    texts |= {70: longest, 71: longest + " tail", 72: "und " * 400, 73: "und " * 60, 74: None, 75: "", 76: "x\n" * 49}
    found = {r["doc_id"]: r for r in dicts(substrings.removals(docs(*[(i, t, "s") for i, t in texts.items()])))}
    expected = brute_removals(texts)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in found.items()} == expected
    assert all(sum(s["end"] - s["begin"] for s in r["removed"]) == r["n_removed"] for r in found.values())
    assert expected[70][1] == expected[70][0]


def test_passages_of_odd_rows(docs):
    text = " ".join(f"w{k}" for k in range(60))
    # the same id twice does not count against itself; a null id is the largest
    found = dicts(substrings.removals(docs((4, text, "s"), (4, text, "s"), (None, text, "s"))))
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in found) == [("4", 0), ("4", 0), ("None", 60)]
    assert substrings.removals(docs().limit(0)).count() == 0
    table = docs((1, text, "s"), (2, "head\n" + text + "  tail", "s"), (3, "a  b", None), (None, None, "s"))
    kept = substrings.without_repeats(table)
    assert kept.columns == table.columns
    assert {r["doc_id"]: r["text"] for r in dicts(kept)} == {1: text, 2: "head tail", 3: "a  b", None: None}


# -- packing


def test_pieces_are_the_tokens(corpus, corpus_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: [*model.encode(r.text, add_special_tokens=False).ids, 1] for r in corpus_rows.itertuples()}
    packed = dicts(packing.pack(packing.pieces(corpus)))
    seen, places = defaultdict(list), defaultdict(list)
    for r in packed:
        own = list(np.frombuffer(r["ids"], "<u4"))
        assert own == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] and len(own) == r["length"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, parts in seen.items():
        assert [s for s, _ in sorted(parts)] == list(np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1])
        assert sum(n for _, n in parts) == len(ids[i])
    for parts in places.values():
        assert [s for s, _ in sorted(parts)] == list(np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1])
        assert sum(n for _, n in parts) <= 2048
    used = sum(map(len, ids.values()))
    assert used / (2048 * len(places)) > 0.97
    whole = dicts(packing.sequences(packing.pack(packing.pieces(corpus))))
    assert sum(len(r["ids"]) // 4 for r in whole) == used


def test_encoding_of_odd_texts():
    texts = [None, "", "ERERTION!! Éa,é", "it's don't", "a<|endoftext|>b", "x́y a ́b", "ﬁ İ ΑΣ", "\x0bab\x0cc\x1cd\x85e\xa0f", "aº µm", "1234 ##"]
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text, found in zip(texts, packing.encode(texts), strict=True):
        assert list(np.frombuffer(found, "<u4")) == model.encode(text or "", add_special_tokens=False).ids, text


def test_packing_of_odd_rows(docs):
    table = docs((1, None, "s"), (1, None, "s"), (None, "", "s"), (2, "word " * 5000, "s"))
    packed = dicts(packing.pack(packing.pieces(table)))
    assert sorted((str(r["doc_id"]), r["start"], r["length"]) for r in packed if r["doc_id"] != 2) == [("1", 0, 1)] * 2 + [("None", 0, 1)]
    assert [r["length"] for r in sorted((r for r in packed if r["doc_id"] == 2), key=lambda r: r["start"])] == [2048, 2048, 905]
    assert len({r["sequence_id"] for r in packed}) == 3
    assert packing.pack(packing.pieces(table.limit(0))).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plans_use_every_piece_and_waste_little(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(257, np.int64)
    np.add.at(counts, np.minimum(rng.lognormal(4, 1, 20_000).astype(int) + 1, 256), 1)
    plan = packing.patterns_for(counts)
    assert (sum(pattern * times for pattern, times in plan) == counts).all()
    assert all((pattern * np.arange(257)).sum() <= 256 for pattern, _ in plan)
    least = (counts * np.arange(257)).sum() / 256
    assert sum(times for _, times in plan) <= 1.02 * least + 3


# -- the pipeline


def test_pipeline_against_brute_force(spark, corpus, corpus_rows):
    final = dicts(corpus_pipeline.run(spark, SF_DIR))
    docs = corpus
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    model = quality_gam.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = {r.doc_id: r for r in corpus_rows.itertuples()}
    score = dict(zip(rows, model.score(np.array([quality_gam.features(r.text) for r in rows.values()])), strict=True))
    good = {i for i in rows if score[i] >= quality_gam.THRESHOLD}
    assert {r["doc_id"] for r in dicts(kept.select("doc_id"))} == good
    # exact copies, then near copies
    first = {}
    for i in sorted(good):
        first.setdefault(b" ".join(shingles.split(f". {rows[i].text} .")), i)
    single = set(first.values())
    parts, _ = brute_components({i: rows[i].text for i in single})
    apart = {i for i in single if parts[i] == i}
    # the mix of those, by the rates of their sources
    size = {i: len(shingles.split(rows[i].text)) for i in apart}
    totals = Counter()
    for i in apart:
        totals[rows[i].source] += size[i]
    rates = spark.createDataFrame(list(totals.items()), "source string, source_size long")
    rate = {r["source"]: r["rate"] for r in dicts(mixing.source_rates(rates))}
    draw = {i: int(hashlib.sha256(f"mix-{i}".encode()).hexdigest()[:8], 16) / 2**32 for i in apart}
    copies = {i: int(rate[rows[i].source]) + (draw[i] < rate[rows[i].source] % 1) for i in apart}
    # and its tokens
    tokens = Counter()
    for r in final:
        tokens[r["doc_id"]] += r["length"]
    expected = {i: n * (len(packing.encode([rows[i].text])[0]) // 4 + 1) for i, n in copies.items() if n}
    assert dict(tokens) == expected
    assert all(zlib.crc32(b"") <= r["ids_crc32"] < 1 << 32 for r in final)


def test_stages_of_an_empty_table(spark, corpus):
    docs = corpus.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0, name


def test_stages_keep_columns_of_odd_tables(spark, docs):
    table = docs((1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, None, None), (None, "", "t"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF_DIR)
        assert out.columns == table.columns and out.select(F.count("*")).first()[0] <= 8


@pytest.mark.parametrize(("word", "n"), [("", 5000), ("the the the the the the the the", 3000)])
def test_short_texts_leave_little_padding(docs, word, n):
    """Tables of documents of one token, and of nine."""
    spark_rows = [(i, word, "s") for i in range(n)]
    packed = packing.pack(packing.pieces(docs(*spark_rows)), carry={})
    used, last = packed.agg(F.sum("length"), F.max("sequence_id")).first()
    assert used in (n, 9 * n)
    assert used > 0.99 * 2048 * last  # all sequences but the last one are full


def test_rows_that_stay_of_near_copies(docs):
    text = " ".join(f"w{i}" for i in range(100))
    near_one = text.replace("w99", "v99")
    table = docs(
        (5, text, "s"), (3, near_one, "s"), (3, "alone " + text[::-1], "s"), (None, text, "s"),
        (None, "k " * 3 + "lost words of no id", "s"), (None, "k " * 3 + "lost words of no id", "t"),
        (7, None, "s"), (8, " ", "s"), (9, text + " x", "s"), (9, text + " x", "s"), (2, "b c", "s"), (2, "b c", "s"),
    )
    kept = near.without_near_copies(table)
    assert kept.columns == table.columns
    stay = Counter((r["doc_id"], r["text"]) for r in dicts(kept))
    assert stay == Counter({
        (3, near_one): 1, (3, "alone " + text[::-1]): 1, (None, "k " * 3 + "lost words of no id"): 1,
        (7, None): 1, (8, " "): 1, (2, "b c"): 1,
    })


def test_new_words_are_encoded_many_in_a_text():
    model, _, _, ends = packing._tokenizer(None)
    words = ["".join(chr(97 + (k * d) % 26) for d in range(1, 2 + k % 9)) + "éß"[k % 2] for k in range(3000)]
    words = [*dict.fromkeys(words), "ª", "µ", "don't", "...", "42", "<|endoftext|>", "Upper", "x" * 5000]
    asked = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return model.encode_batch_fast(texts, **options)

    alone = {w: np.array(model.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words}
    assert dict(packing._coded(Counted(), ends, words)) == alone
    assert len(asked) < len(words) / 20
    assert dict(packing._coded(model, None, words)) == alone

"""Quality, language and language model: held-out results, brute force, odd rows."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import language_crf, log_bilinear, quality_gam, queries
from tests.llm.conftest import SF_DIR, dicts

BIG = "/root/testdata/sf0.01"
ODD = ((1, None, "s"), (2, "", None), (3, " \n\t ", "s"), (4, "12 34 ##", "s"), (5, "lone", "s"), (5, "lone", "s"), (None, "é ñ", "s"))


def crc(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


# -- quality


def test_quality_on_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    found = dicts(queries.op6_quality(spark, BIG))
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert len(held) > 40 and right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_quality_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (None, 1), (8, None), (99, 0)], "doc_id long, quality int")
    table = docs(*ODD)
    model = quality_gam.train(table, labels)
    assert len(dicts(quality_gam.scored(table.drop("score"), model))) == len(ODD)
    kept = quality_gam.good(table, labels)
    assert kept.columns == table.columns
    nothing = quality_gam.train(table, labels.limit(0))
    assert {r["score"] for r in dicts(quality_gam.scored(table.drop("score"), nothing))} == {0.5}
    assert quality_gam.good(table.limit(0), labels).count() == 0


def test_pairs_are_learned():
    x = np.random.default_rng(0).random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


# -- language


def test_language_on_held_out(spark):
    found = dicts(queries.op7_language(spark, BIG))
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in found)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_rows(docs):
    table = docs(*ODD).withColumnRenamed("score", "other")
    model = language_crf.fit(["the house and the tree"] * 5 + ["le chat et la maison été"] * 5, ["en"] * 5 + ["fr"] * 5)
    found = {r["doc_id"]: r for r in dicts(language_crf.identified(table, model))}
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (1, 2, 3, 4))
    assert found[5]["lang_pred"] in ("en", "fr")
    nothing = language_crf.train(table.limit(0))
    assert {r["lang_pred"] for r in dicts(language_crf.identified(table, nothing))} == {"und"}


def test_marginals_against_enumeration():
    rng = np.random.default_rng(1)
    emission, moves = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    first = np.array([True, False, False, True, False])
    both, expected = language_crf.marginals(emission, first, moves, expect=True)
    brute, pairs, total = np.zeros((5, 3)), np.zeros((3, 3)), 0.0
    for path in product(range(3), repeat=5):
        score = sum(emission[t, k] for t, k in enumerate(path))
        steps = [(path[t - 1], path[t]) for t in range(1, 5) if not first[t]]
        weight = np.exp(score + sum(moves[s] for s in steps))
        total += weight
        for t, k in enumerate(path):
            brute[t, k] += weight
        for s in steps:
            pairs[s] += weight
    assert np.allclose(both, brute / total) and np.allclose(expected, pairs / total)


def test_marginals_across_blocks():
    rng = np.random.default_rng(2)
    emission, moves = rng.normal(size=(1000, 4)) * 5, rng.normal(size=(4, 4))
    first = rng.random(1000) < 0.05
    first[0] = True
    both, _ = language_crf.marginals(emission, first, moves)
    starts = [*np.flatnonzero(first), 1000]
    for a, b in zip(starts, starts[1:], strict=False):
        alone, _ = language_crf.marginals(emission[a:b], first[a:b], moves)
        assert np.allclose(both[a:b], alone)


def test_code_switched_words():
    english = ["the small house stands near the old river and the people walk there every morning"] * 8
    german = ["das kleine haus steht nahe dem alten fluss und die leute gehen dort jeden morgen"] * 8
    model = language_crf.fit(english + german, ["en"] * 8 + ["de"] * 8)
    memory = language_crf.Memory(model)
    _, both, _ = language_crf.label_words(["the old river and the people das kleine haus steht nahe"], memory)
    labels = [model.langs[k] for k in both.argmax(1)]
    assert labels == ["en"] * 6 + ["de"] * 5


# -- language model


def test_scores_against_brute_force(spark, corpus_rows):
    found = {r["doc_id"]: r for r in dicts(queries.op9_lm_score(spark, SF_DIR))}
    texts = {r.doc_id: [*log_bilinear.tokens(r.text), ""] for r in corpus_rows.itertuples()}
    counts = Counter(w for i, ws in texts.items() if crc(i, 5) != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in texts.items():
        r = found[i]
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert (r["n_tokens"], r["train_tokens"]) == (len(ws), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws)
    held = [r for r in found.values() if r["held_out"]]
    assert all(r["held_out"] == (crc(i, 5) == 1) for i, r in found.items())
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_is_normalised(spark, docs):
    rows = [(i, f"the cat sat on the mat w{i} the end.", "s") for i in range(40)]
    training = docs(*rows)
    words = log_bilinear.vocabulary(log_bilinear.count_words(training), frequent=10)
    model = log_bilinear.train(training, words)
    one, two = np.array([1, 5, log_bilinear.CLASSES]), np.array([2, log_bilinear.CLASSES, log_bilinear.CLASSES])
    norm = model.log_normaliser(one, two)
    for k in range(3):
        every = np.arange(log_bilinear.CLASSES)
        same = np.full(log_bilinear.CLASSES, one[k]), np.full(log_bilinear.CLASSES, two[k])
        assert np.exp(model.logit(every, *same) - norm[k]).sum() == pytest.approx(1, rel=1e-4)
    # counts of shared classes cover all words that are not single ones
    assert words.class_tokens.sum() == words.total and words.class_words.sum() == words.distinct


def test_language_model_of_odd_rows(docs):
    table = docs(*ODD)
    found = dicts(log_bilinear.scored(table, table))
    assert len(found) == len(ODD) and all(np.isfinite(r["score"]) for r in found)
    empty = [r for r in found if r["doc_id"] in (1, 2, 3)]
    assert all(r["n_tokens"] == 1 and r["n_known"] == 1 for r in empty)
    untaught = dicts(log_bilinear.scored(table, table.limit(0)))
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == pytest.approx(0) for r in untaught)
    assert log_bilinear.scored(table.limit(0), table).count() == 0


def test_every_counted_word_has_vectors_of_its_own(docs):
    # 600 pairs of words: more than there are single classes, and each word tells the next
    rows = [(i, " ".join(f"q{k}zz r{k}zz" for k in range(i % 5, 600, 5)), "s") for i in range(200)]
    training = docs(*rows)
    words = log_bilinear.vocabulary(log_bilinear.count_words(training))
    assert words.own == 1201 and words.rest_tokens[log_bilinear.SINGLE + 1 :].sum() == 0
    model, tree = log_bilinear.train(training, words), log_bilinear.grouped(words)
    start = log_bilinear.fresh(words, tree)
    assert len(model.context) == log_bilinear.CLASSES + 1201 - log_bilinear.SINGLE
    coder = log_bilinear.Coder(words)
    row, kind, _, sizes = coder.code([r[1] for r in rows[:5]])
    below = words.below(row)
    one, _ = log_bilinear.contexts(words.before(row, kind), sizes)
    assert below.sum() == 1200 - log_bilinear.SINGLE and (one > log_bilinear.CLASSES).sum() == below.sum()
    # trained on, the words below the classes are likelier than by their counts
    two = np.full(len(one), log_bilinear.CLASSES)
    leaves = words.leaves(row, kind)
    path = [m.log_path(tree, leaves[below], one[below], two[below]).sum() for m in (model, start)]
    assert path[0] > path[1]


def test_words_of_a_class_sum_to_one(docs):
    rows = [(i, " ".join(f"w{k}" for k in range(500 + 3 * i)), "s") for i in range(40)]
    training = docs(*rows)
    words = log_bilinear.vocabulary(log_bilinear.count_words(training))
    model, tree = log_bilinear.train(training, words), log_bilinear.grouped(words)
    # the last words are counted less than LEAST_OWN times and share their class's leaf
    assert 449 < words.own < len(words.words) and words.rest_words.sum() > 448
    n, kinds = words.own - log_bilinear.SINGLE - 1, words.classes()
    for k in range(log_bilinear.SINGLE + 1, log_bilinear.CLASSES):
        leaves = np.append(np.flatnonzero(kinds[log_bilinear.SINGLE + 1 : words.own] == k), n + k - log_bilinear.SINGLE - 1)
        one = np.full(len(leaves), len(model.context) - 1)
        assert np.exp(model.log_path(tree, leaves, one, one)).sum() == pytest.approx(1, rel=1e-4)


def test_scores_are_products_of_plain_softmaxes(spark, docs):
    rows = [(i, " ".join(f"w{k * (i % 7 + 1) % 900}" for k in range(400 + i)), "s") for i in range(60)]
    rows += [(100, "unseen w1 W2\x0bw800 \x1c", "s"), (101, None, "s")]
    training, table = docs(*rows[:60]), docs(*rows)
    found = {r["doc_id"]: r["score"] for r in dicts(log_bilinear.scored(table, training))}
    words = log_bilinear.vocabulary(log_bilinear.count_words(training))
    model, sets = log_bilinear.train(training, words), log_bilinear.grouped(words)
    single, number = log_bilinear.SINGLE, {w: k for k, w in enumerate(words.words)}
    rest, kinds = words.rest(), words.classes()
    assert words.own < len(words.words)  # some words share a leaf

    def chosen(scores, k):
        return scores[k] - np.log(np.exp(scores).sum())

    for i, text, _ in rows[::9] + rows[60:]:
        score, one, two = 0.0, log_bilinear.CLASSES, log_bilinear.CLASSES
        for word in [*log_bilinear.tokens(text), log_bilinear.END]:
            row = number.get(word, -1)
            kind = kinds[row] if row >= 0 else log_bilinear.shared_class(word)
            hidden = model.context[one].astype(float) * model.near + model.context[two] * model.far
            score += chosen(model.target @ hidden + model.bias, kind)
            own = single < row < words.own
            if kind > single:
                leaf = row - single - 1 if own else len(sets.group) - log_bilinear.SHARED + kind - single - 1
                for member in (sets.group[leaf], sets.place[leaf]):
                    low, high = sets.begin[sets.owner[member]], sets.begin[sets.owner[member] + 1]
                    score += chosen(model.node[low:high] @ hidden + model.node_bias[low:high], member - low)
                if not own:
                    score += np.log(((words.counts[row] if row >= 0 else 0) + 0.5) / rest[kind])
            one, two = (row + log_bilinear.CLASSES - single if own else kind), one
        assert found[i] == pytest.approx(score / np.log(10), rel=1e-4)


def test_copies_of_many_tasks_are_averaged_in_rounds(spark, docs, monkeypatch):
    rows = [(i, f"the cat sat on mat w{i % 20} the end", "s") for i in range(90)]
    training = docs(*rows).repartition(9, "doc_id")
    words = log_bilinear.vocabulary(log_bilinear.count_words(training))
    at_once = log_bilinear.train(training, words)
    monkeypatch.setattr(log_bilinear, "MERGED", 2)
    for one, other in zip(at_once, log_bilinear.train(training, words), strict=True):
        assert np.allclose(one, other, atol=1e-5)


def test_extra_columns_do_not_reach_the_scores(docs):
    table = docs(*ODD)
    clash = table.withColumn("score", F.lit("x")).withColumn("word", F.lit(1)).withColumn("row", F.lit(2))
    plain = sorted(dicts(log_bilinear.scored(table, table)), key=str)
    assert sorted(dicts(log_bilinear.scored(clash, clash)), key=str) == plain


def test_a_very_long_text_is_scored_whole(docs):
    text = "the cat sat on the mat " * 60_000
    found = dicts(log_bilinear.scored(docs((1, text, "s")), docs((2, "the cat sat on the mat", "s"))))
    assert found[0]["n_tokens"] == found[0]["n_known"] == 360_001 and np.isfinite(found[0]["score"])


def test_languages_of_long_texts_only_are_learned(spark):
    english = "the small house stands near the old river and the people walk there every morning "
    german = "das kleine haus steht nahe dem alten fluss und die leute gehen dort jeden morgen "
    rows = [(i, english, "en") for i in range(20)] + [(20 + i, german * 600, "de") for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_crf.train(table)
    assert sorted(model.langs) == ["de", "en"]
    asked = spark.createDataFrame([(1, german), (2, english)], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in dicts(language_crf.identified(asked, model))} == {1: "de", 2: "en"}


def test_normalisers_of_pairs_are_remembered(monkeypatch):
    rng = np.random.default_rng(1)
    n, width = log_bilinear.CLASSES, log_bilinear.CLASSES + 400
    part = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    model = log_bilinear.Model(
        part(n, 16), part(width, 16), part(16), part(16), part(n) * 30, part(3, 16), part(3)
    )
    worked_out, plain = [], log_bilinear.Model.log_normaliser

    def counted(self, one, two):
        worked_out.append(len(one))
        return plain(self, one, two)

    monkeypatch.setattr(log_bilinear.Model, "log_normaliser", counted)
    one, two = rng.integers(0, width, (2, 3000))
    hidden = model.hidden(one, two).astype(float)
    scores = hidden @ model.target.T.astype(float) + model.bias
    top = scores.max(1)
    exact = top + np.log(np.exp(scores - top[:, None]).sum(1))
    assert (np.abs(exact) > 60).any()  # some are out of range without a shift
    found = log_bilinear.Normalisers(model)
    for _ in range(2):
        assert np.allclose(found.of(one, two), exact, rtol=1e-4, atol=1e-3)
    assert sum(worked_out) < 3010
    # with few places, pairs push each other out and are worked out again
    monkeypatch.setattr(log_bilinear, "REMEMBERED", 8)
    small = log_bilinear.Normalisers(model)
    for _ in range(2):
        assert np.allclose(small.of(one, two), exact, rtol=1e-4, atol=1e-3)

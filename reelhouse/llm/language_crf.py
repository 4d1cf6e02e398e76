"""Language of words and texts: a linear-chain conditional random field.

A word speaks for a language through its prefixes, suffixes, character n-grams and
membership in lexicons; learned transitions tie neighbouring words, so a text that
switches languages is labelled word by word. Marginals come from forward-backward.

Feature weights of a word are summed once per distinct word and remembered. The
recursions treat a batch of texts as one chain whose first word of each text
forgets the past, cut into blocks: products of transition matrices within blocks,
one step per block between them, so numpy works on all blocks at once whatever
the lengths of the texts. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.text import fold, short_batches

UNKNOWN = "und"
#: About so many training texts of each language, chosen by a hash of the id ...
PER_LANGUAGE = 500
#: ... among texts of at most so many characters.
LONGEST = 20_000
#: Words per language in its lexicon.
LEXICON = 300
WIDTH = 1 << 15
REMEMBERED = 300_000
EPOCHS = 3
_BLOCK, _SLICE = 128, 500

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def letters(word: str) -> str:
    """The word as it is looked at: lower case, letters only."""
    low = word.lower()
    return low if low.isalpha() else "".join(c for c in low if c.isalpha())


def _hashed(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Feature numbers of character tuples of one kind."""
    mixed = np.full(len(codes[0]), kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for code in codes:
        mixed = (mixed ^ code) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(WIDTH)).astype(np.int64)


def features(words: list[str], lexicon: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of lower-case words of letters, as (feature, index of its word).

    Character bigrams and trigrams with word edges (the outer ones are short affixes),
    longer prefix and suffix, the word itself, the lexicons that hold it.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edged = "".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(edged, "<u4").astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    ends = size.cumsum()
    owner = np.repeat(np.arange(len(words)), size)
    two = np.flatnonzero(owner[:-1] == owner[1:])
    three = np.flatnonzero(owner[:-2] == owner[2:])
    long = np.flatnonzero(size >= 5)
    head, tail = (ends - size)[long], ends[long] - 4
    known = [(k, label) for k, w in enumerate(words) for label in lexicon.get(w, ())]
    inside, label = np.array(known, np.int64).reshape(-1, 2).T
    whole = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    found = [
        (_hashed(2, code[two], code[two + 1]), owner[two]),
        (_hashed(3, code[three], code[three + 1], code[three + 2]), owner[three]),
        (_hashed(4, *[code[head + k] for k in range(4)]), long),
        (_hashed(5, *[code[tail + k] for k in range(4)]), long),
        (_hashed(6, whole), np.arange(len(words))),
        (_hashed(7, label.astype(np.uint64)), inside),
    ]
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # WIDTH x languages
    moves: np.ndarray  # languages x languages
    lexicon: dict[str, tuple[int, ...]]

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word."""
        found, owner = features(words, self.lexicon)
        return _summed(self.weights[found], owner, len(words))


def _summed(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, values[:, j], n) for j in range(values.shape[1])], 1)


def marginals(
    emission: np.ndarray, first: np.ndarray, moves: np.ndarray, expect: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Probability of each language for each word; with ``expect``, expected moves too.

    ``emission`` has a row of scores per word, ``first`` marks the words that start a
    text. Texts follow each other in one chain.
    """
    n, k = emission.shape
    blocks = -(-n // _BLOCK)
    padded = blocks * _BLOCK
    seen = np.ones((padded, k))
    seen[:n] = np.exp(emission - emission.max(1, keepdims=True))
    start = np.ones(padded, bool)
    start[:n] = first
    step = np.exp(moves - moves.max())
    # position in the block first, so that each step works on contiguous rows
    seen_at = np.ascontiguousarray(seen.reshape(blocks, _BLOCK, k).swapaxes(0, 1))
    start_at = [np.flatnonzero(x) for x in start.reshape(blocks, _BLOCK).T]

    product = np.tile(np.eye(k), (blocks, 1, 1))
    for at in range(_BLOCK):
        forgot = start_at[at]
        sums = product[forgot].sum(2, keepdims=True)
        product = (product.reshape(-1, k) @ step).reshape(blocks, k, k)
        product[forgot] = sums  # a word that starts a text is as likely after anything
        product *= seen_at[at][:, None, :]
        if at % 8 == 7:
            product /= product.max((1, 2), keepdims=True)
    enter, leave = np.empty((blocks, k)), np.empty((blocks, k))
    left = right = np.full(k, 1 / k)
    for b in range(blocks):
        enter[b] = left
        left = left @ product[b]
        left = left / left.sum()
    for b in range(blocks - 1, -1, -1):
        leave[b] = right
        right = product[b] @ right
        right = right / right.sum()
    ahead, behind = np.empty((_BLOCK, blocks, k)), np.empty((_BLOCK, blocks, k))
    now = enter
    for at in range(_BLOCK):
        moved = now @ step
        moved[start_at[at]] = 1.0
        now = moved * seen_at[at]
        now /= now.sum(1, keepdims=True)
        ahead[at] = now
    now = leave
    for at in range(_BLOCK - 1, -1, -1):
        behind[at] = now
        now = (seen_at[at] * now) @ step.T
        now[start_at[at]] = 1.0
        now /= now.sum(1, keepdims=True)
    ahead = ahead.swapaxes(0, 1).reshape(padded, k)[:n]
    behind = behind.swapaxes(0, 1).reshape(padded, k)[:n]
    both = ahead * behind
    both /= both.sum(1, keepdims=True)
    if not expect:
        return both, None
    pairs = ahead[:-1, :, None] * step * (seen[1:n] * behind[1:])[:, None, :]
    pairs = pairs / np.maximum(pairs.sum((1, 2), keepdims=True), 1e-300)
    return both, pairs[~np.asarray(first)[1:]].sum(0)


def _spliced(texts: list[list[int]], labels: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids, labels and text starts of code-switched texts made of runs of the given ones."""
    runs = []
    for words, label in zip(texts, labels, strict=True):
        at = 0
        while at < len(words):
            size = int(rng.integers(5, 60))
            runs.append((words[at : at + size], label))
            at += size
    order = rng.permutation(len(runs))
    ids = np.concatenate([np.array(runs[k][0], np.int64) for k in order])
    marks = np.concatenate([np.full(len(runs[k][0]), runs[k][1]) for k in order])
    first = np.zeros(len(ids), bool)
    lengths = np.array([len(runs[k][0]) for k in order])
    begins = lengths.cumsum() - lengths
    first[begins[::6]] = True
    return ids, marks, first


def fit(texts: list[str], langs: list[str], seed: int = 0) -> Model:
    """Learns by AdaGrad on the likelihood of word labels, over spliced training texts."""
    names = sorted(set(langs))
    k = len(names)
    labels = np.array([names.index(x) for x in langs], np.int64)
    words = [[w for w in map(letters, _WORD.findall(t)) if w] for t in texts]
    counts = [Counter() for _ in names]
    for text, label in zip(words, labels, strict=True):
        counts[label].update(text)
    lexicon: dict[str, tuple[int, ...]] = {}
    for label in range(k):
        for word, _ in sorted(counts[label].items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon[word] = (*lexicon.get(word, ()), label)
    kinds = {w: i for i, w in enumerate(dict.fromkeys(w for text in words for w in text))}
    weights, moves = np.zeros((WIDTH, k)), np.zeros((k, k))
    if k < 2 or not kinds:
        return Model(names, weights, moves, lexicon)
    flat, of_word = features(list(kinds), lexicon)
    order = np.argsort(of_word, kind="stable")
    flat, size = flat[order], np.bincount(of_word, minlength=len(kinds))
    begin = size.cumsum() - size
    rng = np.random.default_rng(seed)
    ids = [[kinds[w] for w in text] for text in words]
    squares, move_squares = np.full((WIDTH, k), 1e-3), np.full((k, k), 1.0)
    for _ in range(EPOCHS):
        chain, marks, first = _spliced(ids, labels, rng)
        for at in range(0, len(chain), 8192):
            part, mark = chain[at : at + 8192], marks[at : at + 8192]
            fresh = first[at : at + 8192].copy()
            fresh[0] = True
            used, spot = np.unique(part, return_inverse=True)
            owner = np.repeat(np.arange(len(used)), size[used])
            within = np.arange(len(owner)) - np.repeat(size[used].cumsum() - size[used], size[used])
            of = flat[begin[used][owner] + within]
            scores = _summed(weights[of], owner, len(used))
            both, expected = marginals(scores[spot], fresh, moves, expect=True)
            miss = -both
            miss[np.arange(len(part)), mark] += 1
            per_word = _summed(miss, spot, len(used))
            grad = _summed(per_word[owner], of, WIDTH) / len(part)
            real = np.zeros((k, k))
            inner = ~fresh[1:]
            np.add.at(real, (mark[:-1][inner], mark[1:][inner]), 1)
            move_grad = (real - expected) / len(part) * 100
            squares += grad**2 * 1e4
            move_squares += move_grad**2
            weights += 0.2 * grad * 100 / np.sqrt(squares) - 1e-6 * weights
            moves += 0.2 * move_grad / np.sqrt(move_squares)
    return Model(names, weights, moves, lexicon)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from a sample of about ``per_language`` texts of each language.

    Only documents with text and language count whose crc32 of the id modulo 3 is not
    1. The sample is a hash threshold per language, from one count of languages. Where
    a language has fewer texts of up to ``LONGEST`` characters, pieces of that length,
    drawn from all of its longer texts, fill it up.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    long = F.length("text") > LONGEST
    pieces = F.ceil(F.length("text") / LONGEST).cast("long")
    counts = {r["lang"]: (r["n"], r["pieces"]) for r in usable.groupBy("lang").agg(
        F.count(F.when(~long, 1)).alias("n"), F.coalesce(F.sum(F.when(long, pieces)), F.lit(0)).alias("pieces")
    ).collect()}
    if not counts:
        return Model([], np.zeros((WIDTH, 0)), np.zeros((0, 0)), {})

    def share(of: dict) -> Column:
        return F.create_map(*[F.lit(x) for lang, part in of.items() for x in (lang, float(part))])[F.col("lang")]

    def drawn(*of: Column | str) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(1 << 20)) / float(1 << 20)

    taken = usable.where(~long & (drawn("doc_id") < share({x: per_language / max(n, 1) for x, (n, _) in counts.items()})))
    lacking = {x: max(per_language - n, 0) / k for x, (n, k) in counts.items() if k}
    if any(lacking.values()):
        # pieces are chosen by number first, so that only chosen ones are cut
        chosen = F.filter(F.sequence(F.lit(0).cast("long"), pieces - 1), lambda k: drawn("doc_id", k) < share(lacking))
        cut = F.transform(chosen, lambda k: F.substring("text", (k * LONGEST + 1).cast("int"), F.lit(LONGEST)))
        more = usable.where(long).select("doc_id", "lang", F.explode(cut).alias("text"))
        taken = taken.select("doc_id", "lang", "text").unionByName(more)
    rows = (
        taken
        .select(F.col("doc_id").cast("string").alias("id"), "text", "lang")
        .toPandas()
        .sort_values(["id", "lang", "text"])
    )
    return fit(list(rows["text"]), list(rows["lang"]))


class Memory:
    """Scores of words met before; row 0 is for words without letters."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.langs)))
        self.used = 1

    def learn(self, words: list[str]) -> None:
        """Scores words not met before, all at once."""
        plain = [(w, p) for w in dict.fromkeys(words) if (p := letters(w))]
        self.rows.update(dict.fromkeys(words, 0))
        while self.used + len(plain) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.used : self.used + len(plain)] = self.model.emissions([p for _, p in plain])
        self.rows.update((w, self.used + k) for k, (w, _) in enumerate(plain))
        self.used += len(plain)

    def rest(self) -> None:
        """Forgets everything once there is much to remember."""
        if len(self.rows) > REMEMBERED:
            self.rows.clear()
            self.used = 1


def label_words(texts: list[str | None], memory: Memory) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word of a batch: its text, language probabilities, whether it has a letter."""
    memory.rest()
    split = [_WORD.findall(text or "") for text in texts]
    memory.learn([w for words in split for w in words if w not in memory.rows])
    spots = [memory.rows[w] for words in split for w in words]
    lengths = [len(words) for words in split]
    owner = np.repeat(np.arange(len(texts)), lengths)
    spots = np.array(spots, np.int64)
    if not len(spots):
        return owner, np.zeros((0, len(memory.model.langs))), np.zeros(0, bool)
    first = np.diff(owner, prepend=-1) > 0
    return owner, marginals(memory.table[spots], first, memory.model.moves)[0], spots > 0


def judge(texts: list[str | None], memory: Memory) -> tuple[list[str], np.ndarray]:
    """Language and its mean probability over the words with letters, of each text."""
    k = len(memory.model.langs)
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not k:
        return names, scores
    owner, both, lettered = label_words(texts, memory)
    mine, both = owner[lettered], both[lettered]
    sums = np.stack([np.bincount(mine, both[:, j], len(texts)) for j in range(k)], 1)
    n = np.bincount(mine, minlength=len(texts))
    best = sums.argmax(1)
    for t in np.flatnonzero(n):
        names[t] = memory.model.langs[best[t]]
        scores[t] = min(1.0, sums[t, best[t]] / n[t])
    return names, scores


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    Null texts and texts without a letter get ``und`` and score 0; with no language
    learned, all do.
    """

    short_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory = Memory(model)
        for series in texts:
            names, scores = [], []
            for at in range(0, len(series), _SLICE):
                found = judge(list(series.iloc[at : at + _SLICE]), memory)
                names += found[0]
                scores.append(found[1])
            yield pd.DataFrame(
                {"lang_pred": pd.Series(names, dtype=str), "score": np.concatenate(scores) if scores else np.zeros(0)}
            )

    return docs.withColumn("_found", predict("text")).select(
        "*", F.col("_found.lang_pred"), F.col("_found.score")
    ).drop("_found")

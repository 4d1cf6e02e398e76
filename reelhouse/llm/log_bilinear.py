"""Language model scores: log-bilinear model with noise-contrastive estimation.

The model predicts a token from the two before it, in steps. The most frequent
words are classes of their own, all others share classes by ending; the words of a
shared class lie in groups of about as many words as the class has groups. A class,
a group within its class and a word within its group are each predicted by a bilinear
form of its vector with a weighted sum of context vectors, plus a bias. Every word
counted ``LEAST_OWN`` times, up to the bound ``FREQUENT``, has a vector and a context
vector of its own, so the vectors follow the training texts. The words below share a
group and a context vector per class, and have their smoothed shares of that group.
Scores are normalised: over all classes, the groups of a class, the words of a group,
and the words without own vectors plus one for unknown words.

Counts of words come from all training documents, by one distributed aggregation.
So does the model: it starts from a short driver run on at most ``WARM_TEXTS`` texts of
up to 20,000 characters, every task of a pass over all training documents then trains
its own copy, by noise-contrastive estimation at all three steps, and an aggregation in
rounds of ``MERGED`` copies averages each vector by how often they used it. Scores thus
depend, slightly, on how the input is split into tasks; with the same split they repeat.

Scoring multiplies the vectors of distinct contexts with those of all classes, and the
contexts before a group's words with those words, in batches; it remembers the
normalisers of pairs of classes. Only the words beyond ``FREQUENT`` need their counts by
a join; the more frequent ones, a bounded table, are broadcast.

Null texts are empty and have one token, the end. Repeated rows are learned from and
scored as often as they occur; rows of one doc_id are scored each. Without training texts
every token is the unknown one; without documents there are no rows. Columns of ``docs``
other than doc_id and text are not looked at and not returned. A long text is scored as a
whole; its tokens are in memory at once, in one task.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import shingles
from reelhouse.llm.text import fold, short_batches, stored

#: At most so many words, the most frequent ones, are broadcast with their counts.
FREQUENT = 200_000
#: A word counted so often has vectors of its own, if it is among the frequent ones.
LEAST_OWN = 5
#: Classes of single words, and classes of words with like endings.
SINGLE, SHARED = 447, 64
CLASSES = 1 + SINGLE + SHARED  # the first is the end of a text
VECTOR = 16
NOISE = 32
#: Noise samples for the groups of a class, and for the words of a group, in a batch.
WITHIN = 4
BATCH = 2048
#: Texts the driver starts from.
WARM_TEXTS = 200
#: Distinct words counted in a task before it passes them on.
COUNTED = 300_000
#: Vectors that tasks pass on together to be averaged; below 257.
BLOCK = 256
#: Copies of a block that are averaged together before the next round.
MERGED = 64
#: Normalisers of pairs of contexts that a task remembers; a power of two.
REMEMBERED = 1 << 20
#: Tokens that are scored together.
INNER = 1 << 18
_SLICE = 500
END = ""  # no word is empty


def shared_class(word: str) -> int:
    """Class of a word that is not among the single ones, by its last letters."""
    return 1 + SINGLE + zlib.crc32(word.rstrip(".,;:!?")[-2:].encode("utf-8", "surrogatepass")) % SHARED


def _split(text: str | None) -> list[bytes]:
    """Words in UTF-8; of bytes, ``lower`` and ``split`` know A-Z and the ASCII separators only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _named(word: bytes) -> str:
    return word.decode("utf-8", "surrogatepass")


def tokens(text: str | None) -> list[str]:
    """Words between ASCII separators, A-Z in lower case."""
    return [_named(word) for word in _split(text)]


class Vocabulary(NamedTuple):
    """The end and the frequent words with counts, and what the classes hold."""

    words: list[str]
    counts: np.ndarray
    total: int  # N
    distinct: int  # V
    class_tokens: np.ndarray
    class_words: np.ndarray
    own: int  # the first so many words have vectors of their own
    rest_tokens: np.ndarray  # of each class, without the words that have their own
    rest_words: np.ndarray

    def lookup(self) -> dict[bytes, int]:
        return {w.encode("utf-8", "surrogatepass"): k for k, w in enumerate(self.words)}

    def classes(self) -> np.ndarray:
        """Class of each frequent word; the end of a text has class 0."""
        singles = min(SINGLE + 1, len(self.words))
        return np.array([*range(singles), *map(shared_class, self.words[singles:])], np.int64)

    def within(self) -> np.ndarray:
        """log10 of the denominator of each class's words without own vectors; 0 for single classes."""
        return np.where(np.arange(CLASSES) > SINGLE, np.log10(np.maximum(self.rest(), 0.5)), 0.0)

    def rest(self) -> np.ndarray:
        """Smoothed tokens of each class's words without own vectors, the unknown one included."""
        return self.rest_tokens + 0.5 * (self.rest_words + 1)

    def below(self, rows: np.ndarray) -> np.ndarray:
        """Which tokens have vectors of their own below a shared class."""
        return (rows > SINGLE) & (rows < self.own)

    def before(self, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Row of each token's vector as context: after the classes and the one before a text."""
        return np.where(self.below(rows), rows + (CLASSES - SINGLE), kinds)

    def leaves(self, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Leaf of each token; -1 for single classes."""
        n = max(self.own - SINGLE - 1, 0)
        rest = np.where(kinds > SINGLE, kinds + (n - SINGLE - 1), -1)
        return np.where(self.below(rows), rows - (SINGLE + 1), rest)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): how often each token occurs in the texts of ``docs``, ends as ``END``."""

    short_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(map(_named, seen), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "c"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(_split(text))
                seen[b""] += 1  # END
                if len(seen) > COUNTED:
                    yield out()
                    seen.clear()
        yield out()

    counted = docs.select("text").mapInArrow(count, "word string, c long")
    return stored(counted.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def vocabulary(counts: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    total = counts.agg(
        F.sum("c").alias("n"), F.count("word").alias("v"), F.sum(F.when(F.col("word") == END, F.col("c"))).alias("ends")
    ).first()
    proper = counts.where(F.col("word") != END)
    # the least count that keeps the bound, from a histogram of a few thousand rows
    step = F.floor(F.log2("c") * 64)
    steps = proper.groupBy(step.alias("step")).count().toPandas().sort_values("step", ascending=False)
    fitting = steps["step"][steps["count"].cumsum() <= frequent]
    top = proper.where(step >= int(fitting.min()) if len(fitting) else F.lit(False)).toPandas()
    top = top.sort_values(["c", "word"], ascending=[False, True])
    ending = F.substring(F.regexp_replace("word", r"[.,;:!?]+\z", ""), -2, 2)
    per_class = proper.groupBy((F.crc32(ending.cast("binary")) % SHARED).alias("k")).agg(
        F.sum("c").alias("n"), F.count("word").alias("v")
    ).toPandas()
    held, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    held[1 + SINGLE + per_class["k"].to_numpy(int)] = per_class["n"]
    kinds[1 + SINGLE + per_class["k"].to_numpy(int)] = per_class["v"]
    held[0], kinds[0] = total["ends"] or 0, 1
    for k, (word, c) in enumerate(zip(top["word"][:SINGLE], top["c"][:SINGLE], strict=True), 1):
        held[k], kinds[k] = c, 1
        # a single word leaves the class that its ending would have given it
        held[shared_class(word)] -= c
        kinds[shared_class(word)] -= 1
    number = np.array([total["ends"] or 0, *top["c"]], np.int64)
    own = 1 + max(int((top["c"] >= LEAST_OWN).sum()), min(SINGLE, len(top)))
    rest, others = held.copy(), kinds.copy()
    for word, c in zip(top["word"][SINGLE : own - 1], top["c"][SINGLE : own - 1], strict=True):
        rest[shared_class(word)] -= c
        others[shared_class(word)] -= 1
    return Vocabulary([END, *top["word"]], number, total["n"] or 0, total["v"], held, kinds, own, rest, others)


class Sets(NamedTuple):
    """What is chosen from below shared classes.

    Sets are the shared classes, whose members are groups, and then the groups, whose
    members are leaves: words with own vectors, or the rest of a class. Members are
    numbered set by set, groups first.
    """

    group: np.ndarray  # of each leaf
    place: np.ndarray  # number of each leaf as a member
    owner: np.ndarray  # set of each member
    begin: np.ndarray  # first member of each set, and the end
    bias: np.ndarray  # log of each member's share of its set

    def size(self, sets: np.ndarray) -> np.ndarray:
        return self.begin[sets + 1] - self.begin[sets]


def grouped(words: Vocabulary) -> Sets:
    """The words of each shared class by frequency, in groups of equal length; the rest is a group."""
    kinds = words.classes()[SINGLE + 1 : words.own] - (SINGLE + 1)
    weights = np.append(words.counts[SINGLE + 1 : words.own], words.rest()[SINGLE + 1 :]).astype(np.float64)
    held = np.bincount(kinds, minlength=SHARED)
    width = np.maximum(np.ceil(np.sqrt(held)), 1).astype(np.int64)
    by_class = np.argsort(kinds, kind="stable")
    rank = np.empty(len(kinds), np.int64)
    rank[by_class] = np.arange(len(kinds)) - np.repeat(held.cumsum() - held, held)
    groups = 1 + -(-held // width)
    first, n = groups.cumsum() - groups, int(groups.sum())
    group = np.append(first[kinds] + 1 + rank // width[kinds], first)
    order = np.argsort(group, kind="stable")
    place = np.empty(len(group), np.int64)
    place[order] = n + np.arange(len(group))
    inside, mass = np.bincount(group, minlength=n), np.bincount(group, weights, n)
    kind = np.repeat(np.arange(SHARED), groups)
    bias = np.append(np.log(mass / np.bincount(kind, mass, SHARED)[kind]), np.log(weights / mass[group])[order])
    begin = np.concatenate([first, n + inside.cumsum() - inside, [n + len(group)]])
    return Sets(group, place, np.append(kind, SHARED + group[order]), begin, bias.astype(np.float32))


# -- the model


class Model(NamedTuple):
    target: np.ndarray  # classes x vector
    context: np.ndarray  # classes, what is before the text, and words with own vectors
    near: np.ndarray  # weight of the last token's vector, per dimension
    far: np.ndarray
    bias: np.ndarray
    node: np.ndarray  # members of sets x vector
    node_bias: np.ndarray

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.context.take(one, 0) * self.near + self.context.take(two, 0) * self.far

    def log_normaliser(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        hidden, out = self.hidden(one, two), np.empty(len(one), np.float32)
        weight = np.exp(self.bias)
        for at in range(0, len(one), _CHUNK):
            part = slice(at, at + _CHUNK)
            out[part] = _exp_sum(hidden[part], self.target, weight)
        return _log(out, hidden, lambda far: (self.target, self.bias))

    def logit(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.logit_of(token, self.hidden(one, two))

    def logit_of(self, token: np.ndarray, hidden: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", hidden, self.target.take(token, 0)) + self.bias[token]

    def log_path(self, sets: Sets, leaves: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Log probability of each leaf within its class."""
        return self.log_path_of(sets, leaves, self.hidden(one, two))

    def log_path_of(self, sets: Sets, leaves: np.ndarray, hidden: np.ndarray) -> np.ndarray:
        return sum(self._log_share(sets, number[leaves], hidden) for number in (sets.group, sets.place))

    def _log_share(self, sets: Sets, members: np.ndarray, hidden: np.ndarray) -> np.ndarray:
        """Log probability of each member within its set."""
        owner, out = sets.owner[members], np.zeros(len(members), np.float32)
        order = np.argsort(owner)
        order = order[sets.size(owner[order]) > 1]  # the only member is certain
        owner, members, hidden = owner[order], members[order], hidden.take(order, 0)
        score = np.einsum("ij,ij->i", hidden, self.node.take(members, 0)) + self.node_bias[members]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        low, high = sets.begin[owner[cuts[:-1]]].tolist(), sets.begin[owner[cuts[:-1]] + 1].tolist()
        weight, total = np.exp(self.node_bias), np.empty(len(score), np.float32)
        for a, b, c, d in zip(cuts[:-1].tolist(), cuts[1:].tolist(), low, high, strict=True):
            total[a:b] = _exp_sum(hidden[a:b], self.node[c:d], weight[c:d])

        def members_of(row: int) -> tuple[np.ndarray, np.ndarray]:
            part = slice(sets.begin[owner[row]], sets.begin[owner[row] + 1])
            return self.node[part], self.node_bias[part]

        out[order] = score - _log(total, hidden, members_of)
        return out


#: Contexts whose products with all classes are held at once.
_CHUNK = 256


def _exp_sum(hidden: np.ndarray, vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted sum of the exponentials of each row's products with all vectors."""
    with np.errstate(over="ignore", invalid="ignore"):
        scores = hidden @ vectors.T
        return np.exp(scores, out=scores) @ weight


def _log(total: np.ndarray, hidden: np.ndarray, choices: Callable) -> np.ndarray:
    """Logs of the sums of ``_exp_sum``; those out of range are worked out again with a
    shift, from the vectors and biases that ``choices`` gives for a row."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        out = np.log(total)
    for row in np.flatnonzero(~(np.abs(out) < 60)).tolist():
        vectors, bias = choices(row)
        scores = hidden[row] @ vectors.T + bias
        out[row] = scores.max() + np.log(np.exp(scores - scores.max()).sum())
    return out


class Normalisers:
    """Logs of the normalisers of pairs of contexts, of which the last ones are remembered:
    those of pairs of classes all, of others one for each of ``REMEMBERED`` places."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.context)
        self.classes = np.full((CLASSES + 1) ** 2, np.nan, np.float32)
        self.pairs, self.logs = np.full(REMEMBERED, -1, np.int64), np.empty(REMEMBERED, np.float32)

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out, both = np.empty(len(one), np.float32), (one <= CLASSES) & (two <= CLASSES)
        at = one[both] * (CLASSES + 1) + two[both]
        new = np.unique(at[np.isnan(self.classes[at])])
        self.classes[new] = self.model.log_normaliser(new // (CLASSES + 1), new % (CLASSES + 1))
        out[both] = self.classes[at]
        pairs, where = np.unique(one[~both] * self.width + two[~both], return_inverse=True)
        place = (shingles.mixed(pairs.astype(np.uint64)) & np.uint64(REMEMBERED - 1)).astype(np.int64)
        logs, missing = self.logs[place], np.flatnonzero(self.pairs[place] != pairs)
        new = pairs[missing]
        logs[missing] = self.model.log_normaliser(new // self.width, new % self.width)
        place = place[missing]  # of two pairs with one place the last stays, as pair and as log
        self.pairs[place], self.logs[place] = new, logs[missing]
        out[~both] = logs[where]
        return out


def fresh(words: Vocabulary, sets: Sets, seed: int = 0) -> Model:
    """A model that knows the frequencies of classes and words only."""
    class_tokens = words.class_tokens
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    share = (class_tokens + 0.5) / (class_tokens + 0.5).sum()
    ones = np.ones(VECTOR, np.float32)
    below = max(words.own - SINGLE - 1, 0)
    return Model(
        draw(CLASSES, VECTOR), draw(CLASSES + 1 + below, VECTOR), ones, ones * 0.5, np.log(share).astype(np.float32),
        np.zeros((len(sets.bias), VECTOR), np.float32), sets.bias.copy(),
    )


def _summed(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each index once, the sum of its rows, and their number."""
    order = np.argsort(index)
    found = index[order]
    new = np.concatenate([[True], found[1:] != found[:-1]])
    run = np.empty(len(index), np.int64)
    run[order] = new.cumsum() - 1
    found = found[new]
    return found, _gathered(run, rows, len(found)), np.bincount(run)


def _gathered(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each index; column by column, which numpy does fastest."""
    out = np.empty((n, rows.shape[1]), np.float32)
    for k, column in enumerate(np.ascontiguousarray(rows.T)):
        out[:, k] = np.bincount(index, column, n)
    return out


def _gap(score: np.ndarray) -> np.ndarray:
    """1 minus the logistic function of ``score``."""
    return 1 / (1 + np.exp(np.clip(score, -30, 30)))


class Trainer:
    """Steps by AdaGrad, noise-contrastive at every level.

    A batch shares its noise samples: those of classes follow their frequencies, those of
    the members of a set are even. Of contexts and members, a batch touches only the rows
    it uses, with one step size per row; ``used`` counts how often.
    """

    def __init__(self, model: Model, sets: Sets, noise: np.ndarray, seed: int, rate: float = 0.1):
        self.parts = Model(*[x.astype(np.float32).copy() for x in model])
        self.sets = sets
        self.dense = [self.parts.target, self.parts.near, self.parts.far, self.parts.bias]
        self.squares = [np.full_like(x, 1e-2) for x in self.dense]
        self.sparse = {k: np.full(len(getattr(model, k)), 0.1, np.float32) for k in ("context", "node")}
        self.used = {k: np.zeros(len(x), np.int64) for k, x in self.sparse.items()}
        self.noise, self.log_noise = noise, np.log(NOISE * noise).astype(np.float32)
        self.rng, self.rate, self.tokens = np.random.default_rng(seed), rate, 0

    def _touch(self, kind: str, index: np.ndarray, grads: np.ndarray) -> None:
        """A step for the rows of ``kind``; a further column of ``grads`` is for the bias."""
        rows, grad, times = _summed(index, grads)
        square = self.sparse[kind][rows] + np.einsum("ij,ij->i", grad, grad) / grad.shape[1]
        self.sparse[kind][rows] = square
        grad *= (self.rate / np.sqrt(square))[:, None]
        part = getattr(self.parts, kind)
        part[rows] = part.take(rows, 0) + grad[:, :VECTOR]
        if kind == "node":
            self.parts.node_bias[rows] += grad[:, VECTOR]
        self.used[kind][rows] += times

    def step(self, token: np.ndarray, leaves: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        target, context, near, far, bias, *_ = self.parts
        n = len(token)
        drawn = self.rng.choice(CLASSES, NOISE, p=self.noise)
        first, second = context.take(one, 0), context.take(two, 0)
        hidden, own, others = first * near + second * far, target.take(token, 0), target[drawn]
        up = _gap(np.einsum("ij,ij->i", hidden, own) + (bias - self.log_noise)[token])
        down = -_gap(-(hidden @ others.T + (bias - self.log_noise)[drawn]))
        d_hidden = up[:, None] * own + down @ others
        d_target = _gathered(token, up[:, None] * hidden, CLASSES)
        np.add.at(d_target, drawn, down.T @ hidden)
        d_bias = np.bincount(token, up, CLASSES).astype(np.float32)
        np.add.at(d_bias, drawn, down.sum(0))
        self._within(leaves, hidden, d_hidden)
        grads = [d_target, (d_hidden * first).sum(0), (d_hidden * second).sum(0), d_bias]
        both = np.concatenate([d_hidden * near, d_hidden * far])
        for part, square, grad in zip(self.dense, self.squares, grads, strict=True):
            grad = grad / np.float32(n) * 64
            square += grad * grad
            part += self.rate * grad / np.sqrt(square)
        self._touch("context", np.concatenate([one, two]), both)
        self.tokens += n

    def _within(self, leaves: np.ndarray, hidden: np.ndarray, d_hidden: np.ndarray) -> None:
        """The steps of groups and words; adds what they ask of the contexts to ``d_hidden``."""
        sets, (*_, node, bias) = self.sets, self.parts
        at = np.flatnonzero(leaves >= 0)
        leaf = leaves[at]
        members = np.concatenate([sets.group[leaf], sets.place[leaf]])
        owner = sets.owner[members]
        order = np.argsort(owner)
        order = order[sets.size(owner[order]) > 1]
        if not len(order):
            return
        members, owner = members[order], owner[order]
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        run, size = new.cumsum() - 1, sets.size(owner[new])
        log_noise = np.log(WITHIN / size).astype(np.float32)[run]
        seen, own = hidden.take(at.take(order, mode="wrap"), 0), node.take(members, 0)
        up = _gap(np.einsum("ij,ij->i", seen, own) + bias[members] - log_noise)
        own *= up[:, None]
        push = np.empty((len(members), VECTOR + 1), np.float32)
        np.multiply(seen, up[:, None], out=push[:, :VECTOR])
        push[:, VECTOR] = up
        touched, pushes = [members], [push]
        for chance in self.rng.random((WITHIN, len(size))):
            drawn = sets.begin[owner[new]] + (chance * size).astype(np.int64)
            other = node.take(drawn, 0).take(run, 0)
            down = -_gap(log_noise - np.einsum("ij,ij->i", seen, other) - bias[drawn][run])
            own += down[:, None] * other
            push = np.empty((len(members), VECTOR + 1), np.float32)
            np.multiply(seen, down[:, None], out=push[:, :VECTOR])
            push[:, VECTOR] = down
            touched.append(drawn)
            pushes.append(_gathered(run, push, len(drawn)))
        asked = np.zeros((2 * len(at), VECTOR), np.float32)  # by the groups, then by the words
        asked[order] = own
        d_hidden[at] += asked[: len(at)] + asked[len(at) :]
        self._touch("node", np.concatenate(touched), np.concatenate(pushes))

    def learn(self, words: Vocabulary, rows: np.ndarray, kinds: np.ndarray, sizes: np.ndarray) -> None:
        leaves = words.leaves(rows, kinds)
        one, two = contexts(words.before(rows, kinds), sizes)
        for at in range(0, len(kinds), BATCH):
            part = slice(at, at + BATCH)
            self.step(kinds[part], leaves[part], one[part], two[part])


class Coder:
    """Texts as numbers of frequent words and as classes."""

    def __init__(self, words: Vocabulary):
        self.rows, self.kinds = words.lookup(), words.classes()

    def code(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Row of each token (-1: not frequent), its class, the others' words, tokens per text."""
        split = [_split(text) for text in texts]
        sizes = np.array([len(words) + 1 for words in split], np.int64)
        get, flat = self.rows.get, itertools.chain.from_iterable((*words, b"") for words in split)
        rows = np.fromiter(map(get, flat, _MINUS), np.int64, int(sizes.sum()))
        kinds = self.kinds[rows]
        other = np.flatnonzero(rows < 0)
        first = sizes.cumsum() - sizes
        text = np.searchsorted(first, other, "right") - 1
        names = [_named(split[t][k]) for t, k in zip(text.tolist(), (other - first[text]).tolist(), strict=True)]
        kinds[other] = [shared_class(w) for w in names]
        return rows, kinds, names, sizes


#: -1 for ever, the default of ``map(dict.get, ...)``.
_MINUS = itertools.repeat(-1)


def contexts(kinds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context rows of the last token and the one before; ``CLASSES`` before the text."""
    one, two = np.roll(kinds, 1), np.roll(kinds, 2)
    first = sizes.cumsum() - sizes
    one[first] = CLASSES
    two[first] = CLASSES
    second = first[sizes > 1] + 1
    two[second] = CLASSES
    return one, two


def train(docs: DataFrame, words: Vocabulary, seed: int = 0) -> Model:
    """A model from all texts of ``docs``; with none, class frequencies alone."""
    sets = grouped(words)
    start = fresh(words, sets, seed)
    if not words.total:
        return start
    noise = (words.class_tokens + 0.5) / (words.class_tokens + 0.5).sum()
    sample = docs.where(F.length("text") <= 20_000).orderBy(F.xxhash64("doc_id"), "doc_id").select("text").limit(WARM_TEXTS)
    first, coder = Trainer(start, sets, noise, seed), Coder(words)
    texts = [r["text"] for r in sample.collect()]
    for _ in range(3):
        rows, kinds, _, sizes = coder.code(texts)
        if len(kinds):
            first.learn(words, rows, kinds, sizes)
    warm = first.parts
    shared = docs.sparkSession.sparkContext.broadcast((words, sets, warm))

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, choices, model = shared.value
        own, coder, task = Trainer(model, choices, noise, seed + 1, rate=0.05), Coder(known), -1
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                rows, kinds, _, sizes = coder.code(batch.column(1).slice(at, _SLICE).to_pylist())
                own.learn(known, rows, kinds, sizes)
                task = batch.column(0)[0].as_py()
        if not own.tokens:
            return
        moved, weight = _table(own.parts) - _table(model), np.full(_fixed(), own.tokens)
        weight = np.concatenate([weight, own.used["context"], own.used["node"]]).astype(np.float32)
        touched = np.flatnonzero(weight)
        block = touched // BLOCK
        for part in np.array_split(touched, np.flatnonzero(np.diff(block)) + 1):
            yield _packed(int(part[0]) // BLOCK, task, part % BLOCK, weight[part], moved[part])

    def average(batches: pa.Table) -> pa.Table:
        weight, total = np.zeros(BLOCK), np.zeros((BLOCK, VECTOR + 1))
        batches = batches.sort_by("task")  # sums that do not depend on who comes first
        for packed in batches["packed"].to_pylist():
            at, times, move = _unpacked(packed)
            weight[at] += times
            total[at] += times[:, None] * move
        at = np.flatnonzero(weight)
        block, task = (batches[name][0].as_py() for name in ("block", "task"))
        return pa.Table.from_batches([_packed(block, task, at, weight[at], total[at] / weight[at][:, None])])

    form = "block long, task long, packed binary"
    moves = docs.select(F.spark_partition_id().cast("long").alias("task"), "text").mapInArrow(refine, form)
    # as many rows at the end as the model has blocks of vectors, whatever the corpus; no
    # group of the first two rounds holds more than MERGED copies
    for width in (MERGED, MERGED**2, None):
        near = F.floor(F.col("task") / width) if width else F.lit(0)
        moves = moves.groupBy("block", near.cast("long").alias("near")).applyInArrow(average, form)
    table = _table(warm)
    found = moves.toArrow()
    shared.destroy()
    for block, packed in zip(found["block"].to_pylist(), found["packed"].to_pylist(), strict=True):
        at, _, move = _unpacked(packed)
        table[block * BLOCK + at.astype(np.int64)] += move
    return _model(table, len(warm.context))


def _packed(block: int, task: int, at: np.ndarray, weight: np.ndarray, moved: np.ndarray) -> pa.RecordBatch:
    """One row: places in the block, and the weight and the move of each."""
    packed = b"".join((at.astype(np.uint8).tobytes(), weight.astype(np.float32).tobytes(), moved.astype(np.float32).tobytes()))
    return pa.RecordBatch.from_pydict({"block": [block], "task": [task], "packed": pa.array([packed], pa.binary())})


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(packed) // (1 + 4 + 4 * (VECTOR + 1))
    move = np.frombuffer(packed[5 * n :], np.float32).reshape(n, VECTOR + 1)
    return np.frombuffer(packed[:n], np.uint8), np.frombuffer(packed[n : 5 * n], np.float32), move


def _fixed() -> int:
    """Rows of a model's table that every task uses: targets and the two weights."""
    return CLASSES + 2


def _table(model: Model) -> np.ndarray:
    """All vectors of a model as rows, with their biases in a last column."""
    rows = np.concatenate([model.target, [model.near, model.far], model.context, model.node])
    bias = np.concatenate([model.bias, np.zeros(2 + len(model.context), np.float32), model.node_bias])
    return np.column_stack([rows, bias]).astype(np.float32)


def _model(table: np.ndarray, n_contexts: int) -> Model:
    rows, bias, node = table[:, :VECTOR], table[:, VECTOR], _fixed() + n_contexts
    return Model(
        rows[:CLASSES].copy(), rows[_fixed() : node].copy(), rows[CLASSES].copy(), rows[CLASSES + 1].copy(),
        bias[:CLASSES].copy(), rows[node:].copy(), bias[node:].copy(),
    )


def scored(docs: DataFrame, training: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` holds the texts to learn from. Null texts are empty and have one
    token, the end. With nothing to learn from every token is the unknown one.
    """
    counts = count_words(training)
    words = vocabulary(counts)
    model = train(training, words)
    shared = docs.sparkSession.sparkContext.broadcast((words, grouped(words), model))
    log_total = float(np.log10(words.total + 0.5 * (words.distinct + 1)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sets, lbl = shared.value
        coder, within = Coder(known), known.within()
        logs = np.append(np.log10(known.counts + 0.5), 0.0)  # row -1: added later, from the join
        seen = np.append(known.counts > 0, False)
        normalisers = Normalisers(lbl)
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows, kinds, names, sizes = coder.code(batch.column(1).to_pylist())
                one, two = contexts(known.before(rows, kinds), sizes)
                chance = -normalisers.of(one, two).astype(np.float64)
                leaves = known.leaves(rows, kinds)
                for at_token in range(0, len(kinds), INNER):
                    part = slice(at_token, at_token + INNER)
                    hidden = lbl.hidden(one[part], two[part])
                    chance[part] += lbl.logit_of(kinds[part], hidden)
                    inner = np.flatnonzero(leaves[part] >= 0)
                    chance[part][inner] += lbl.log_path_of(sets, leaves[part][inner], hidden.take(inner, 0))
                chance /= np.log(10)
                plain = logs[rows]
                is_rest = (kinds > SINGLE) & ~known.below(rows)
                chance += np.where(is_rest, plain - within[kinds], 0.0)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                pairs = [Counter() for _ in sizes]
                for k, name in zip(owner[rows < 0], names, strict=True):
                    pairs[k][name] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes),
                        pa.array(np.bincount(owner, seen[rows], len(sizes)).astype(np.int64)),
                        pa.array(np.bincount(owner, plain, len(sizes))),
                        pa.array(np.bincount(owner, chance, len(sizes))),
                        pa.array([[{"word": w, "n": n} for w, n in c.items()] for c in pairs],
                                 pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))),
                    ],
                    names=["doc_id", "n_tokens", "n_frequent", "plain", "chance", "tail"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    table = stored(
        docs.select("doc_id", "text")
        .mapInArrow(
            score,
            f"doc_id {kind}, n_tokens long, n_frequent long, plain double, chance double, "
            "tail array<struct<word: string, n: long>>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    tail = table.select("row", F.explode("tail").alias("x")).select("row", "x.word", "x.n")
    c = F.coalesce("c", F.lit(0))
    rest = (
        tail.join(counts, "word", "left").groupBy("row")
        .agg(
            F.sum(F.col("n") * F.log10(c + 0.5)).alias("log"),
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known"),
        )
    )
    log = F.coalesce("log", F.lit(0.0))
    return table.drop("tail").join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("plain") + log - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("chance") + log).alias("score"),
    )


def learned_from(docs: DataFrame) -> DataFrame:
    """The training texts: those whose crc32 of the id modulo 5 is not 1."""
    return docs.where(fold(F.col("doc_id"), 5) != 1)

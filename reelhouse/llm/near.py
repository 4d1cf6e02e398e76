"""Near duplicates: chosen-path set similarity join.

Documents with equal shingle sets are one class from the start and send one
representative. Representatives are embedded as ``COORDINATES`` minwise tokens.
``TREES`` independent trees branch them: a node holds the documents that share the
token of its coordinate. Each document of a node is first compared with the node's
pivot, its smallest member; what that links is one class. Nodes of few documents
are then compared exhaustively, larger ones are branched again along coordinates
chosen by their path. Pairs that enough of the embedding supports are confirmed on
full shingle sets.

Only pairs of different classes are compared, so a node that holds thousands of
copies of one text costs one comparison per member and is done. Nothing else is
left out: a large node with few documents outside its main class is compared in
parts, and others are branched until they are small. From ``DEPTH`` branchings on
the pivot, which has met all members, leaves its node, so this ends.

A pair at the threshold shares a node of one tree with probability 0.75, so ten
trees miss one in a million where nodes of the first level are compared; the test on
the embedding loses less than that. A node of more than ``SMALL`` documents in many
classes is branched, each path by one more coordinate and twice on two levels, which
a pair at the threshold survives less often: it is found by other trees or not at
all. The README has the recall that was measured there.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm import shingles
from reelhouse.llm.components import smallest_reachable
from reelhouse.llm.text import Scratch, short_batches, stored

#: Linked when 100 x intersection >= PERCENT x union.
PERCENT = 75
SIZE = 5
TREES = 10
COORDINATES = 64
#: Nodes of so many documents are compared exhaustively, in one task each; so are larger
#: ones, in parts, when they have so many documents outside their main class.
SMALL = 512
DEPTH = 8
#: Least equal coordinates of a pair that is confirmed on full sets: 5 deviations below 0.75.
SUPPORT = 31
_SLICE = 500

_rng = np.random.default_rng(20_011)
_TIMES = _rng.integers(1, 1 << 63, (COORDINATES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STRETCH = 2048


def embedding(found: np.ndarray) -> bytes:
    """Minwise token of each coordinate, its upper 32 bits."""
    least = (found[:_STRETCH] * _TIMES).min(1)
    for at in range(_STRETCH, len(found), _STRETCH):
        least = np.minimum(least, (found[at : at + _STRETCH] * _TIMES).min(1))
    return (shingles.mixed(least) >> np.uint64(32)).astype("<u4").tobytes()


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per row of ``docs``: id, text hash, n_shingles, set hash, embedding."""
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("text_key", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("tokens", T.BinaryType()),
        ]
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                sizes, keys, tokens = [], [], []
                for text in batch.column(2).to_pylist():
                    found = shingles.shingle_set(text, SIZE)
                    sizes.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    tokens.append(embedding(found) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(tokens, pa.binary()),
                    ],
                    names=schema.names,
                )

    text = F.col(text_col)
    plain = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = plain.mapInArrow(describe, schema).withColumn("row", F.monotonically_increasing_id())
    return stored(found, "near-rows")


def _with_own(entries: DataFrame, columns: list[str], own: DataFrame) -> DataFrame:
    """Entries with what their rows have of their own: joined once for each row, however
    many nodes hold it (a few for every tree)."""
    per_row = entries.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("_at"))
    return per_row.join(own, "row").withColumn("_at", F.explode("_at")).select("row", "_at.*", *[c for c in own.columns if c != "row"])


def _confirmed(pairs: DataFrame, texts: DataFrame, keep: Scratch) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                one, two, first, second = (c.to_pylist() for c in batch.columns)
                keep = []
                for k, a in enumerate(one):
                    if a != last:
                        last, left = a, shingles.shingle_set(first[k], SIZE)
                    right = shingles.shingle_set(second[k], SIZE)
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * both >= PERCENT * (len(left) + len(right) - both))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))],
                    names=["a", "b"],
                )

    # only texts of these pairs travel: first to their ids, then to the pairs
    ids = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    needed = keep.stored(texts.join(ids, "row", "left_semi"), "near-needed")
    second = needed.select(F.col("row").alias("b"), F.col("text").alias("second"))
    first = needed.select(F.col("row").alias("a"), F.col("text").alias("first"))
    return (
        pairs.join(second, "b").join(first, "a").select("a", "b", "first", "second")
        .mapInArrow(confirm, "a long, b long").distinct()
    )


def _supported(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs that agree on enough coordinates and whose set sizes allow the similarity."""

    @F.pandas_udf("boolean")
    def enough(first, second):
        width = 4 * COORDINATES
        one = np.frombuffer(b"".join(first), "<u4").reshape(-1, width // 4)
        two = np.frombuffer(b"".join(second), "<u4").reshape(-1, width // 4)
        import pandas as pd

        return pd.Series((one == two).sum(1) >= SUPPORT)

    side = lambda n: reps.select(F.col("row").alias(n), F.col("tokens").alias(f"t{n}"), F.col("n_shingles").alias(f"n{n}"))
    sized = pairs.join(side("b"), "b").join(side("a"), "a")
    possible = (100 * F.col("na") >= PERCENT * F.col("nb")) & (100 * F.col("nb") >= PERCENT * F.col("na"))
    return sized.where(possible).where(enough("ta", "tb")).select("a", "b")


#: What a node's comparison knows of a member: ``tree`` is the tree of a node of the
#: first level (later nodes: 0), ``apart`` has a bit for every tree whose first node was
#: too large to be compared.
MEMBER = ["node", "row", "class", "n_shingles", "tree", "apart", "tokens"]


def _supported_at(rows: list[np.ndarray], k: int) -> np.ndarray:
    """Earlier members of a node that member ``k`` may be linked with, likeliest first."""
    _, classes, sizes, tree, apart, tokens = rows[:6]
    other = np.flatnonzero(classes[:k] != classes[k])
    if len(other):
        near = (100 * sizes[other] >= PERCENT * sizes[k]) & (100 * sizes[k] >= PERCENT * sizes[other])
        other = other[near]
    same = tokens[other] == tokens[k]
    equal = same.sum(1)
    # a pair that an earlier tree has in a node it compares is left to that node
    met = same[:, : tree[k]] & ((apart[k] >> np.arange(tree[k])) & 1 == 0)
    equal[met.any(1)] = 0
    return other[np.argsort(-equal, kind="stable")][: int((equal >= SUPPORT).sum())]


def _promising(rows: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """(row, 0) of the members that the embedding gives a partner of another class."""
    found = np.zeros(len(rows[0]), bool)
    for k in range(1, len(found)):
        partners = _supported_at(rows, k)
        found[partners] = True
        found[k] |= bool(len(partners))
    for k in np.flatnonzero(found):
        yield rows[0][k], 0


def _links(rows: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links between members of different classes; a link joins its classes."""
    sets: dict[int, np.ndarray] = {}

    def full(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = shingles.shingle_set(rows[6][k], SIZE)
        return sets[k]

    rows[1] = classes = rows[1].copy()
    for k in range(1, len(classes)):
        for at in _supported_at(rows, k):
            if classes[at] == classes[k]:
                continue
            left, right = full(at), full(k)
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= PERCENT * (len(left) + len(right) - both):
                classes[classes == classes[at]] = classes[k]
                yield min(rows[0][at], rows[0][k]), max(rows[0][at], rows[0][k])


def _by_node(nodes: DataFrame, judge, out: str) -> DataFrame:
    """What ``judge`` gives for every node, whose members are brought together.

    ``nodes`` has the columns ``MEMBER`` and perhaps text. The result has the node and two
    numbers, named by ``out``.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
                tokens = b"".join(batch.column(6).to_pylist())
                new.append(np.frombuffer(tokens, "<u4").reshape(-1, COORDINATES))
                if batch.num_columns > 7:
                    new.append(np.array(batch.column(7).to_pylist(), object))
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if held is None or not len(held[0]):
                continue
            edges = np.flatnonzero(np.diff(held[0])) + 1
            # the last node may go on in the next batch
            parts = [0, *edges, len(held[0])] if batch is None else [0, *edges]
            found = [
                (held[0][a], *pair)
                for a, b in zip(parts, parts[1:], strict=False)
                for pair in judge([x[a:b] for x in held[1:]])
            ]
            held = [x[parts[-1] :] for x in held]
            if found:
                columns = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["node", *out.split()])

    together = nodes.repartition("node").sortWithinPartitions("node")
    return together.mapInArrow(judged, ", ".join(f"{name} long" for name in ("node", *out.split())))


def _compared(nodes: DataFrame, texts: DataFrame, keep: Scratch) -> DataFrame:
    """Links (a, b) between classes within nodes of bounded size.

    ``nodes`` has the columns ``MEMBER``. Members that the embedding gives a partner of
    another class come together once more with their texts, and those pairs are
    compared on full sets. No node gives more links than it has members.
    """
    nodes = keep.stored(nodes.select(MEMBER), "near-members")
    some = _by_node(nodes, _promising, "row zero").select("node", "row")
    whole = nodes.join(keep.stored(some, "near-promising"), ["node", "row"]).join(texts, "row")
    return _by_node(whole.select(*MEMBER, "text"), _links, "a b").select("a", "b").distinct()


def _bounded(open_nodes: DataFrame) -> DataFrame:
    """Members of the nodes that can be compared now, in nodes of at most 2 x ``SMALL``.

    A larger node with few members outside its main class is cut up: each part gets
    some members of the main class and all others, so every pair of different classes
    meets, and the rows grow by less than the node has.
    """
    own = ["row", "class", "tree", "n_shingles", "tokens"]
    small = open_nodes.where(F.col("n") <= SMALL).select("node", *own)
    lopsided = open_nodes.where((F.col("n") > SMALL) & (F.col("n") - F.col("most") <= SMALL))
    parts = F.ceil(F.col("most") / SMALL)
    of_main = F.array(F.pmod(F.xxhash64("row"), parts))
    spread = F.when(F.col("class") == F.col("main"), of_main).otherwise(F.sequence(F.lit(0).cast("long"), parts - 1))
    cut_up = lopsided.withColumn("part", F.explode(spread)).select(
        F.xxhash64("node", "part").alias("node"), *own
    )
    return small.unionByName(cut_up)


def _token(coordinate) -> F.Column:
    return F.substring("tokens", coordinate * 4 + 1, F.lit(4))


def _crowded(entries: DataFrame) -> DataFrame:
    """Entries of nodes with two documents or more, with the node's pivot and size."""
    nodes = (
        entries.groupBy("node").agg(F.min("row").alias("pivot"), F.count("row").alias("n")).where("n > 1")
    )
    return entries.join(nodes, "node")


def _across(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries of nodes that hold more than one class, with the node's size, its main
    class and how many members that has."""
    known = entries.join(classes, "row", "left").withColumn("class", F.coalesce("class", "row"))
    per_class = known.groupBy("node", "class").agg(F.count("row").alias("k"))
    nodes = (
        per_class.groupBy("node")
        .agg(
            F.sum("k").alias("n"),
            F.count("class").alias("classes"),
            F.max(F.struct(F.col("k"), F.col("class"))).alias("top"),
        )
        .where("classes > 1")
        .select("node", "n", F.col("top.k").alias("most"), F.col("top.class").alias("main"))
    )
    return known.select("node", "row", "class", "tree").join(nodes, "node")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The described rows, and confirmed links (a, b) between representatives' rows.

    Links found after their ends are already connected are not looked for, so the
    links give the right components, not all pairs.
    """
    rows = described(docs, id_col, text_col)
    keep = Scratch()
    reps = rows.where("n_shingles > 0").groupBy("set_key").agg(
        F.min_by(F.struct("row", "id", "text_key", "n_shingles", "tokens"), "row").alias("r")
    ).select("r.*")
    reps = keep.stored(reps, "near-representatives")
    own = reps.select("row", "n_shingles", "tokens")

    trees = F.explode(F.array([F.struct(F.lit(t).alias("t"), _token(F.lit(t)).alias("v")) for t in range(TREES)]))
    entries = reps.select("row", trees.alias("x")).select(
        "row", F.col("x.t").alias("tree"), F.xxhash64(F.lit("tree"), F.col("x.t"), F.col("x.v")).alias("node")
    )
    crowd = keep.stored(_crowded(entries), "near-nodes")
    # every later pair is between documents that share a node of the first level
    wanted = reps.join(crowd.select("row").distinct(), "row", "left_semi").select("row", "id", "text_key")
    text = F.col(text_col)
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), text.alias("text"))
    same = source["_id"].eqNullSafe(wanted["id"]) & (source["_key"] == wanted["text_key"])
    texts = keep.stored(source.join(wanted, same).select("row", "text"), "near-texts")

    def to_pivots(crowd: DataFrame) -> DataFrame:
        pairs = crowd.where("row != pivot").select(F.col("pivot").alias("a"), F.col("row").alias("b")).distinct()
        near = keep.stored(_supported(pairs, reps), "near-pairs")
        return keep.stored(_confirmed(near, texts, keep), "near-links")

    links = to_pivots(crowd)
    classes = smallest_reachable(links, keep)
    apart, level = None, 0
    while True:
        open_nodes = keep.stored(
            _with_own(_across(crowd.select("node", "row", "tree"), classes), ["node", "class", "tree", "n", "most", "main"], own),
            "near-open",
        )
        if open_nodes.isEmpty():
            break
        texts = keep.stored(texts.join(open_nodes.select("row").distinct(), "row", "left_semi"), "near-texts")
        large = open_nodes.where((F.col("n") > SMALL) & (F.col("n") - F.col("most") > SMALL))
        if apart is None:
            apart = keep.stored(
                large.groupBy("row").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("apart")), "near-apart"
            )
        nodes = _bounded(open_nodes).join(apart, "row", "left")
        nodes = nodes.withColumn("apart", F.coalesce("apart", F.lit(0).cast("long")))
        found = keep.stored(_compared(nodes, texts, keep), "near-links")
        # the first branch is always taken, the second on two levels and then by one path in three
        paths = F.when(
            (F.lit(level) < 2) | (F.pmod(F.xxhash64("node", F.lit("turn")), F.lit(3)) == 0), F.array(F.lit(0), F.lit(1))
        ).otherwise(F.array(F.lit(0)))
        if level >= DEPTH:  # its members have met the pivot, and one path is enough to tell them apart
            pivots = large.groupBy("node").agg(F.min("row").alias("row"))
            large, paths = large.join(pivots, ["node", "row"], "left_anti"), F.array(F.lit(0))
        branched = (
            large.withColumn("branch", F.explode(paths))
            .withColumn("at", F.pmod(F.xxhash64("node", "branch"), F.lit(COORDINATES - TREES)).cast("int") + TREES)
            .select("row", F.lit(0).alias("tree"), F.xxhash64("node", "branch", _token(F.col("at"))).alias("node"))
        )
        crowd = keep.stored(_crowded(branched), "near-nodes")
        if crowd.isEmpty():
            links = keep.stored(links.unionByName(found), "near-links")
            break
        # smaller nodes are compared in place next
        pivotal = to_pivots(crowd.where(F.col("n") > SMALL))
        links = keep.stored(links.unionByName(found).unionByName(pivotal), "near-links")
        # classes so far are stars already; what is new joins them
        stars = classes.select(F.col("row").alias("a"), F.col("class").alias("b"))
        classes = smallest_reachable(stars.unionByName(found).unionByName(pivotal), keep)
        keep.drop(reps, crowd, texts, links, classes, apart)
        level += 1
    keep.drop(links)
    return rows, links


def _classed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: id, text_key, n_shingles, class, component_id. Rows
    without words have no class; a component without any id has no component_id."""
    rows, links = linked(docs, id_col, text_col)
    rep_of = rows.where("n_shingles > 0").groupBy("set_key").agg(F.min("row").alias("rep"), F.min("id").alias("least"))
    keep = Scratch()
    classes = smallest_reachable(links, keep).withColumnRenamed("row", "rep")
    classed = rep_of.join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    least = classed.groupBy("class").agg(F.min("least").alias("component_id"))
    of_set = stored(classed.join(least, "class").select("set_key", "class", "component_id"), "near-classes")
    keep.drop()
    return rows.select("id", "text_key", "n_shingles", "set_key").join(of_set, "set_key", "left")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Texts without words link with nothing. ``component_id`` is the smallest id of the
    component; a row without id takes that of its component, or none. Rows that repeat
    an id are kept together. Other columns play no part; an empty table gives an empty
    result.
    """
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return _classed(docs, id_col, text_col).select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; same columns.

    Rows without id come last, and of rows that share the id the least text hash stays;
    of equal rows one does. Rows without words all stay.
    """
    found = _classed(docs, "doc_id", "text").where("n_shingles > 0")
    each = found.groupBy("class", "id", "text_key").agg(F.count("n_shingles").alias("n"))
    order = F.struct(F.col("id").isNull(), "id", "text_key")
    kept = each.groupBy("class").agg(F.min_by(F.struct("id", "text_key", "n"), order).alias("k"))
    kept = stored(kept.select("k.*"), "near-kept")

    def those(of: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(of["id"]) & (F.xxhash64(docs["text"]) == of["text_key"])
        return docs.join(of, same, "left_semi")

    worded = F.coalesce(docs["text"], F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    columns = [F.col(f"`{name}`") for name in docs.columns]
    repeated = those(kept.where("n > 1")).select(F.struct(*columns).alias("_row"), "doc_id", F.xxhash64("text").alias("_key"))
    once = repeated.groupBy("doc_id", "_key").agg(F.first("_row").alias("_row")).select("_row.*")
    return those(kept.where("n = 1")).unionByName(once).unionByName(docs.where(~worded))

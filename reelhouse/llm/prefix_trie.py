"""Conversation prefix trie, its subtree totals by parallel tree contraction.

**Rebuilding.** A conversation starts with the first turns of its base (``c - c %
100``), as many as a checksum of its id says, and goes on with its own turns after
those.

**Nodes.** Conversations are ordered by a range partitioning over (conversation,
turn, ...), so one that holds a third of all turns lies in many tasks. A task gives
each turn its place and the hash of the turns up to it: polynomials over four primes'
residues, 124 bits. Such a hash can be shifted, so what a task does not see of a long
conversation is added afterwards from one row per task, and a prefix of one
conversation continues another without hashing turns anew. Turns of equal depth and
hash are one node. Its smallest member and its depth name it exactly.

**Contraction.** Nodes with the same smallest member lie on one path. In every round
*compress* joins the unary nodes that follow each other within a block of such a path
into the last of them, and *rake* adds finished leaves to their parents; blocks grow
``BLOCK`` times a round, so a chain of a million turns is gone after four. What was
joined is then *expanded*, last round first: a node's total is that of the node it was
joined into plus what lay between. Every step is a group, a join on unique keys or a
window over a bounded stretch of a path. (A stretch holds up to ``BLOCK`` to the power
of the round nodes, if all of those branch into subtrees that take so many rounds.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.text import stored

#: Most turns a conversation takes from its base.
HEAD = 5
#: Depths of a path that the first round joins, and times more in every later one.
BLOCK = 64

_PRIME = (1 << 31) - 1
_BASES = (1_103_515_247, 1_500_450_271, 1_879_048_201, 2_038_074_743)
_PARTS = range(len(_BASES))


def _power(base: int, at: np.ndarray) -> np.ndarray:
    """``base`` to the power of each of ``at``, modulo the prime."""
    out, square, left = np.ones(len(at), np.int64), base, at.copy()
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] * square % _PRIME
        square, left = square * square % _PRIME, left >> 1
    return out


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix hashes of turns within their conversation and task."""
    last, count, so_far = None, 0, [0] * len(_BASES)
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        new[0] = last is None or conv[0] != last
        start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
        goes_on = start < 0
        at = np.arange(len(conv)) - np.where(goes_on, -count, start) + 1
        columns = [pa.array(at)]
        for k in _PARTS:
            term = batch.column(3 + k).to_numpy() * _power(_BASES[k], at) % _PRIME
            total = term.cumsum()
            before = np.where(goes_on, -so_far[k], (total - term)[start])
            upto = (total - before) % _PRIME
            columns += [pa.array(upto), pa.array((upto - term) % _PRIME)]
            so_far[k] = int(upto[-1])
        last, count = conv[-1], int(at[-1])
        names = ["at", *[name for k in _PARTS for name in (f"s{k}", f"p{k}")]]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=["conv", "part", "chars", *names])


def _continued(pdf):
    """What the earlier tasks of a conversation add to the turns of each later one."""
    pdf = pdf.sort_values("part", ignore_index=True)
    shift, before = 0, [0] * len(_BASES)
    rows = []
    for row in pdf.itertuples():
        by = [pow(base, shift, _PRIME) for base in _BASES]
        rows.append([row.conv, row.part, shift, *before, *by])
        before = [(before[k] + row.last[f"s{k}"] * by[k]) % _PRIME for k in _PARTS]
        shift += row.last["at"]
    return type(pdf)(rows, columns=["conv", "part", "shift", *[f"b{k}" for k in _PARTS], *[f"m{k}" for k in _PARTS]])


def _longs(*names: str) -> str:
    return ", ".join(f"{name} long" for name in names)


def turns(conversations: DataFrame) -> DataFrame:
    """Every turn: conv, at (its place from 1), chars, s0.. (hash of the turns up to it)
    and p0.. (of those before it)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    residue = [F.pmod(F.conv(F.substring(content, 1 + 8 * k, 8), 16, 10).cast("long"), F.lit(_PRIME)) for k in _PARTS]
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        content.alias("content"),
        F.monotonically_increasing_id().alias("row"),
        F.length(text).cast("long").alias("chars"),
        *[r.alias(f"c{k}") for k, r in enumerate(residue)],
    )
    order = ["conv", "turn", "role", "head", "content", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = [name for k in _PARTS for name in (f"s{k}", f"p{k}")]
    placed = ordered.select(
        "conv", F.spark_partition_id().cast("long").alias("part"), "chars", *[f"c{k}" for k in _PARTS]
    ).mapInArrow(_placed, _longs("conv", "part", "chars", "at", *names))
    placed = stored(placed, "trie-turns")
    ends = placed.groupBy("conv", "part").agg(
        F.max_by(F.struct("at", *[f"s{k}" for k in _PARTS]), "at").alias("last")
    )
    # conversations in several tasks: at most two rows per task
    several = ends.withColumn("n", F.count("part").over(Window.partitionBy("conv"))).where("n > 1").drop("n")
    added = [*[f"b{k}" for k in _PARTS], *[f"m{k}" for k in _PARTS]]
    later = several.groupBy("conv").applyInPandas(_continued, _longs("conv", "part", "shift", *added))
    joined = placed.join(later.where("shift > 0"), ["conv", "part"], "left")
    whole = lambda name, k: F.when(
        F.col("shift").isNull(), F.col(name)
    ).otherwise((F.col(f"b{k}") + F.col(name) * F.col(f"m{k}")) % _PRIME)
    return joined.select(
        "conv",
        (F.col("at") + F.coalesce("shift", F.lit(0))).alias("at"),
        "chars",
        *[whole(f"{kind}{k}", k).alias(f"{kind}{k}") for k in _PARTS for kind in "sp"],
    )


def _packed(parts: list[Column]) -> tuple[Column, Column]:
    """Four residues as two longs."""
    one, two, three, four = parts
    return one * (1 << 31) + two, three * (1 << 31) + four


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ends) of the rebuilt conversations.

    Turns: conv, depth, a, b (hash of the first ``depth`` turns), up_a, up_b (of those
    before the last), chars of the last. Ends: conv, depth, a, b of each as a whole.
    """
    own = turns(conversations)
    hashes = lambda kind: [F.col(f"{kind}{k}") for k in _PARTS]
    # the first HEAD turns and the last one of each conversation
    known = own.groupBy("conv").agg(
        F.max("at").alias("n"),
        F.max_by(F.struct(*hashes("s")), "at").alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("at") <= HEAD, F.struct("at", "chars", *hashes("s"), *hashes("p"))))).alias("heads"),
    )
    known = stored(known, "trie-conversations")
    base = known.where("conv % 100 = 0").select(
        F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads")
    )
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)
    plan = (
        known.withColumn("base", F.col("conv") - F.col("conv") % 100)
        .join(base, "base", "left")
        .select(
            "conv", "n", "whole", "heads", "base_heads",
            taken.alias("h"),
            F.least(taken, F.coalesce("base_n", F.lit(0))).alias("k"),
        )
    )
    none = F.lit(0).cast("long")
    head = lambda heads, n, name: F.coalesce(F.try_element_at(F.col(heads), n.cast("int"))[name], none)
    left_out = F.least("h", "n")
    # past the base's k turns, own turns after the first h move by h - k places
    back = [F.element_at(F.array(*[F.lit(pow(pow(base, x, _PRIME), -1, _PRIME)) for x in range(HEAD + 1)]), (F.col("h") - F.col("k") + 1).cast("int")) for base in _BASES]
    plan = plan.select(
        "*",
        *[F.when(F.col("k") > 0, head("base_heads", F.col("k"), f"s{k}")).otherwise(none).alias(f"from{k}") for k in _PARTS],
        *[F.when(left_out > 0, head("heads", left_out, f"s{k}")).otherwise(none).alias(f"less{k}") for k in _PARTS],
        *[back[k].alias(f"back{k}") for k in _PARTS],
    )
    plan = stored(plan, "trie-plan")

    def moved(upto) -> list[Column]:
        return [
            (F.col(f"from{k}") + F.pmod(upto(k) - F.col(f"less{k}"), F.lit(_PRIME)) * F.col(f"back{k}")) % _PRIME
            for k in _PARTS
        ]

    def row(depth: Column, at: list[Column], before: list[Column], chars: Column) -> list[Column]:
        (a, b), (up_a, up_b) = _packed(at), _packed(before)
        return [
            F.col("conv"), depth.cast("long").alias("depth"), a.alias("a"), b.alias("b"),
            up_a.alias("up_a"), up_b.alias("up_b"), chars.alias("chars"),
        ]

    borrowed = plan.select("conv", F.explode(F.slice("base_heads", F.lit(1), F.col("k").cast("int"))).alias("x"))
    shift = [f"{name}{k}" for name in ("from", "less", "back") for k in _PARTS]
    kept = own.join(plan.select("conv", "h", F.col("k").alias("kept"), *shift), "conv").where("at > h")
    rows = borrowed.select(
        row(F.col("x.at"), [F.col(f"x.s{k}") for k in _PARTS], [F.col(f"x.p{k}") for k in _PARTS], F.col("x.chars"))
    ).unionByName(
        kept.select(
            row(
                F.col("at") - F.col("h") + F.col("kept"),
                moved(lambda k: F.col(f"s{k}")), moved(lambda k: F.col(f"p{k}")), F.col("chars"),
            )
        )
    )
    goes_on = F.col("n") > F.col("h")
    last = moved(lambda k: F.col("whole")[f"s{k}"])
    a, b = _packed([F.when(goes_on, last[k]).otherwise(F.col(f"from{k}")) for k in _PARTS])
    length = F.col("k") + F.greatest(F.col("n") - F.col("h"), none)
    return rows, plan.select("conv", length.cast("long").alias("depth"), a.alias("a"), b.alias("b"))


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): hash of the ids of the conversations that end at a node.

    Ids are brought into order by range, so those of a common conversation lie in many
    tasks; each task writes long stretches of them as one row. A node of several
    stretches is hashed as a stream, so no list of its ids is ever whole.
    """
    key = ["depth", "a", "b"]

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, a, b, conv = (column.to_numpy() for column in batch.columns)
            new = np.ones(len(conv), bool)
            new[1:] = (np.diff(depth) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
            top = np.flatnonzero(new)
            text = [",".join(map(str, conv[i:j].tolist())) for i, j in zip(top, [*top[1:], len(conv)], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[top]) for x in (depth, a, b, conv)] + [pa.array(text, pa.string())],
                names=[*key, "first", "ids"],
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch.column(name).to_pylist() for name in (*key, "ids")), strict=True):
                if node != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(done)
        if now is not None:
            yield _digests([(*now, state.hexdigest())])

    def _digests(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*key, "ends_sha256"]
        )

    ordered = ends.select(*key, "conv").repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    parts = stored(ordered.mapInArrow(stretches, f"{_longs(*key, 'first')}, ids string"), "trie-ends")
    count = parts.groupBy(*key).agg(F.count("first").alias("n"), F.min("ids").alias("ids"))
    alone = count.where("n = 1").select(*key, F.sha2("ids", 256).alias("ends_sha256"))
    several = parts.join(count.where("n > 1").select(*key), key, "left_semi")
    streamed = several.repartition(*key).sortWithinPartitions(*key, "first")
    return alone.unionByName(streamed.mapInArrow(hashed, f"{_longs(*key)}, ends_sha256 string"))


def nodes(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Every node: conv (its smallest member), depth, up (its parent's smallest member),
    n_convs, n_children, chars of its last turn, and its key a, b."""
    root = ends.agg(F.min("conv").alias("conv"), F.count("conv").alias("n_convs")).where("n_convs > 0")
    found = (
        rows.groupBy("depth", "a", "b")
        .agg(F.min("conv").alias("conv"), F.count("conv").alias("n_convs"), F.max("chars").alias("chars"),
             F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    )
    zero = lambda name: F.lit(0).cast("long").alias(name)
    top = root.select(zero("depth"), zero("a"), zero("b"), "conv", "n_convs", zero("chars"), zero("up_a"), zero("up_b"))
    found = stored(found.unionByName(top), "trie-nodes")
    parents = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("up")
    )
    named = found.join(parents, ["depth", "up_a", "up_b"], "left").drop("up_a", "up_b")
    named = stored(named, "trie-named")
    children = named.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("conv")).agg(
        F.count("up").alias("n_children")
    )
    counted = named.join(children, ["depth", "conv"], "left")
    return stored(counted.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-counted")


def subtree_sums(tree: DataFrame, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """(conv, depth, and each of ``values`` summed over the node's subtree).

    ``tree`` has conv, depth, up and n_children; (conv, depth) names a node, (up, depth
    - 1) its parent, and nodes of one ``conv`` lie on one path down.
    """
    names = list(values)
    zero = F.lit(0).cast("long")
    active = tree.select(
        "conv", "depth", "up", (F.col("depth") - 1).alias("up_depth"),
        F.col("n_children").alias("kids"),
        *[value.cast("long").alias(f"sum_{name}") for name, value in values.items()],
        *[zero.alias(f"edge_{name}") for name in names],
    )
    rounds = []
    width = block
    while True:
        # compress: joined into the next node of the path's block if that is its only child
        stretch = ["conv", F.floor(F.col("depth") / width)]
        down = Window.partitionBy(*stretch).orderBy(F.col("depth").desc())
        below = lambda name: F.lag(name).over(down)
        goes = (F.col("kids") == 1) & (below("up") == F.col("conv")) & (below("up_depth") == F.col("depth"))
        marked = active.select(
            "*",
            F.coalesce(goes, F.lit(False)).alias("goes"),
            *[(F.col(f"sum_{name}") + below(f"edge_{name}")).alias(f"with_{name}") for name in names],
        ).withColumn("run", F.sum((~F.col("goes")).cast("int")).over(down.rowsBetween(Window.unboundedPreceding, 0)))
        in_run = Window.partitionBy(*stretch, "run").orderBy(F.col("depth").desc())
        so_far, all_ = (in_run.rowsBetween(Window.unboundedPreceding, end) for end in (0, Window.unboundedFollowing))
        # of each run: its last node down (first here), and what the first one hangs on
        between = lambda name: F.coalesce(F.when(F.col("goes"), F.col(f"with_{name}")), zero)
        done = marked.select(
            "conv", "depth", "goes", "kids", *[f"sum_{name}" for name in names],
            F.first("depth").over(so_far).alias("into"),
            F.last("up").over(all_).alias("up"),
            F.last("up_depth").over(all_).alias("up_depth"),
            *[F.sum(between(name)).over(so_far).alias(f"off_{name}") for name in names],
            *[(F.sum(between(name)).over(all_) + F.last(f"edge_{name}").over(all_)).alias(f"edge_{name}") for name in names],
        )
        done = stored(done, "trie-round")
        rounds.append(done)
        left = done.where("not goes and kids > 0")
        if left.isEmpty():
            break
        # rake: finished leaves go to their parents
        leaf = F.col("kids") == 0
        raked = done.where(~F.col("goes") & F.col("up").isNotNull()).groupBy(
            F.col("up").alias("conv"), F.col("up_depth").alias("depth")
        ).agg(
            F.count_if(~leaf).alias("kids"),
            *[F.sum(F.when(leaf, F.col(f"sum_{n}") + F.col(f"edge_{n}")).otherwise(zero)).alias(f"add_{n}") for n in names],
        )
        active = left.drop("kids").join(raked, ["conv", "depth"]).select(
            "conv", "depth", "up", "up_depth", "kids",
            *[(F.col(f"sum_{name}") + F.col(f"add_{name}")).alias(f"sum_{name}") for name in names],
            *[f"edge_{name}" for name in names],
        )
        width *= block
    total = None
    for done in reversed(rounds):
        finished = done.where("not goes and kids = 0").select("conv", "depth", *[F.col(f"sum_{name}").alias(name) for name in names])
        known = finished if total is None else total.unionByName(finished)
        inner = done.where("goes").select("conv", "depth", F.col("into"), *[f"off_{name}" for name in names])
        ends = known.withColumnRenamed("depth", "into")
        expanded = inner.join(ends, ["conv", "into"]).select(
            "conv", "depth", *[(F.col(name) + F.col(f"off_{name}")).alias(name) for name in names]
        )
        total = stored(known.unionByName(expanded), "trie-totals")
    return total


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by number, null first, then by role and the first 64 characters
    of the text, then by a hash; null role and text are empty. Repeated rows are turns
    of their own. Rows without conv_id belong to no conversation. Further columns play
    no part; an empty table, or one without any id, gives an empty result.
    """
    rows, ends = rebuilt(conversations)
    tree = nodes(rows, ends)
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    sums = subtree_sums(tree, {"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    found = tree.join(sums, ["conv", "depth"]).join(_joined_ids(ends), ["depth", "a", "b"], "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("up").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

"""Line rules, conversations, mixing and exact duplicates on handmade tables."""

from __future__ import annotations

import hashlib
import random

import pytest

from reelhouse.llm import conversations, exact, line_rules, mixing
from tests.llm.conftest import dicts

PROSE = " ".join(f"w{i}" for i in range(60))


def test_exact_groups(docs):
    table = docs((5, "a  b", "s"), (3, "a\tb", "s"), (9, "a b ", "s"), (4, None, "s"), (1, "", "t"), (1, "", "t"), (None, "a b", None))
    found = exact.duplicate_groups(table)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = {(r["doc_id"], r["keep_id"], r["group_size"]): r for r in dicts(found)}
    assert (5, 3, 3) in rows and (3, 3, 3) in rows and (None, 3, 3) in rows and (9, 9, 1) in rows
    assert rows[3, 3, 3]["kept"] and not rows[None, 3, 3]["kept"]
    assert rows[3, 3, 3]["text_sha256"] == hashlib.sha256(b"a b").hexdigest()
    # null counts as empty, and of the repeated row one is kept
    assert sorted(r["kept"] for r in dicts(found) if r["keep_id"] == 1) == [False, False, True]


def test_exact_keeps_whole_rows(docs):
    table = docs((5, "a  b", "s"), (3, "a b", "s"), (1, "", "t"), (1, "", "t"), (2, "c", None))
    kept = exact.without_copies(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in dicts(kept)) == [1, 2, 3]


def test_exact_empty_and_many_runs(docs, spark):
    assert exact.duplicate_groups(docs().limit(0)).count() == 0
    # more partitions than the fan of a merge, and one text that most rows share
    many = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 < 2, 'same text', concat('t', id)) as text").repartition(40)
    found = exact.duplicate_groups(many)
    assert found.where("kept").count() == 1001
    assert found.where("group_size = 2000").count() == 2000


def test_base_counts(docs):
    table = docs((1, "a b c a b c\nx # $\nx # $\n\n \nx # $", "s"), (2, None, None), (3, "ä ö", "s"))
    found = {r["doc_id"]: r for r in dicts(line_rules.judge(table))}
    one = found[1]
    assert (one["n_words"], one["word_chars"], one["n_symbols"], one["n_dup_lines"]) == (15, 15, 6, 2)
    # a b c twice; x # $ x # $ x # $ makes its nine words repeat
    assert one["n_repeat_words"] == 15
    assert one["base_failed"] and not one["kept"]
    assert found[2]["n_words"] == 0 and found[2]["base_failed"]
    assert found[3]["word_chars"] == 2


def test_frequent_lines_go_and_depleted_documents_are_rejected(docs):
    notice = " ".join(f"n{i}" for i in range(40))
    rows = [(i, f"{notice.upper()}\n" + " ".join(f"u{i}x{k}" for k in range(60)), "h") for i in range(8)]
    rows += [(8, notice + "\nshort tail of a document that is mostly notice here", "h"), (9, f"{notice}\n{PROSE}", None)]
    found = {r["doc_id"]: r for r in dicts(line_rules.judge(docs(*rows), least_docs=5))}
    assert all(found[i]["kept"] and found[i]["n_removed"] == 40 for i in range(8))
    assert found[8]["n_words"] == 50 and found[8]["n_removed"] == 40 and not found[8]["kept"]
    assert found[9]["n_removed"] == 0 and found[9]["kept"]
    cleaned = {r["doc_id"]: r for r in dicts(line_rules.cleaned(docs(*rows), least_docs=5))}
    assert "N1 " not in cleaned[0]["text"] and "u0x3" in cleaned[0]["text"]
    assert 8 not in cleaned and cleaned[9]["text"].startswith(notice)


def test_exact_copies_do_not_make_their_lines_frequent(docs):
    rows = [(i, PROSE + "\n" + PROSE.replace("w", "v"), "h") for i in range(30)]
    assert all(r["kept"] for r in dicts(line_rules.judge(docs(*rows), least_docs=5)))


def test_line_rules_of_nothing(docs):
    assert line_rules.judge(docs().limit(0)).count() == 0
    assert line_rules.cleaned(docs().limit(0)).count() == 0


def _conversations(spark, *rows):
    frame = spark.createDataFrame(list(rows), "conv_id long, turn int, role string, text string")
    return frame.selectExpr("*", "'x' as key", "1 as n", "0 as position", "0 as block")


def test_snapshots_collapse(spark):
    turns = _conversations(
        spark,
        (1, 0, "user", "hi"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "yes"),
        (3, 5, "user", "hi"), (3, 9, "assistant", "yes"), (3, 12, "user", "ok"),  # gaps in numbers
        (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (4, 1, "assistant", "no"),  # a repeated row
        (6, 0, "user", "hi"), (6, 1, "assistant", "no"),
        (7, 0, None, None), (None, None, "user", "lost"),
    )
    found = {r["conv_id"]: r for r in dicts(conversations.formatted(turns))}
    assert set(found) == {3, 4, 7, None}
    assert found[4]["n_logged"] == 2 and found[4]["n_turns"] == 2
    assert found[3]["text"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\nok<|end|>\n"
    assert found[7]["text"] == "<|unknown|>\n<|end|>\n"


@pytest.mark.parametrize("seed", range(2))
def test_ties_and_lost_turns_agree_with_sql(spark, tmp_path, seed):
    """Several texts of one number, a third of the rows without conv_id, nulls anywhere."""
    import duckdb

    from checks import compare
    from reelhouse.llm import queries

    rng = random.Random(seed)
    said = ["hi", "a", "b", "", None, "é" * 64 + "1", "é" * 64 + "2"]
    rows = [(1, 0, "u", "hi"), (1, 1, "u", "a"), (2, 0, "u", "hi"), (2, 1, "u", "a"), (2, 1, "u", "b")]
    for c in range(3, 60):
        for t in range(rng.randrange(1, 4)):
            for _ in range(rng.randrange(1, 3)):
                rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]), rng.choice(said)))
    rows += [(None, rng.choice([0, None]), rng.choice(["u", None]), rng.choice(said)) for _ in range(len(rows) // 2)]
    _conversations(spark, *rows).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare.differences(queries.op2_chat_format(spark, str(tmp_path)), con, queries.SQL["op2_chat_format"]) == []


def test_long_conversations_and_none(spark):
    rows = [(c, t, "user", f"t{t}") for c, n in ((1, 700), (2, 1000), (3, 999)) for t in range(n)]
    assert [r["conv_id"] for r in dicts(conversations.maximal(_conversations(spark, *rows)))] == [2]
    assert conversations.formatted(_conversations(spark, *rows).limit(0)).count() == 0


def test_targets_settle(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 300), (None, 50), ("", 0)], "source string, source_size long")
    found = {r["source"]: r for r in dicts(mixing.source_rates(sizes))}
    # code point order: '', a, b, c, null take 5, 2, 1, 5, 2; a, c and null stop at twice their size
    assert found[""]["target"] == 0 and found[""]["rate"] == 0
    assert found["a"]["target"] == 20 and found["c"]["target"] == 600 and found[None]["target"] == 100
    assert found["b"]["target"] == pytest.approx(1.5 * 1360 - 720)


@pytest.mark.parametrize("seed", range(3))
def test_targets_against_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k:02}": rng.choice([0, 3, 1000]) + rng.randrange(2000) for k in range(23)}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    target, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in dicts(mixing.source_rates(table))}
    assert found == pytest.approx(target)


def test_mix(docs):
    rows = [(i, PROSE, "a" if i % 3 else "b") for i in range(600)] + [(700, None, None), (None, "x y", None), (701, "", "b")]
    table = docs(*rows)
    drawn = dicts(mixing.with_copies(table))
    assert len(drawn) == len(rows)
    for source in ("a", "b"):
        own = [r for r in drawn if r["source"] == source]
        taken = sum(r["_copies"] * r["_size"] for r in own)
        assert taken == pytest.approx(own[0]["_target"], rel=0.1)
        assert max(r["_copies"] for r in own) <= 2
    again = sorted((str(r["doc_id"]), r["_copies"]) for r in dicts(mixing.with_copies(table.repartition(7))))
    assert again == sorted((str(r["doc_id"]), r["_copies"]) for r in drawn)
    mixed = mixing.mixed(table)
    assert mixed.columns == table.columns
    assert mixed.count() == sum(r["_copies"] for r in drawn)
    assert mixing.mixed(table.limit(0)).count() == 0

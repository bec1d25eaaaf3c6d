"""Conversation repair against a plain search over turns, against SQL, and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from compare import oracle_rows, same_rows, spark_rows
from inkrank.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    found = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fate == 4:
            role = "user"
        found += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return found


def plain(rows):
    """Every way through one conversation, by state the least (cost, audit) so far."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)

    def inserted(ways):
        found = dict(ways)
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                after = "a" if state == "u" else "u"
                way = (cost + 5, audit + "I", lines + (f"{NAMES[after]}:",))
                found[after] = min(found.get(after, way), way)
        return found

    ways = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        following = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            options = [(state, cost + 2, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                for (before, spoken), after in LEGAL.items():
                    if before == state and role[:1] == spoken:
                        options.append((after, cost + more, "K", lines + (f"{role}:{text}",)))
                    if before == state and spoken != "s":
                        options.append((after, cost + 1 + more, "R", lines + (f"{NAMES[spoken]}:{text}",)))
            for after, total, edit, said in options:
                way = (total, audit + edit, said)
                following[after] = min(following.get(after, way), way)
        ways = following
    cost, audit, lines = min(way for state, way in inserted(ways).items() if state in ("", "a"))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, digest


def expected(rows, prepare=damaged):
    by = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in prepare(rows):
        by[conv].append((turn, role, text))
    return {conv: plain(own) for conv, own in by.items()}


def found(df):
    assert df.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = df.collect()
    assert len({row.conv_id for row in rows}) == len(rows)
    return {row.conv_id: tuple(row)[1:] for row in rows}


def made(seed, n_conversations, most):
    draw = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \n", "Go on!", "and", None, "ends. ", "…"]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", "student", None, "User"]
    rows = []
    for conv in range(n_conversations):
        turn = draw.choice([0, 5, -3])
        for _ in range(draw.randint(1, most)):
            text = draw.choice(texts) if draw.random() < 0.5 else f"Sentence {draw.randint(0, 99)}."
            rows.append((None if conv == 3 else conv, None if draw.random() < 0.05 else turn, draw.choice(roles), text))
            turn += draw.choice([0, 1, 1, 1, 2])
    return rows


def test_runs_of_any_length():
    kinds = [(3, 1000), (0, 7), (5, 1), (4, 20)]
    collapsed = conversations.runs((kind, 1) for kind, n in kinds for _ in range(n))
    assert collapsed == kinds
    ends = conversations.values_before(collapsed, conversations._END)
    whole = conversations._apply(conversations.matrix_of(collapsed), (0, conversations._FAR, conversations._FAR, 0))
    assert whole == ends[-1]
    step = conversations._END
    for kind, n in reversed(kinds):
        for _ in range(n):
            step = conversations._apply(conversations._power(kind, 0), step)
    assert step == ends[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_plain_search(spark, seed):
    rows = made(seed, 300, 14)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = {name: F.lit("x") for name in ("key", "conv", "times", "initial", "blank", "long", "audit")}
    result = conversations.repair(conversations.damage(table.withColumns(clash)), times="times")
    assert found(result) == expected(rows)


@pytest.mark.parametrize("segment", [1, 4, 64])
def test_long_conversations_are_cut_into_segments(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "LONG_ROWS", 10)
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = made(7, 30, 60)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(conversations.repair(conversations.damage(table), times="times")) == expected(rows)


def test_long_keys_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(conversations, "LONG_BYTES", 300)
    monkeypatch.setattr(conversations, "_BROADCAST_KEYS", 0)
    rows = made(8, 20, 30)
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(conversations.repair(table)) == expected(rows, lambda rows: [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows])


def test_a_conversation_with_a_third_of_all_rows(spark, monkeypatch):
    """Two of them: one of equal rows without ids, one of different turns."""
    monkeypatch.setattr(conversations, "LONG_ROWS", 1000)
    monkeypatch.setattr(conversations, "SEGMENT", 512)
    turns = spark.range(12_000)
    third = F.col("id") % 3
    table = turns.select(
        F.when(third == 0, F.lit(None)).when(third == 1, F.lit(1)).otherwise(F.col("id")).alias("conv_id"),
        F.when(third > 0, F.col("id") / 3).cast("bigint").alias("turn"),
        F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.when(third == 0, F.lit("Same.")).otherwise(F.concat(F.lit("Text "), F.col("id"), F.lit("."))).alias("text"),
    )
    rows = found(conversations.repair(table).where("conv_id is null or conv_id = 1"))
    audit = rows[None][-2]
    # In the order of roles: the assistant's rows, then the user's.
    assert len(audit) == 4000 and rows[None][2] == 3998
    lines = [(r.turn, r.role, r.text) for r in table.where("conv_id = 1").collect()]
    assert rows[1] == plain(lines)


def test_empty_and_emptied(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert found(conversations.repair(conversations.damage(table), times="times")) == {}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    table = spark.createDataFrame([(4, 0, "user", "a", 0), (None, 1, "user", "b", 0)], SCHEMA + ", times int")
    assert found(conversations.repair(table, times="times")) == {4: nothing, None: nothing}


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 300_000), (1, 1, "assistant", "x" * 100_000 + ".")]
    assert found(conversations.repair(spark.createDataFrame(rows, SCHEMA))) == expected(rows, lambda rows: rows)


@pytest.mark.parametrize("size", ["small", "medium"])
def test_query_equals_sql(spark, request, size):
    sf_dir = request.getfixturevalue(size)
    names, rows = spark_rows(queries.queries()["op12_conversation_repair"](spark, sf_dir))
    oracle_names, wanted = oracle_rows(queries.oracle_sql()["op12_conversation_repair"], sf_dir)
    assert names == oracle_names and rows and same_rows(rows, wanted)

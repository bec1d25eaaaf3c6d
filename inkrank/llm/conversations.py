"""Repair of the structure of conversations by the cheapest edits.

A repaired conversation has turns by user and assistant in alternation, from the
user to the assistant, with at most one system turn before them, or no turn at
all. ``Edit costs`` below name what an edit costs; among equally cheap ways the one
whose edits spell the least text is taken.

The edits are found by dynamic programming over runs. A turn is a symbol, of its
role's initial and its fault, and a symbol is a min-plus matrix over four states:
nothing yet, after system, after user, after assistant. Equal consecutive symbols
are one run, which is passed by the binary powers of its matrix; the powers are
kept. From the values at the runs' ends the choices of each turn are unrolled.

A conversation beyond ``LONG_ROWS`` turns or ``LONG_BYTES`` of text is cut into
segments of ``SEGMENT`` different turns, dealt over tasks: a segment's runs make one
matrix, the matrices of a conversation give the values at its segments' ends, and
each segment is unrolled from all four states. Its turns then pass through one task
in order, one at a time, because a checksum over a text has to be taken in order;
nothing of their text is held there.

Turns stand in the order of (turn, role, text), nulls first. A turn's first fault
counts: blank, duplicate (role and text occur earlier in the conversation), or
truncated (no ``.``, ``!`` or ``?`` at its end).

Edge cases: null roles and texts count as one space, so their turns are faulty or of
no known role; a role without a first letter can't be kept; a null conversation is
one conversation; repeated rows are turns of their own; a conversation without turns
has zeros, an empty audit and the checksum of an empty text; extra columns are
ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkrank.operators.skew import lookup
from inkrank.session import scratch_path, settle, shuffle_width

# Edit costs: fixed values. A truncated turn that stays costs TRUNCATED more.
DELETE, KEEP, REROLE, INSERT, TRUNCATED = 2, 0, 1, 5, 5

#: Beyond either a conversation is cut into segments.
LONG_ROWS = 50_000
LONG_BYTES = 16 << 20

#: Different turns of a segment; a power of two.
SEGMENT = 1 << 14

#: Long conversations up to so many are broadcast by key, some 50 bytes each.
_BROADCAST_KEYS = 200_000

_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = ".!?"

_STATES = range(4)
_START, _SYSTEM, _USER, _ASSISTANT = _STATES
_FAR = 1 << 50

#: Where a role's initial leads, by state.
_NEXT = [{"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER}]
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}

#: Kinds of turns: 0 has to go, 1 + 2 * (place of the initial here) + truncated else.
_INITIALS = " sua"

Values = tuple[int, ...]
Matrix = tuple[Values, ...]


# --- min-plus matrices of turns ---------------------------------------------


def _spoken(state: int) -> int:
    """The state after the one turn that may be made up in ``state``."""
    return _ASSISTANT if state == _USER else _USER


def _edits(kind: int, state: int) -> list[tuple[str, int, int]]:
    """``(edit, state after, cost)`` of a turn, in the order of the edits' letters."""
    found = [("D", state, DELETE)]
    if kind:
        place, cut = divmod(kind - 1, 2)
        more = TRUNCATED * cut
        kept = _NEXT[state].get(_INITIALS[place]) if place else None
        if kept is not None:
            found.append(("K", kept, KEEP + more))
        found.append(("R", _spoken(state), REROLE + more))
    return found


def _times(left: Matrix, right: Matrix) -> Matrix:
    return tuple(tuple(min(row[k] + right[k][j] for k in _STATES) for j in _STATES) for row in left)


def _apply(matrix: Matrix, values: Values) -> Values:
    return tuple(min(a + b for a, b in zip(row, values, strict=True)) for row in matrix)


def _made_up() -> Matrix:
    """Any number of inserted turns; three never pay, as two lead back."""
    rows = []
    for state in _STATES:
        row = [_FAR] * len(_STATES)
        row[state] = 0
        one = _spoken(state)
        row[one] = min(row[one], INSERT)
        row[_spoken(one)] = min(row[_spoken(one)], 2 * INSERT)
        rows.append(tuple(row))
    return tuple(rows)


_INSERTED = _made_up()
#: The cost still to come after the last turn.
_END = _apply(_INSERTED, (0, _FAR, _FAR, 0))


@lru_cache(maxsize=None)
def _power(kind: int, k: int) -> Matrix:
    """2**k turns of a kind, with what is inserted before each."""
    if k:
        half = _power(kind, k - 1)
        return _times(half, half)
    rows = []
    for state in _STATES:
        row = [_FAR] * len(_STATES)
        for _, after, cost in _edits(kind, state):
            row[after] = min(row[after], cost)
        rows.append(tuple(row))
    return _times(_INSERTED, tuple(rows))


def _run_powers(kind: int, count: int) -> Iterator[Matrix]:
    for k in range(count.bit_length()):
        if count >> k & 1:
            yield _power(kind, k)


def runs(kinds: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """``(kind, count)`` with equal neighbours collapsed."""
    return [(kind, sum(n for _, n in own)) for kind, own in groupby(kinds, key=lambda x: x[0])]


def values_before(collapsed: list[tuple[int, int]], values: Values) -> list[Values]:
    """Cost to come at each run's end, the first run's start last."""
    found = [values]
    for kind, count in reversed(collapsed):
        for power in _run_powers(kind, count):
            values = _apply(power, values)
        found.append(values)
    return found


def matrix_of(collapsed: list[tuple[int, int]]) -> Matrix:
    whole = _INSERTED
    for kind, count in collapsed:
        for power in _run_powers(kind, count):
            whole = _times(whole, power)
    return whole


def _normal(values: Values) -> Values:
    least = min(values)
    return tuple(value - least for value in values)


@lru_cache(maxsize=1 << 16)
def _one_before(kind: int, values: Values) -> Values:
    return _normal(_apply(_power(kind, 0), values))


@lru_cache(maxsize=1 << 16)
def _choice(kind: int, state: int, after: Values) -> tuple[str, int]:
    """The least cheapest edits of one turn, with what is inserted before it, and
    the state after it; ``after`` is the cost to come then."""
    before = _apply(_power(kind, 0), after)
    spelt = ""
    while True:
        found = [(e, s) for e, s, cost in _edits(kind, state) if cost + after[s] == before[state]]
        made = _spoken(state)
        if INSERT + before[made] == before[state]:
            found.append(("I", made))
        edit, state = min(found)
        spelt += edit
        if edit != "I":
            return spelt, state


def unroll(collapsed: list[tuple[int, int]], ends: list[Values], state: int) -> tuple[list[str], int]:
    """The edits of each turn from ``state``, each with the insertions before it."""
    spelt: list[str] = []
    for (kind, count), values in zip(collapsed, reversed(ends[:-1]), strict=True):
        if not kind:
            # Inserting later costs the same and D is less than I.
            spelt += ["D"] * count
            continue
        inside = [_normal(values)]
        for _ in range(count - 1):
            inside.append(_one_before(kind, inside[-1]))
        for after in reversed(inside):
            edits, state = _choice(kind, state, after)
            spelt.append(edits)
    return spelt, state


def closing(state: int) -> str:
    """What is inserted after the last turn."""
    spelt = ""
    while state not in (_START, _ASSISTANT):
        spelt, state = spelt + "I", _spoken(state)
    return spelt


# --- one conversation in order ----------------------------------------------


class Account:
    """What is returned of a conversation, gathered turn by turn."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.low = self.high = None
        self.turns = 0
        self._audit: list[str] = []
        self._sum = hashlib.sha256()
        self._lines = 0
        self._state = _START
        self._initial: str | None = None

    def _line(self, role: str, text: str) -> None:
        self._sum.update((("\n" if self._lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self._lines += 1

    def _insert(self) -> None:
        self._state = _spoken(self._state)
        self._line(_ROLES[self._state], "")

    def add(self, row: dict, first: bool, edits: str) -> None:
        """A turn and its ``times - 1`` repetitions, which have to go."""
        initial, times = row["initial"], row["times"]
        if row["turn"] is not None and row["turn"] != self.high:
            self.low = row["turn"] if self.low is None else self.low
            self.high = row["turn"]
            self.turns += 1
        if self._initial is not None and self._initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += times - 1
        self._initial = initial
        if row["blank"]:
            self.blank += times
        else:
            self.duplicate += times - first
            self.truncated += first and row["cut"]
        for _ in edits[:-1]:
            self._insert()
        if edits[-1] == "K":
            self._state = _NEXT[self._state][initial]
            self._line(row["role"], row["text"])
        elif edits[-1] == "R":
            self._state = _spoken(self._state)
            self._line(_ROLES[self._state], row["text"])
        self._audit += [edits, "D" * (times - 1)]

    def state(self) -> int:
        return self._state

    def close(self) -> tuple:
        edits = closing(self._state)
        for _ in edits:
            self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join([*self._audit, edits])
        counts = (self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return min(gaps, (1 << 63) - 1), *counts, audit, self._sum.hexdigest()


_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = ["conv", *[part.split()[0] for part in _FOUND.split(", ")]]


def _kind(blank: bool, first: bool, cut: bool, initial: str) -> int:
    if blank or not first:
        return 0
    return 1 + 2 * max(0, _INITIALS.find(initial or " ")) + cut


def _whole(rows: list[dict]) -> tuple:
    """A conversation that fits a task, its turns in order."""
    account = Account()
    rows = [row for row in rows if row["times"]]
    seen: set[tuple[str, str]] = set()
    firsts, kinds = [], []
    for row in rows:
        said = (row["role"], row["text"])
        firsts.append(said not in seen)
        seen.add(said)
        kinds.append(_kind(row["blank"], firsts[-1], row["cut"], row["initial"]))
    # Repetitions have to go whatever stands around them.
    collapsed = runs((kind, 1) for kind in kinds)
    ends = values_before(collapsed, _END)
    account.cost = ends[-1][_START] + sum(DELETE * (row["times"] - 1) for row in rows)
    edits, _ = unroll(collapsed, ends, _START)
    for row, first, spelt in zip(rows, firsts, edits, strict=True):
        account.add(row, first, spelt)
    return account.close()


# --- tables -----------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, times)``: turns made faulty by a checksum of
    their place, to have something to repair. Dropped ones have ``times`` 0."""
    blank = F.lit(" ")
    place = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    fate = F.crc32(place.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    return turns.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, _ENDS, "")).otherwise(text).alias("text"),
        F.when(fate == 0, F.lit(0)).when(fate == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"),
    )


def _marked(turns: DataFrame, times: str | None) -> DataFrame:
    """Turns with the flags that their faults follow from."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    count = F.col(times).cast("bigint") if times else F.lit(1).cast("bigint")
    rows = turns.select(
        # Never null, and null conversations apart from all others.
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        # A dropped turn only says that there is a conversation.
        F.when(count > 0, text).otherwise(F.lit("")).alias("text"),
        count.alias("times"),
    )
    said = F.rtrim(F.col("text"), F.lit(_BLANKS))
    return rows.withColumns(
        {
            "blank": said == "",
            "cut": ~F.right(said, F.lit(1)).isin(*_ENDS),
            "initial": F.substring("role", 1, 1),
        }
    )


def _by_turn() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def repair(turns: DataFrame, times: str | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)`` of ``turns(conv_id, turn, role, text)``.

    ``times`` names a column that tells how often a row occurs; a conversation
    whose rows all occur 0 times is returned nevertheless.
    """
    spark = turns.sparkSession
    rows = _marked(turns, times)
    sizes = rows.groupBy("key").agg(
        F.sum("times").alias("n"), F.sum((F.octet_length("text") + 16) * F.greatest("times", F.lit(1))).alias("bytes")
    )
    over = (F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)
    long = settle(sizes.where(over).select("key", F.lit(True).alias("long")), scratch_path(spark, "long"))
    count = long.count()
    if not count:
        return _repaired(_short(rows))
    if count <= _BROADCAST_KEYS:
        marked = rows.join(F.broadcast(long), "key", "left")
    else:
        marked = lookup(rows, long, "key", "text", "left")
    short = _short(marked.where("long IS NULL").drop("long"))
    return _repaired(short.unionByName(_segmented(marked.where("long").drop("long"))))


def _repaired(found: DataFrame) -> DataFrame:
    return found.withColumnRenamed("conv", "conv_id")


def _short(rows: DataFrame) -> DataFrame:
    """Conversations of bounded size, one after another in each task."""
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, {_FOUND}"
    ordered = rows.repartition("key").sortWithinPartitions("key", *_by_turn())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = (row for batch in batches for row in batch.to_pylist())
        done = []
        for _, own in groupby(turns, key=lambda row: row["key"]):
            rows = list(own)
            done.append((rows[0]["conv"], *_whole(rows)))
            if len(done) == 1000:
                yield _batch(done, kind)
                done = []
        yield _batch(done, kind)

    kind = _arrow_type(rows)
    return ordered.mapInArrow(each, schema)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv"].dataType)


def _batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    columns = list(zip(*done, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], _NAMES)


def _segmented(rows: DataFrame) -> DataFrame:
    """Conversations of any size, in segments; the same result as ``_short``."""
    spark = rows.sparkSession
    conv, found = rows.schema["conv"].dataType.simpleString(), _arrow_type(rows)
    # Equal rows are one with a count, so repeated ones make no segment longer.
    alike = rows.where("times > 0").groupBy(*[c for c in rows.columns if c != "times"]).agg(F.sum("times").alias("times"))
    said = F.sha2(F.concat_ws("\0", "key", F.octet_length("role").cast("string"), "role", "text"), 256)
    alike = settle(alike.withColumn("said", said), scratch_path(spark, "turns"))
    when = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    earliest = alike.groupBy("said").agg(F.min(when).alias("earliest"))
    placed = lookup(alike, earliest, "said", "turn").withColumn("first", F.col("earliest") == when).drop("earliest", "said")
    width = shuffle_width(spark)
    ranged = placed.repartitionByRange(width, "key", F.col("turn").asc_nulls_first(), "role", F.left("text", F.lit(256)))
    ordered = ranged.sortWithinPartitions("key", *_by_turn()).withColumn("at", F.monotonically_increasing_id())
    ordered = settle(ordered, scratch_path(spark, "turns")).withColumn("segment", F.col("at") - F.col("at") % SEGMENT)

    known = F.coalesce(*[F.when(F.col("initial") == letter, i) for i, letter in enumerate(_INITIALS)], F.lit(0))
    kind = F.when(F.col("blank") | ~F.col("first"), 0).otherwise(1 + 2 * known + F.col("cut").cast("int"))
    kinds = ordered.select("key", "segment", "at", kind.cast("int").alias("kind"), "times")

    def measure(table: pa.Table) -> pa.Table:
        turns = table.sort_by("at")
        matrix = matrix_of(runs((kind, 1) for kind in turns["kind"].to_pylist()))
        cost = DELETE * sum(n - 1 for n in turns["times"].to_pylist())
        flat = [[value for row in matrix for value in row]]
        return pa.table({"key": [turns["key"][0].as_py()], "segment": [turns["segment"][0].as_py()], "matrix": pa.array(flat, pa.list_(pa.int64())), "more": [cost]})

    matrices = kinds.groupBy("key", "segment").applyInArrow(measure, "key string, segment long, matrix array<long>, more long")

    def backward(table: pa.Table) -> pa.Table:
        segments = sorted(table.to_pylist(), key=lambda row: row["segment"])
        values, ends = _END, []
        for row in reversed(segments):
            ends.append(values)
            flat = row["matrix"]
            values = _apply(tuple(tuple(flat[4 * i : 4 * i + 4]) for i in _STATES), values)
        cost = values[_START] + sum(row["more"] for row in segments)
        n = len(segments)
        return pa.table(
            {
                "key": [row["key"] for row in segments],
                "segment": [row["segment"] for row in segments],
                "values": pa.array([list(x) for x in reversed(ends)], pa.list_(pa.int64())),
                "cost": pa.array([cost] * n, pa.int64()),
            }
        )

    # One short row per segment.
    ends = matrices.groupBy("key").applyInArrow(backward, "key string, segment long, values array<long>, cost long")

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        turns, end = left.sort_by("at"), right.to_pylist()[0]
        collapsed = runs((kind, 1) for kind in turns["kind"].to_pylist())
        bounds = values_before(collapsed, tuple(end["values"]))
        spelt = ["".join(unroll(collapsed, bounds, state)[0]) for state in _STATES]
        return pa.table({"key": [end["key"]], "segment": [end["segment"]], "spelt": pa.array([spelt], pa.list_(pa.string())), "cost": [end["cost"]]})

    chosen = kinds.groupBy("key", "segment").cogroup(ends.groupBy("key", "segment"))
    heads = chosen.applyInArrow(choose, "key string, segment long, spelt array<string>, cost long")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = (row for batch in batches for start in range(0, batch.num_rows, 100) for row in batch.slice(start, 100).to_pylist())
        for _, own in groupby(turns, key=lambda row: row["key"]):
            account, edits, of = Account(), iter(()), None
            for row in own:
                if row["at"] < 0:
                    edits, account.cost = iter(row["spelt"][account.state()]), row["cost"]
                    continue
                of = row["conv"]
                spelt = ""
                while not spelt or spelt[-1] == "I":
                    spelt += next(edits)
                account.add(row, row["first"], spelt)
            yield _batch([(of, *account.close())], found)

    none = {name: F.lit(None).cast(ordered.schema[name].dataType) for name in ordered.columns}
    headed = heads.select(
        *[(F.lit(-1).cast("bigint") if name == "at" else F.col(name) if name in ("key", "segment") else none[name]).alias(name) for name in ordered.columns],
        "spelt",
        "cost",
    )
    bare = ordered.withColumns({"spelt": F.lit(None).cast("array<string>"), "cost": F.lit(None).cast("bigint")})
    stream = headed.unionByName(bare).repartition("key").sortWithinPartitions("key", "segment", "at")
    return stream.mapInArrow(follow, f"conv {conv}, {_FOUND}")

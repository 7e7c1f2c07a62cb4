"""Conversation structure repair by a run-length dynamic programme.

Rows of a conversation, in the order of their turns, become symbols: the initial of the role and
whether the row must go (blank or a repeat) or is truncated. The cheapest edits that give role
initials ``(s?(ua)+)?`` are found over four states: nothing yet, after s, after u, after a. Every
symbol is a 4 x 4 min-plus matrix: the least cost from state to state over that row, inserts before
it included. Equal consecutive symbols are one run, and a run of n rows is applied through the
binary powers of its matrix, which a worker computes once. Costs are carried from the last run to
the first; then choices are unrolled from the first row on, a run split at powers of two, and of the
edits that reach the least cost the one whose initial comes first is taken. A configuration and an
initial determine what follows, so this is the least audit of all cheapest ones.

Distribution. Rows are shuffled by conversation and sorted within their partition, and a task
reads them as a stream. The first pass carries symbols without texts and keeps the runs of one conversation;
the second reads texts in the same order behind the audit and keeps one hash state. So memory
follows the audit, which is a single value of the result, and never the texts. The hash of a whole
conversation is sequential by its definition; a conversation with very many rows takes one task as
long as its texts take to hash.

Handling. Null roles and texts are one space, as are null parts of the damage key. Rows with a null
conv_id are one conversation, and null turns come first. Rows of equal turn are ordered by the MD5 of
role and text, so reruns agree and repeated rows lie side by side. A row whose role has another
initial than s, u, a (none, for an empty role) can be reroled or deleted only. Texts may have any
length. Conversations without rows give zeros, an empty audit and the hash of the empty text; an
empty table gives an empty result. Only conv_id, turn, role and text are read, so further columns may
have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

# ---- Fixed values: edits, their costs and the damage of the query -------------------------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
EVERY = 20
DROPS, EMPTIES, CUTS, REPEATS, TO_USER = range(5)
LEGAL = ("su", "ua", "au")
NONE, BLANK, DUPLICATE, CUT = range(4)

ROLES = {"u": "user", "a": "assistant"}
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_FAR = 1 << 60
#: State after emitting an initial, from each state.
_NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The only user or assistant turn that may come next.
_WANTED = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in zip(*b)) for row in a)


def _apply(m: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in m)


def _inserts() -> Matrix:
    rows = []
    for start in range(4):
        row, state, cost = [_FAR] * 4, start, 0
        for _ in range(4):  # further inserts only come back to a state
            row[state] = min(row[state], cost)
            state, cost = _NEXT[state, _WANTED[state]], cost + INSERT
        rows.append(tuple(row))
    return tuple(rows)


INSERTS = _inserts()
#: Costs after the last row: a conversation may end empty or after an assistant.
END = _apply(INSERTS, (0, _FAR, _FAR, 0))


def _options(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(initial of the edit, cost, next state) of the edits that use up a row, in ASCII order."""
    found = [("D", DELETE, state)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        if (state, symbol.lower()) in _NEXT:
            found.append(("K", KEEP + extra, _NEXT[state, symbol.lower()]))
        found.append(("R", REROLE + extra, _NEXT[state, _WANTED[state]]))
    return found


class Powers:
    """Min-plus powers of the symbols' matrices with exponents 1, 2, 4, ..."""

    def __init__(self) -> None:
        self.known: dict[str, list[Matrix]] = {}

    def __call__(self, symbol: str, k: int) -> Matrix:
        powers = self.known.get(symbol)
        if powers is None:
            rows = []
            for state in range(4):
                row = [_FAR] * 4
                for _, cost, after in _options(symbol, state):
                    row[after] = min(row[after], cost)
                rows.append(tuple(row))
            powers = self.known[symbol] = [_product(INSERTS, tuple(rows))]
        while len(powers) <= k:
            powers.append(_product(powers[-1], powers[-1]))
        return powers[k]

    def over(self, symbol: str, n: int, v: Vector) -> Vector:
        """Costs before a run of ``n`` rows from the costs behind it."""
        k = 0
        while n >> k:
            if n >> k & 1:
                v = _apply(self(symbol, k), v)
            k += 1
        return v


_POWERS = Powers()


def _unroll(symbol: str, n: int, state: int, behind: Vector, audit: list[str]) -> int:
    """Appends the edits of ``n`` equal rows and returns the state behind them."""
    if n > 1:
        half = 1 << ((n - 1).bit_length() - 1)  # the first part; the rest is at most as long
        state = _unroll(symbol, half, state, _POWERS.over(symbol, n - half, behind), audit)
        return _unroll(symbol, n - half, state, behind, audit)
    here = _apply(_POWERS(symbol, 0), behind)
    while True:
        options = {letter: (cost, after) for letter, cost, after in _options(symbol, state)}
        after_insert = _NEXT[state, _WANTED[state]]
        if options["D"][0] + behind[state] == here[state]:
            audit.append("D")
            return state
        if INSERT + here[after_insert] == here[state]:
            audit.append("I")
            state = after_insert
            continue
        for letter in "KR":
            if letter in options and options[letter][0] + behind[options[letter][1]] == here[state]:
                audit.append(letter)
                return options[letter][1]
        raise AssertionError("a state without an edit of least cost")


def cheapest(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation given as runs of symbols."""
    behind = [END]
    for symbol, n in reversed(runs):
        behind.append(_POWERS.over(symbol, n, behind[-1]))
    behind.reverse()
    audit: list[str] = []
    state = START
    for at, (symbol, n) in enumerate(runs):
        state = _unroll(symbol, n, state, behind[at + 1], audit)
    while state not in (START, AFTER_A):
        audit.append("I")
        state = _NEXT[state, _WANTED[state]]
    return behind[0][START], "".join(audit)


# ---- Rows ---------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped: the rows after the damage that their key names.

    Dropped rows stay, marked, so that every conversation is seen.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % EVERY
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", kind.alias("kind"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text")).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(F.col("kind") == TO_USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTIES, "").when(F.col("kind") == CUTS, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == DROPS).alias("dropped"),
        F.explode(F.when(F.col("kind") == REPEATS, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def unchanged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, for conversations that need no planted damage."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("dropped"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("mark").asc()]


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, mark, initial, fault and dropped of staged rows; no texts."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    closed = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    marked = rows.select(
        "conv_id", "turn", "mark", "dropped", F.substring("role", 1, 1).alias("initial"),
        F.when(blank, BLANK).when(~closed, CUT).otherwise(NONE).alias("own"),
    )
    earlier = F.row_number().over(Window.partitionBy("conv_id", "dropped", "mark").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(F.col("own") == BLANK, BLANK).when(earlier, DUPLICATE).otherwise(F.col("own"))
    return marked.withColumn("fault", fault).drop("own")


class _Conversation:
    """What the first pass keeps of a conversation while its rows go by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.runs: list[list] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = 0
        self.initial: str | None = None
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.faults[fault] += 1
        known = initial if initial in ("s", "u", "a") else "o"
        symbol = "x" if fault in (BLANK, DUPLICATE) else known.upper() if fault == CUT else known
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        cost, audit = cheapest([(s, n) for s, n in self.runs])
        return self.conv_id, gaps, *self.faults[BLANK:], self.illegal, cost, audit


AUDIT_DDL = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_AUDIT_SCHEMA = pa.schema([(p.split()[0], pa.string() if p.split()[1] == "string" else pa.int64()) for p in AUDIT_DDL.split(", ")])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Conversation | None = None
    for batch in batches:
        done = []
        for conv_id, turn, initial, fault, dropped in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "dropped"))):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(conv_id)
            if not dropped:
                current.add(turn, initial, fault)
        yield _table(done, _AUDIT_SCHEMA)
    if current is not None:
        yield _table([current.result()], _AUDIT_SCHEMA)


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and audit of the cheapest edits."""
    placed = with_faults(rows).repartition("conv_id").sortWithinPartitions("conv_id", "dropped", *_order())
    return placed.mapInArrow(_audit, AUDIT_DDL)


class _Repair:
    """Follows an audit over the rows of a conversation."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _insert(self) -> Iterator[str]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            wanted = _WANTED[self.state]
            self.state, self.at = _NEXT[self.state, wanted], self.at + 1
            yield f"{ROLES[wanted]}:"

    def row(self, role: str, text: str) -> Iterator[str]:
        yield from self._insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = _NEXT[self.state, role[0]]
            yield f"{role}:{text}"
        elif edit == "R":
            wanted = _WANTED[self.state]
            self.state = _NEXT[self.state, wanted]
            yield f"{ROLES[wanted]}:{text}"

    def rest(self) -> Iterator[str]:
        yield from self._insert()


RESULT_DDL = f"{AUDIT_DDL}, repaired_sha256 string"
_RESULT_SCHEMA = _AUDIT_SCHEMA.append(pa.field("repaired_sha256", pa.string()))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = repair = state = None
    started = False

    def feed(lines: Iterator[str]) -> None:
        nonlocal started
        for line in lines:
            if started:
                state.update(b"\n")
            started = True
            state.update(line.encode())

    names = [f.name for f in _AUDIT_SCHEMA]
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["audit"] is not None:  # the conversation's first row
                if head is not None:
                    feed(repair.rest())
                    done.append((*head, state.hexdigest()))
                head, repair, state, started = tuple(row[n] for n in names), _Repair(row["audit"]), hashlib.sha256(), False
            else:
                feed(repair.row(row["role"], row["text"]))
        yield _table(done, _RESULT_SCHEMA)
    if head is not None:
        feed(repair.rest())
        yield _table([(*head, state.hexdigest())], _RESULT_SCHEMA)


def repaired(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired text of every conversation.

    ``rows`` come from ``damaged`` or ``unchanged``.
    """
    mark = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    rows = stage(rows.withColumn("mark", mark), "turns")
    found = stage(audits(rows), "audits")
    heads = found.select("*", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("mark"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = rows.where(~F.col("dropped")).select("conv_id", "turn", "mark", "role", "text")
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    ordered = both.sortWithinPartitions(F.col("conv_id"), F.col("audit").isNull().asc(), *_order())
    return ordered.mapInArrow(_hash, RESULT_DDL)

"""Conversation structure repair: the cheapest edits that make the roles of a conversation read
``(s?(ua)+)?``, found by a checkpointed dynamic program.

The state of a conversation read from its start is one of four: nothing yet, after the system row, after
a user row, after an assistant row. Backward over the rows, a vector holds for every state the cost of the
rest. Of n rows only about the square root of n vectors are kept; walking forward, the vectors of one
block are worked out again from the checkpoint at its end, and of the edits that keep to the least cost
that of the least letter is taken. So a conversation needs one byte a row, its edits, and two blocks of
vectors.

Rows stream through the tasks in order, texts are never gathered: the edits are found on narrow rows, and
a second stream meets them at the head of its conversation and carries them out row by row. A conversation
is one sequence, with one digest over all of it, so one task reads it from start to end however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import batched, chain, groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from scoutline.llm.words import small_batches
from scoutline.session import stored

DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled row, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
#: The state after a kept row, by state and initial.
KEPT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
#: Cost of ending in each state: what is missing is inserted.
END = (0, 2 * INSERT_COST, INSERT_COST, 0)

# A row's code: its initial (3: any other), and whether it must go or counts as truncated. A row
# that only stands for its conversation is ABSENT.
MUST_GO, TRUNCATED, ABSENT = 4, 8, 64
SPACES = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def costs_before(code: int, after: Vector) -> Vector:
    """Least cost from each state before a row, given that after it."""
    best = [DELETE_COST + c for c in after]
    if not code & MUST_GO:
        extra = TRUNCATED_COST if code & TRUNCATED else 0
        for state in range(4):
            best[state] = min(best[state], REROLE_COST + extra + after[NEXT[state]])
            kept = KEPT[state].get(code & 3)
            if kept is not None:
                best[state] = min(best[state], extra + after[kept])
    user, assistant = best[USER], best[ASSISTANT]
    user, assistant = min(user, INSERT_COST + assistant), min(assistant, INSERT_COST + user)
    return min(best[START], INSERT_COST + user), min(best[SYSTEM], INSERT_COST + user), user, assistant


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Least cost of repairing rows of these codes, and the ASCII-least edits of that cost."""
    n = len(codes)
    size = max(1, isqrt(n))
    vector, checkpoints = END, {n: END}
    for i in range(n - 1, -1, -1):
        vector = costs_before(codes[i], vector)
        if i % size == 0:
            checkpoints[i] = vector
    cost, edits, state = vector[START], bytearray(), START
    for begin in range(0, n, size):
        end = min(begin + size, n)
        block = [checkpoints[end]]
        for i in range(end - 1, begin - 1, -1):
            block.append(costs_before(codes[i], block[-1]))
        block.reverse()
        i = begin
        while i < end:
            code, now, after = codes[i], block[i - begin], block[i + 1 - begin]
            extra = TRUNCATED_COST if code & TRUNCATED else 0
            if now[state] == DELETE_COST + after[state]:
                edits += b"D"
                i += 1
            elif now[state] == INSERT_COST + now[NEXT[state]]:
                edits += b"I"
                state = NEXT[state]
            else:
                kept = KEPT[state].get(code & 3)
                if kept is not None and now[state] == extra + after[kept]:
                    edits += b"K"
                    state = kept
                else:
                    edits += b"R"
                    state = NEXT[state]
                i += 1
    while END[state]:
        edits += b"I"
        state = NEXT[state]
    return cost, edits.decode()


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20.

    Remainder 0 drops a row (it stays with ``absent`` set, so that its conversation is known), 1 empties the
    text, 2 takes out ``.!?``, 3 repeats the row, 4 makes the role ``user``. NULLs count as one space. Returns
    conv_id, turn, role, text, copy and absent; other columns are left out.
    """
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv_id, F.lit(":"), turn)
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20)).cast("int")
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("fault") == 0).alias("absent"),
        F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", "absent", F.explode("copies").alias("copy"))


def coded(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with ``digest`` of the text and ``code``, all but whether a row is a
    duplicate. ``copy`` and ``absent`` may be there as well; NULL role and text count as one space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    copy = F.col("copy") if "copy" in turns.columns else F.lit(0)
    absent = F.col("absent") if "absent" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copy.alias("copy"), absent.alias("absent"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(last == "", MUST_GO).when(last.isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    code = F.when(F.col("absent"), ABSENT).otherwise(letter + fault)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        F.when(~F.col("absent"), F.col("text")).alias("text"),
        "copy",
        F.unhex(F.sha2(F.col("text"), 256)).alias("digest"),
        code.cast("int").alias("code"),
    )


#: Where a row stands in its conversation. Rows of one turn are ordered by role and digest, copies are alike.
_ORDER = ("turn", "role", "digest", "copy")


def _conversations(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows); the rows are read once, and before the next conversation is."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        return zip(*(batch.column(c).to_pylist() for c in columns))

    return groupby(chain.from_iterable(map(rows, batches)), key=lambda r: r[0])


def _batches(rows: Iterable[tuple], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for part in batched(rows, size):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _schema(rows: DataFrame, *fields: tuple[str, T.DataType]) -> tuple[pa.Schema, T.StructType]:
    """The id of ``rows`` and more fields, for Arrow and for Spark."""
    kind = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *(T.StructField(*f) for f in fields)])
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kind]), kind


def _report(key: object, rows: Iterator[tuple]) -> tuple:
    codes, turns, least, most = bytearray(), 0, None, None
    blank = duplicate = truncated = illegal = 0
    before = None
    for _, turn, initial, code, again in rows:
        if code == ABSENT:
            continue
        if turn is not None:
            turns += turn != most
            least, most = turn if least is None else least, turn
        if code & MUST_GO:
            blank += 1
        elif again:
            duplicate += 1
            code = code & 3 | MUST_GO
        elif code & TRUNCATED:
            truncated += 1
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        codes.append(code)
    gaps = most - least + 1 - turns if turns else 0
    return key, gaps, blank, duplicate, truncated, illegal, *cheapest_edits(bytes(codes))


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation of coded rows: gaps, blank, duplicate, truncated, illegal, cost and audit.

    Only narrow rows are shuffled. Duplicates are marked by a window over (conversation, role, digest), so that
    no task remembers the texts of a conversation.
    """
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema, kind = _schema(rows, *((n, T.LongType()) for n in counts), ("audit", T.StringType()))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _conversations(batches, ["conv_id", "turn", "initial", "code", "again"])
        return _batches((_report(key, group) for key, group in groups), 2_000, schema)

    alike = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"), "copy")
    narrow = rows.select("conv_id", "turn", "role", "digest", "copy", "code")
    there = narrow.where(F.col("code") != ABSENT).withColumn("again", F.row_number().over(alike) > 1)
    marked = there.unionByName(narrow.where(F.col("code") == ABSENT).withColumn("again", F.lit(False)))
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), *_ORDER[1:])
    return ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "code", "again").mapInArrow(told, kind)


def _carried_out(audit: str, rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired conversation; ``rows`` are (role, text) in order."""
    state = START
    for edit in audit:
        if edit == INSERT:
            state = NEXT[state]
            yield edit, ROLES[state], ""
            continue
        role, text = next(rows)
        if edit == KEEP:
            state = KEPT[state][INITIALS.index(role[0])]
            yield edit, role, text
        elif edit == REROLE:
            state = NEXT[state]
            yield edit, ROLES[state], text


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Coded rows in order, each conversation headed by a row with its edits."""
    head = found.select("conv_id", F.lit(0).alias("part"), "audit")
    both = rows.where(F.col("code") != ABSENT).withColumn("part", F.lit(1)).unionByName(head, allowMissingColumns=True)
    order = ["conv_id", "part", F.asc_nulls_first("turn"), *_ORDER[1:]]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]]]]:
    for key, rows in _conversations(batches, ["conv_id", "audit", "role", "text"]):
        _, audit, _, _ = next(rows)
        yield key, _carried_out(audit, ((role, text) for _, _, role, text in rows))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role and text."""
    texts = ((n, T.StringType()) for n in ("edit", "role", "text"))
    schema, kind = _schema(rows, ("place", T.LongType()), *texts)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ((key, i, *row) for key, done in _edited(batches) for i, row in enumerate(done))
        return _batches(out, 500, schema)

    return _streamed(rows, found).mapInArrow(turns, kind)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 over the lines ``role:text`` of every repaired conversation."""
    schema, kind = _schema(rows, ("repaired_sha256", T.StringType()))

    def of_one(done: Iterator[tuple[str, str, str]]) -> str:
        digest, between = hashlib.sha256(), ""
        for _, role, text in done:
            digest.update(f"{between}{role}:{text}".encode())
            between = "\n"
        return digest.hexdigest()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((key, of_one(done)) for key, done in _edited(batches)), 2_000, schema)

    return _streamed(rows, found).mapInArrow(hashed, kind)


def repair(turns: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation.

    A row's first fault counts: blank, duplicate of an earlier row of its conversation (role and text), or
    truncated (its last character is none of ``.!?``). Rows are taken by turn, NULL turns first; rows of one turn
    by role and a digest of the text. Roles count by their first letter. A NULL conv_id is a conversation like
    any other; a conversation without rows has zeros, no edits and the digest of nothing. An empty table
    gives no rows; other columns are not read.
    """
    small_batches(turns.sparkSession)
    rows = stored(coded(turns), "turns")
    found = stored(reports(rows), "repairs")
    told = digests(rows, found)
    same = found["conv_id"].eqNullSafe(told["conv_id"])
    return found.join(told, same).select(found["*"], told["repaired_sha256"])

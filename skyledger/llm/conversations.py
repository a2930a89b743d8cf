"""Conversations repaired at least cost to a system turn, if any, and pairs of user and assistant turns.

The cheapest edits of a conversation come from a depth-first branch and bound. A node is the number of rows
that are done and what was put out last. An explicit stack holds open nodes, the next edit by letter on top, so
edits are tried in the order of their text. A suffix lower bound, which only leaves out that an
assistant must have the last word, cuts what cannot reach the incumbent's cost; a table per node cuts prefixes
that come to it no cheaper than an earlier, so smaller, one. When the stack is empty, the incumbent (cost, audit) is
proved best.

Spark deals the rows by conversation and sorts them. Rows without their texts come first, one byte of
each and a hash is held until its conversation ends; texts follow in a second pass, which knows the edits
and holds one row at a time.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.common import saved

# Fixed by the query contract: white space, the ends of a whole sentence, and the costs of edits.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SENTENCE_ENDS = ".!?"
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1

# What a row's code says: its role's initial, and its fault times four.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

# What was put out last; at the start nothing was. Then the role that an inserted or changed row gets.
START = OTHER
NEXT_ROLE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row: edit, cost and next state, by letter."""
    letter, fault = code & 3, code >> 2
    edits = [("D", DELETE, state)]
    if fault < BLANK:
        left = LEFT_TRUNCATED if fault == TRUNCATED else 0
        wanted = NEXT_ROLE[state]
        if letter == wanted or (letter == SYSTEM and state == START):
            edits.append(("K", left, letter))
        edits.append(("R", REROLE + left, wanted))
    return edits


def _suffix_bounds(codes: bytes) -> list[list[int]]:
    """For each number of rows done and each state, a cost that the rest has at least; the last word is free."""
    bounds = [[0, 0, 0, 0]]
    for code in reversed(codes):
        after = bounds[-1]
        here = [min(cost + after[to] for _, cost, to in _edits(code, state)) for state in range(4)]
        here[USER], here[ASSISTANT] = min(here[USER], here[ASSISTANT] + INSERT), min(here[ASSISTANT], here[USER] + INSERT)
        for state in (START, SYSTEM):
            here[state] = min(here[state], here[USER] + INSERT)
        bounds.append(here)
    return bounds[::-1]


def _children(codes: bytes, done: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edit, cost, rows done and state of all nodes after this one, by letter."""
    children = [("I", INSERT, done, NEXT_ROLE[state])]
    if done < len(codes):
        children += [(edit, cost, done + 1, to) for edit, cost, to in _edits(codes[done], state)]
    return sorted(children)


def _is_whole(codes: bytes, done: int, state: int) -> bool:
    return done == len(codes) and state in (START, ASSISTANT)


def _dive(codes: bytes, bounds: list[list[int]]) -> tuple[int, str]:
    """A first incumbent: at each node the edit of the least bound, whose end pays for the last word."""
    done, state, total, audit = 0, START, 0, []
    while not _is_whole(codes, done, state):
        edit, cost, done, state = min(_children(codes, done, state), key=lambda c: (c[1] + bounds[c[2]][c[3]], c[2] == done))
        total += cost
        audit.append(edit)
    return total, "".join(audit)


@lru_cache(maxsize=4096)
def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, of the ASCII-least audit among several.

    ``codes``: one byte per row, see above. The nodes expanded are at most four per row times the least costs that
    lie between bound and incumbent, of which there are few.
    """
    bounds = _suffix_bounds(codes)
    best_cost, best_audit = _dive(codes, bounds)
    proved_least = False  # the incumbent comes from the search, so no later audit of its cost is less
    cheapest = [[best_cost + 1] * 4 for _ in range(len(codes) + 1)]
    path: list[str] = []
    stack = [("", 0, 0, START, 0)]
    while stack:
        edit, cost, done, state, depth = stack.pop()
        del path[max(depth - 1, 0):]
        path.append(edit)
        bound = cost + bounds[done][state]
        if bound > best_cost or (bound == best_cost and proved_least) or cost >= cheapest[done][state]:
            continue
        cheapest[done][state] = cost
        if _is_whole(codes, done, state):
            best_cost, best_audit, proved_least = cost, "".join(path), True
            continue
        for edit, more, then, to in reversed(_children(codes, done, state)):
            stack.append((edit, cost + more, then, to, depth + 1))
    return best_cost, best_audit


def _lettered(role: str) -> int:
    return INITIALS.get(role[:1], OTHER)


class _Conversation:
    """What is held of a conversation until it ends: some 17 bytes a row, of which one stays in its audit."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.hashes = array("q")
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.illegal = 0

    def add(self, turn: int | None, letter: int, fault: int, h1: int, h2: int) -> None:
        if self.codes and (self.codes[-1] & 3, letter) not in LEGAL_PAIRS:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        self.codes.append(letter | fault << 2)
        self.hashes.extend((h1, h2))

    def report(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit."""
        codes = np.frombuffer(bytes(self.codes), np.uint8).copy()
        pairs = np.frombuffer(self.hashes, np.int64).reshape(-1, 2)
        order = np.lexsort((np.arange(len(codes)), pairs[:, 1], pairs[:, 0]))
        again = order[1:][(pairs[order[1:]] == pairs[order[:-1]]).all(axis=1)]
        again = again[codes[again] >> 2 != BLANK]
        codes[again] = codes[again] & 3 | DUPLICATE << 2
        blank, duplicate, truncated = (int((codes >> 2 == fault).sum()) for fault in (BLANK, DUPLICATE, TRUNCATED))
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (gaps, blank, duplicate, truncated, self.illegal, *cheapest_edits(codes.tobytes()))


def _reports(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per conversation of sorted rows (id, present, turn, letter, fault, h1, h2)."""
    started, name, current = False, None, _Conversation()
    for batch in batches:
        found = []
        for id_, present, *row in zip(*(batch.column(c).to_pylist() for c in ("_id", "present", "turn", "letter", "fault", "h1", "h2"))):
            if not started or id_ != name:
                if started:
                    found.append((name, *current.report()))
                started, name, current = True, id_, _Conversation()
            if present:
                current.add(*row)
        yield _batch(found, schema)
    if started:
        yield _batch([(name, *current.report())], schema)


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one partition, its rows in order."""
    order = [c for c in ("_id", *first, "turn", "role", "h1", "h2") if c in rows.columns]
    return rows.repartition("_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in order])


REPORT = "_gaps long, _blank long, _duplicate long, _truncated long, _illegal long, _cost long, _audit string"


def conversation_rows(conversations: DataFrame, columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"), present: Column | None = None) -> DataFrame:
    """_id, turn, role, text, present, and a hash of role and text: what the functions below take.

    A NULL role or text is one space. Rows for which ``present`` does not hold only keep their conversation listed.
    """
    id_, turn, role, text = (F.col(c) for c in columns)
    rows = conversations.select(
        id_.alias("_id"), turn.cast("long").alias("turn"),
        F.coalesce(role.cast("string"), F.lit(" ")).alias("role"), F.coalesce(text.cast("string"), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    )
    return rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role")})


def audit_conversations(rows: DataFrame) -> DataFrame:
    """_id, _gaps, _blank, _duplicate, _truncated, _illegal, _cost, _audit of every conversation of :func:`conversation_rows`.

    Rows go by turn, NULL first, then by role and a hash of the text. Rows without an id are one conversation. The
    first fault of each row counts: blank (only white space), duplicate (role and text of an earlier row), truncated
    (no sentence ends it). Turns that none of a conversation's rows has between its first and last are gaps. Edits by
    letter: D(elete), I(nsert), K(eep), R(erole). A conversation without present rows has zeros and an empty audit; so has
    one whose rows all go, but for their cost. No rows, no report. A conversation of any length is read as a stream.
    """
    trimmed = F.btrim("text", F.lit(BLANKS))
    ends = F.substring(trimmed, -1, 1).isin(*SENTENCE_ENDS)
    fault = F.when(trimmed == "", BLANK).when(~ends, TRUNCATED).otherwise(SOUND)
    letter = F.lit(OTHER)
    for initial, code in INITIALS.items():
        letter = F.when(F.startswith("role", F.lit(initial)), code).otherwise(letter)
    slim = rows.select("_id", "present", "turn", "role", letter.alias("letter"), fault.alias("fault"), "h1", "h2")
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, {REPORT}"
    arrow = _arrow_schema(rows, schema)
    return _ordered(slim).mapInArrow(lambda batches: _reports(batches, arrow), schema)


def _arrow_schema(rows: DataFrame, schema: str) -> pa.Schema:
    return to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """What a stream of :func:`_with_audits` gives: ("start", id), ("row", role, text) for each row put out, ("read",) after a batch."""
    audit, at, last = "", 0, START

    def inserted() -> Iterator[tuple]:
        nonlocal at, last
        while at < len(audit) and audit[at] == "I":
            at, last = at + 1, NEXT_ROLE[last]
            yield "row", ROLE_NAMES[last], ""

    for batch in batches:
        for id_, head, role, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_audit", "role", "text"))):
            if head is not None:
                audit, at, last = head, 0, START
                yield "start", id_
            else:
                edit = audit[at]
                at += 1
                if edit == "K":
                    last = _lettered(role)
                    yield "row", role, text
                elif edit == "R":
                    last = NEXT_ROLE[last]
                    yield "row", ROLE_NAMES[last], text
            yield from inserted()
        yield ("read",)


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows that are present, each conversation behind a row with its audit."""
    heads = audits.select("_id", "_audit")
    texts = rows.filter("present").drop("present")
    return _ordered(texts.unionByName(heads, allowMissingColumns=True).withColumn("below", F.col("_audit").isNull()), "below")


def _batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in found], field.type) for k, field in enumerate(schema)], schema=schema)


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """_id, _place (from 1), role, text: the conversations after the edits of :func:`audit_conversations`. Inserted rows have an empty text."""
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, _place long, role string, text string"
    arrow = _arrow_schema(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, id_, place = [], None, 0
        for kind, *event in _repaired(batches):
            if kind == "start":
                id_, place = event[0], 0
            elif kind == "row":
                place += 1
                found.append((id_, place, *event))
            else:
                yield _batch(found, arrow)
                found = []

    return _with_audits(rows, audits).mapInArrow(run, schema)


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """_id, _sha256 of each conversation's repaired ``role:text``, joined by newlines, which are hashed as they are read."""
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, _sha256 string"
    arrow = _arrow_schema(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, started, id_, digest, join = [], False, None, hashlib.sha256(), b""
        for kind, *event in _repaired(batches):
            if kind == "start":
                if started:
                    found.append((id_, digest.hexdigest()))
                started, id_, digest, join = True, event[0], hashlib.sha256(), b""
            elif kind == "row":
                digest.update(join + ":".join(event).encode("utf-8", "surrogatepass"))
                join = b"\n"
            else:
                yield _batch(found, arrow)
                found = []
        if started:
            yield _batch([(id_, digest.hexdigest())], arrow)

    return _with_audits(rows, audits).mapInArrow(run, schema)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The report of :func:`audit_conversations` with _sha256, the digest of each repaired conversation."""
    audits = saved(audit_conversations(rows))
    digests = repaired_digests(rows, audits)
    return audits.join(digests, audits["_id"].eqNullSafe(digests["_id"])).select(*[audits[c] for c in audits.columns], "_sha256")

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import conversations

TABLE = "conv_id long, turn long, role string, text string"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
PAIRS = {"su", "ua", "au"}


def faults(rows):
    """The first fault of each row (role, text)."""
    seen, found = set(), []
    for role, text in rows:
        rest = text.strip(BLANKS)
        found.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def plain_repair(rows):
    """cost, audit and repaired rows: whole sequences by cost, then audit, from a queue, without bounds or tables."""
    fault = faults(rows)
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    queue = [(0, "", 0, "", ())]
    while queue:
        cost, audit, done, last, out = heapq.heappop(queue)
        if done == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        turn = wanted[last]
        # Two inserted rows in a row lead back to where they began.
        if not audit.endswith("II"):
            heapq.heappush(queue, (cost + 2, audit + "I", done, turn, (*out, (names[turn], ""))))
        if done < len(rows):
            role, text = rows[done]
            heapq.heappush(queue, (cost + 3, audit + "D", done + 1, last, out))
            if fault[done] in ("", "truncated"):
                more = 1 if fault[done] else 0
                if role[:1] == turn or (role[:1] == "s" and last == ""):
                    heapq.heappush(queue, (cost + more, audit + "K", done + 1, role[0], (*out, (role, text))))
                heapq.heappush(queue, (cost + 2 + more, audit + "R", done + 1, turn, (*out, (names[turn], text))))


def plain_report(rows):
    """The report on rows (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [(role, text) for _, role, text in rows]
    fault = faults(pairs)
    cost, audit, out = plain_repair(pairs)
    initials = [role[:1] for role, _ in pairs]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(fault.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(a + b not in PAIRS for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    ), out


def code_of(role, fault):
    kinds = {"": conversations.SOUND, "truncated": conversations.TRUNCATED, "blank": conversations.BLANK, "duplicate": conversations.DUPLICATE}
    return conversations._lettered(role) | kinds[fault] << 2


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", " "]
    texts = ["Yes.", "No!", "cut", "Cut here", "", " \t", "Why?"]
    return [(rng.choices(roles, (6, 6, 2, 1, 1, 1))[0], rng.choice(texts) + (str(k) + "." if rng.random() < 0.6 else "")) for k in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_edits_are_those_of_a_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 6))
        codes = bytes(code_of(role, fault) for (role, _), fault in zip(rows, faults(rows)))
        assert conversations.cheapest_edits(codes) == plain_repair(rows)[:2], rows


def test_bounds_never_exceed_what_the_rest_costs():
    rng = random.Random(9)
    for _ in range(50):
        rows = random_rows(rng, rng.randint(1, 6))
        codes = bytes(code_of(role, fault) for (role, _), fault in zip(rows, faults(rows)))
        bounds = conversations._suffix_bounds(codes)
        cost, audit = conversations.cheapest_edits(codes)
        done, state, paid = 0, conversations.START, 0
        for edit in audit:
            assert bounds[done][state] <= cost - paid
            _, more, done, state = next(c for c in conversations._children(codes, done, state) if c[0] == edit)
            paid += more
        assert paid == cost and conversations._is_whole(codes, done, state)


def test_a_long_conversation_takes_few_nodes(monkeypatch):
    rng = random.Random(3)
    rows = random_rows(rng, 20_000)
    codes = bytes(code_of(role, "" if fault == "duplicate" else fault) for (role, _), fault in zip(rows, faults(rows)))
    calls = 0
    children = conversations._children

    def counted(*args):
        nonlocal calls
        calls += 1
        return children(*args)

    monkeypatch.setattr(conversations, "_children", counted)
    cost, audit = conversations.cheapest_edits(codes)
    assert calls < 12 * len(rows) and audit.replace("I", "").__len__() == len(rows)


def plain_table(table):
    """conv -> rows (turn, role, text), in the operator's order up to rows of one turn and role."""
    found = defaultdict(list)
    for conv, turn, role, text in table:
        found[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for c, rows in found.items()}


def test_odd_rows_have_defined_results(spark):
    table = [
        (None, 0, "user", "No id."), (None, 1, "assistant", "Fine."),
        (1, None, "user", "No turn."), (1, 5, "assistant", None), (1, 9, None, "No role."),
        (2, 1, "user", "Same."), (2, 1, "user", "Same."), (2, 2, "assistant", "x" * 300_000),
        (3, 3, "", ""), (4, -7, "system", "Only."), (5, 2, "user", "Tie."), (5, 2, "assistant", "Tie too."),
        (6, None, "user", "a."), (6, None, "user", "a."),
    ]
    source = spark.createDataFrame(table, TABLE).withColumns({c: F.lit("x") for c in ("_id", "_audit", "h1", "present", "letter")})
    rows = conversations.conversation_rows(source)
    found = {r._id: tuple(r)[1:] for r in conversations.repair_conversations(rows).collect()}
    expected = {c: plain_report(part) for c, part in plain_table(table).items()}
    assert found == {c: report for c, (report, _) in expected.items()}
    out = defaultdict(list)
    for r in conversations.repaired_rows(rows, conversations.audit_conversations(rows)).orderBy("_id", "_place").collect():
        out[r._id].append((r.role, r.text))
        assert r._place == len(out[r._id])
    assert out == {c: repaired for c, (_, repaired) in expected.items() if repaired}
    empty = conversations.conversation_rows(source.filter("false"))
    assert conversations.repair_conversations(empty).collect() == []


def test_conversations_without_present_rows_stay_listed(spark):
    table = spark.createDataFrame([(1, 0, "user", "Gone."), (None, 0, "user", "Gone."), (2, 0, "user", "a."), (2, 3, "user", "b.")], TABLE)
    rows = conversations.conversation_rows(table, present=F.when(F.col("conv_id") == 2, True))
    found = {r._id: tuple(r)[1:] for r in conversations.repair_conversations(rows).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[1] == found[None] == nothing and found[2][0] == 2


def test_query_repairs_the_damaged_table(spark, sf_dir):
    from skyledger.llm.queries import op12_conversation_repair

    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = []
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    expected = {c: plain_report(rows)[0] for c, rows in plain_table(damaged).items()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    result = op12_conversation_repair(spark, sf_dir)
    assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r.conv_id: tuple(r)[1:] for r in result.collect()}
    assert found == {c: expected.get(c, nothing) for c in {r[0] for r in table}}
    assert any(r[2] for r in found.values())

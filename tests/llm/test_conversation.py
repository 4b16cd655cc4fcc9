import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from tessera.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, cost int, audit string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def brute(rows):
    """Every edit sequence, with up to two inserts before each row and at the end."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    inserts = [(), ("I",), ("I", "I")]
    options = [inserts if i % 2 == 0 else [("D",)] if faults[i // 2] in ("blank", "duplicate") else [("D",), ("K",), ("R",)] for i in range(2 * len(rows) + 1)]
    best = None
    for parts in itertools.product(*options):
        audit, cost, i, names, lines = "".join(itertools.chain(*parts)), 0, 0, "", []
        for edit in audit:
            cost += {"K": 0, "R": 2, "D": 3, "I": 2}[edit] + (edit in "KR" and faults[i] == "truncated")
            if edit != "D":
                role = rows[i][2] if edit == "K" else "assistant" if names.endswith("u") else "user"
                names += role[:1] or "?"
                lines.append(f"{role}:{rows[i][3] if edit != 'I' else ''}")
            i += edit != "I"
        if re.fullmatch("(s?(ua)+)?", names) and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()
    turns = {r[1] for r in rows} - {None}
    n = lambda f: faults.count(f)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n("blank"), n("duplicate"), n("truncated"), illegal, *best)


def by_conversation(rows, most):
    left = damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in left if r[0] == conv]
        if len(own) <= most:
            out.append((conv, *brute(own)))
    return out


def rows_of(r, convs, most):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No", "So?  ", " \t", "", None, "a\nb!", "Yes.", "é…"]
    turns = [None, 0, 1, 2, 3, 5, 9]
    return [(c, r.choice(turns), r.choice(roles), r.choice(texts)) for c in convs for _ in range(r.randint(1, most))]


@pytest.mark.parametrize("segment", [1, 2, 256])
def test_every_edit_sequence(spark, segment):
    rows = rows_of(random.Random(segment), [None, *range(60)], 5)
    got = C.repair(C.damaged(spark.createDataFrame([(*row, 9, "x") for row in rows], SCHEMA)), segment).select(*COLUMNS).collect()
    want = by_conversation(rows, 4)
    assert {g.conv_id for g in got} == {row[0] for row in rows} and len(got) == 61 and len(want) > 30
    assert {tuple(g) for g in got} >= set(want)


@pytest.mark.parametrize("segment", [3, 7, 256])
def test_long_conversations_equal_the_sql(spark, segment, tmp_path):
    r = random.Random(5)
    rows = rows_of(r, [1, 2, None], 90) + [(7, t, r.choice(["user", "assistant", "assistant"]), r.choice(["Well.", f"{t}.", f"{t}", "x" * t + "!"])) for t in range(300)]
    conversations = spark.createDataFrame([(*row, 9, "x") for row in rows], SCHEMA)
    conversations.coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({C.sql()})").fetchall()
    assert sorted(map(repr, map(tuple, C.repair(C.damaged(conversations), segment).select(*COLUMNS).collect()))) == sorted(map(repr, want))


def test_nothing_left_and_empty_table(spark):
    dropped = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = C.repair(C.damaged(spark.createDataFrame([(*row, 0, "") for row in dropped], SCHEMA))).collect()
    assert len(got) == len(dropped) > 3 and {tuple(g)[1:] for g in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert C.repair(C.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_search_expands_by_cost_and_audit():
    ends = C.search({C.EMPTY: (0, "")}, [("a", False, False), ("u", False, True)], C.FINAL)
    assert ends == {C.ASSISTANT: (5, "IKD", C.EMPTY)}  # not IKKI, which costs the same
    assert C.search({C.EMPTY: (0, "")}, [("u", True, False)] * 3, C.FINAL) == {C.EMPTY: (9, "DDD", C.EMPTY)}

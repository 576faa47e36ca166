import hashlib
import heapq
import random
import zlib

import pytest

from segstream.llm import repair
from segstream.llm.queries import op12_conversation_repair

FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by Dijkstra over (row, state), audits compared as a whole."""
    nxt = {"": ("user", "u"), "s": ("user", "u"), "u": ("assistant", "a"), "a": ("user", "u")}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        want, into = nxt[state]
        heapq.heappush(heap, (cost + 3, audit + "I", i, into, (*lines, f"{want}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, into, (*lines, f"{want}:{text}")))
                first = role[:1]
                if first == into or (state == "" and first == "s"):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, first, (*lines, f"{role}:{text}")))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACES)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows, damaged=True):
    out = {}
    after = damage(rows) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        mine = [r for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[1] for r in mine if r[1] is not None]
        flagged = faults([r[2:] for r in mine])
        cost, audit, lines = cheapest(flagged)
        initials = [r[0][:1] for r in flagged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [sum(f[2] == k for f in flagged) for k in ("blank", "duplicate", "truncated")]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in rows}
    assert len(out) == len(rows)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def made_up(seed, conversations=120):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(0, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why? \n", "well", "", " \t", None, "Ünï?", f"own {rng.random()}."])
            rows.append((c, rng.choice([t, t, t, t + 1, None]), role, text))
    return rows


@pytest.mark.parametrize("chunk,piece", [(4096, 64), (5, 3), (1, 1)])
def test_equals_dijkstra(spark, monkeypatch, chunk, piece):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = made_up(chunk)
    rows += rows[:40] + [(None, 3, "user", "Hi."), (None, None, None, None), (-5, 10**12, "assistant", "A" * 100_000)]
    assert got(repair.damage_and_repair(frame(spark, rows))) == brute(rows)


def test_search_equals_dijkstra_on_long_conversations():
    rng = random.Random(3)
    for n in (0, 1, 2, 30, 200):
        for _ in range(8):
            rows = [repair.Row(rng.choice(["user", "assistant", "system", "x"]), f"t{i}", rng.choice([None] * 6 + ["blank", "duplicate", "truncated"])) for i in range(n)]
            audit, state = repair.search_chunk(rows, repair.START, list(repair.AT_END))
            cost, best, lines = cheapest(rows)
            assert audit + repair.CLOSING[state] == best
            assert repair.spent_on(rows, audit) + repair.AT_END[state] == cost
            assert tuple(repair.apply_edits(rows, repair.START, best)) == lines


def test_cost_tables_join_over_any_cut():
    rng = random.Random(5)
    rows = [repair.Row(rng.choice(["user", "assistant", "system"]), "", rng.choice([None, None, "blank", "truncated"])) for _ in range(40)]
    whole = repair.through(repair.cost_table(rows), list(repair.AT_END))
    for cut in (0, 1, 17, 40):
        behind = repair.through(repair.cost_table(rows[cut:]), list(repair.AT_END))
        assert repair.through(repair.cost_table(rows[:cut]), behind) == whole
    assert whole[repair.START] == cheapest(rows)[0]


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 50)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"turn {t}" + rng.choice(["", ".", "."])) for t in range(2000)] + [(2, 0, "user", "Hm?")]
    assert got(repair.damage_and_repair(frame(spark, rows))) == brute(rows)


def test_other_columns_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hi.", "x", 7, "d"), (1, 1, "assistant", "Yes.", "y", 8, "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, pos int, fault string")
    assert got(repair.repair(df)) == brute([r[:4] for r in rows], damaged=False)
    assert repair.damage_and_repair(df.limit(0)).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_conversation_repair(spark, sf)) == brute(rows)

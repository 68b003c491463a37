"""Repaired conversations against a plain search over all edits and a plain reading of the rules."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversations as conv

SHAPE = re.compile(r"(s?(ua)+)?")
KIND = "conv_id long, turn long, role string, text string, at long, letters string, edits int, position long"


def every_way(letters):
    """(cost, edits) over all edits of all rows, with up to two insertions before each row and at the end."""
    best = None
    for ways in itertools.product(*[("",) if x in "bd" else (x, "u!", "a!", "") for x in letters]):
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(letters) + 1):
            roles = gaps[0] + "".join((w[0].lower() if w else "") + g for w, g in zip(ways, gaps[1:]))
            if not SHAPE.fullmatch(roles):
                continue
            cost, edits = 5 * sum(map(len, gaps)), "I" * len(gaps[0])
            for x, w, g in zip(letters, ways, gaps[1:]):
                cost += (2 if not w else (1 if w[1:] else 0) + (5 if x.islower() else 0))
                edits += ("D" if not w else "R" if w[1:] else "K") + "I" * len(g)
            best = min(best or (cost, edits), (cost, edits))
    return best


def test_search_against_every_way():
    for n in range(4):
        for letters in itertools.product("bSUAOua", repeat=n):
            if n < 3 or random.Random(str(letters)).random() < 0.15:
                assert conv.search("".join(letters), [1] * n) == every_way(letters), letters


def best_by_state(letters, counts):
    """A plain table over states, row after row."""
    state = {conv.START: (0, "")}

    def put(into, key, value):
        into[key] = min(into.get(key, value), value)

    def inserted(into):
        for _ in range(3):
            for s, (cost, edits) in list(into.items()):
                put(into, conv.NEXT[s], (cost + 5, edits + "I"))

    for x, n in zip(letters, counts):
        inserted(state)
        new = {}
        for s, (cost, edits) in state.items():
            coming, late = conv.NEXT[s], 5 * x.islower()
            put(new, s, (cost + 2 * (n if x in "bd" else 1), edits + "D"))
            if x not in "bd":
                put(new, coming, (cost + 1 + late, edits + "R"))
                if x.upper() == ("U" if coming == conv.USER else "A"):
                    put(new, coming, (cost + late, edits + "K"))
                if x.upper() == "S" and s == conv.START:
                    put(new, conv.SYSTEM, (cost + late, edits + "K"))
        state = new
    inserted(state)
    return min(v for s, v in state.items() if s in (conv.START, conv.ASSISTANT))


def test_search_blocks_and_chunks_agree(monkeypatch):
    r = random.Random(2)
    for n in [*range(9)] * 60 + [30] * 30 + [150] * 10:
        alphabet = r.choice(["bdsuaoSUAO", "SUA", "UA", "uaUA", "U", "SUAb", "UUUAAAsb", "sSoO"])
        letters = "".join(r.choice(alphabet) for _ in range(n))
        counts = [r.choice([1, 1, 3]) if x in "bd" else 1 for x in letters]
        want = best_by_state(letters, counts)
        assert n > 32 or conv.search(letters, counts) == want
        monkeypatch.setattr(conv, "BLOCK", r.choice([1, 2, 7, 32]))
        assert conv.repair_letters(letters, counts) == want[1]
        size = r.choice([1, 3, 9])
        tables = [conv.between_blocks(letters[i:i + size], counts[i:i + size]) for i in range(0, n, size)]
        state, steps = conv.forward([conv.ranked(t) for t in tables])
        end = conv.last_state(state)
        assert "".join(t[w][1] for t, w in zip(tables, conv.back(steps, end), strict=True)) + conv.ENDING[end][1] == want[1]


def damage(rows):
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def plain(given):
    """The contract's columns, read off the rows in memory."""
    groups = defaultdict(list, {c: [] for c, *_ in given})
    for row in damage(given):
        groups[row[0]].append(row[1:])
    out = []
    for c, rows in groups.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{'' if c is None else c}:{len(x[1])}:{x[1]}:{x[2]}".encode()).digest()))
        seen, letters, faults = set(), "", []
        for _, role, text in rows:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            x = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += {"blank": "b", "duplicate": "d", "truncated": x, None: x.upper()}[fault]
        cost, audit = best_by_state(letters, [1] * len(rows))
        final, state, todo = [], conv.START, iter(rows)
        for e in audit:
            role, text = (None, "") if e == "I" else next(todo)[1:]
            if e != "D":
                state = conv.SYSTEM if e == "K" and role[:1] == "s" else conv.NEXT[state]
                final.append((role if e == "K" else conv.ROLE[state]) + ":" + text)
        turns = {t for t, *_ in rows if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    illegal, cost, audit, hashlib.sha256("\n".join(final).encode()).hexdigest()))
    return out


def key(row):
    return row[0] is None, row[0] or 0


@pytest.fixture(scope="module")
def odd():
    r = random.Random(9)
    texts = ["Fine.", "Fine.", "Cut", "", " \n", None, "Why?\n", "So! \t", "x" * 200_000 + ".", "é漢。"]
    rows = [(c, t, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(texts + [f"T {c} {t}."] * 12))
            for c in range(60) for t in r.sample(range(14), r.randint(1, 12))]
    rows += [(None, t, "user", "Null conversation.") for t in (1, 2, None)] + [(61, None, "user", f"No turn {i}.") for i in range(3)]
    rows += [(62, 1, "user", "Tie."), (62, 1, "user", "Tie."), (62, 1, "assistant", "Tie."), (62, 1, "user", "Other tie."), (62, 9, "user", "Tie.")]
    rows += [(63, t, "user" if t % 3 else "assistant", r.choice(["Same.", f"T {t}."])) for t in range(900)]
    gone = next(c for c in range(100, 10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Lost.")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [conv.CHUNK, 50])
def test_query_against_plain_reading(spark, odd, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(conv.repair, "__defaults__", (chunk,))
    frame = spark.createDataFrame([(*row, 7, "x", 3, None) for row in odd], KIND)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted(map(tuple, conv.op13_conversation_repair(spark, str(tmp_path)).collect()), key=key)
    assert got == sorted(plain(odd), key=key)


def test_given_table(spark):
    root = "/root/testdata/sf0.01"
    given = [tuple(r) for r in spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, conv.op13_conversation_repair(spark, root).collect()), key=key) == sorted(plain(given), key=key)


def test_operator_rows(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "You?"), (1, 2, "assistant", "Fine."), (2, 0, "system", "Be."), (2, 1, "user", "Hm.")],
                                  "conv_id long, turn long, role string, text string")
    got = [(r.conv_id, r.edit, r.role, r.text) for r in conv.repair(spark, frame).orderBy("conv_id", "position").collect()]
    assert got == [(1, "D", None, "Hi."), (1, "K", "user", "You?"), (1, "K", "assistant", "Fine."), (2, "R", "user", "Be."), (2, "R", "assistant", "Hm.")]
    assert conv.repair(spark, frame.limit(0)).count() == 0
    frame.limit(0).write.parquet(str(tmp_path / "conversations.parquet"))
    assert conv.op13_conversation_repair(spark, str(tmp_path)).count() == 0

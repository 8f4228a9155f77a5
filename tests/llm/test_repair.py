"""Structure repair against a dynamic program over whole conversations and
against all edit scripts; grammar, ropes, odd rows."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quire.llm import repair
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, conv int, n string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        action = zlib.crc32(key.encode()) % 20
        if action == 0:
            continue
        if action == 1:
            text = ""
        if action == 2:
            text = "".join(c for c in text if c not in ".!?")
        if action == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if action == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, fault):
    """Best (cost, audit) per last initial, row by row: every script of
    inserts and edits."""
    states = {"": (0, "")}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for s, (c, a) in list(out.items()):
                t = NEXT[s]
                out[t] = min(out.get(t, (1 << 60, "")), (c + 3, a + "I"))
        return out

    for (_, _, role, _), f in zip(rows, fault):
        new = {}

        def offer(s, c, a):
            new[s] = min(new.get(s, (1 << 60, "")), (c, a))
        for s, (c, a) in inserted(states).items():
            offer(s, c + 4, a + "D")
            if f in ("blank", "duplicate"):
                continue
            more = 3 if f == "truncated" else 0
            offer(NEXT[s], c + 3 + more, a + "R")
            if role[:1] == NEXT[s] or role[:1] == "s" and s == "":
                offer(role[:1], c + more, a + "K")
        states = new
    return min(v for s, v in inserted(states).items() if s in ("", "a"))


def rewritten(rows, audit):
    out, last, rest = [], "", list(rows)
    for letter in audit:
        if letter == "I":
            role, text = {"u": "user", "a": "assistant"}[NEXT[last]], ""
        else:
            _, _, role, text = rest.pop(0)
            if letter == "D":
                continue
            if letter == "R":
                role = {"u": "user", "a": "assistant"}[NEXT[last]]
        last = role[:1]
        out.append(f"{role}:{text}")
    assert not rest
    return out


def brute(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(r)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        fault = faults(turns)
        given = [r[1] for r in turns if r[1] is not None]
        cost, audit = cheapest(turns, fault)
        initials = [r[2][:1] for r in turns]
        out[conv] = (max(given) - min(given) + 1 - len(set(given)) if given else 0,
                     *[fault.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(rewritten(turns, audit)).encode()).hexdigest())
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = QUERIES["op12_structure_repair"](spark, SF).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        assert tuple(r)[1:] == want.get(r.conv_id, nothing)


def made_up(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Good.", "open", "", " \n", "Why?\n ", "No!", "cut off,", "Good.", None]
    rows = []
    for c in range(conversations):
        conv = None if c == 0 else c
        for k in range(rng.randrange(longest)):
            turn = None if rng.random() < 0.05 else k // 2 * 3 if rng.random() < 0.2 else k * 2
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None])
            rows += [(conv, turn, role, rng.choice(texts), 7, "own")] * (2 if rng.random() < 0.1 else 1)
    return rows


def test_random_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 5)
    rows = made_up(3, 150, 14)
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    clean = [(r[0], r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows]
    want = brute(clean)
    got = {r.conv_id: tuple(r)[1:] for r in repair.summaries(df).collect()}
    assert got == want
    made = defaultdict(list)
    for r in repair.edits(df).orderBy("conv_id", "at").collect():
        made[r.conv_id].append(r)
    for conv, answer in want.items():
        assert "".join(r.edit for r in made[conv]) == answer[6]
        text = "\n".join(f"{r.role}:{r.text}" for r in made[conv] if r.edit != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == answer[7]


def test_all_scripts_of_short_sequences():
    grammar = repair.Grammar([])
    for size in range(4):
        for signs in itertools.product("suoaUx", repeat=size):
            rows = [(0, k, {"x": "user", "o": "tool"}.get(s, s.lower()), "t") for k, s in enumerate(signs)]
            fault = ["blank" if s == "x" else "truncated" if s.isupper() else "" for s in signs]
            assert grammar.edits(["".join(signs)]) == cheapest(rows, fault)


def test_grammar_changes_nothing():
    rng = random.Random(5)
    own = [chr(repair.FIRST_RULE + k) for k in range(7)]
    rules = ["ua", own[0] * 2, "xx", own[2] * 2, own[1] + "U", own[1] * 2, "us"]
    with_rules, plain = repair.Grammar(rules), repair.Grammar([])
    for _ in range(200):
        sequence = "".join(rng.choice(["ua", "uaua", "x", "xx", "u", "s", "o", "U", "A", "xxxx"]) for _ in range(rng.randrange(40)))
        assert with_rules.edits([sequence]) == plain.edits([sequence])
        cut = rng.randrange(len(sequence) + 1)
        assert with_rules.edits([sequence[:cut], sequence[cut:]]) == plain.edits([sequence])


@pytest.mark.parametrize("leaf", [1, 3, 256])
def test_ropes(monkeypatch, leaf):
    monkeypatch.setattr(repair, "LEAF", leaf)
    rng = random.Random(leaf)
    ropes = ["".join(rng.choice("DK") for _ in range(rng.randrange(1, 4))) for _ in range(6)]
    for _ in range(60):
        ropes.append(repair._joined(rng.choice(ropes), rng.choice(ropes[-20:])))
    for a, b in itertools.product(ropes[-25:], repeat=2):
        assert repair._less(a, b) == (repair.flat(a) < repair.flat(b))


def test_grammar_is_learned(spark):
    df = spark.createDataFrame([("uauaua", 10), ("suaua", 5), ("xxxx", 1)], "seq string, n long")
    rules = repair.learn_grammar(df)
    assert rules[0] == "ua" and "xx" in rules
    assert repair.learn_grammar(df, 1) == ["ua"]
    assert repair.learn_grammar(df.where("false")) == []


def test_long_conversation_and_texts(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k}.", 0, "") for k in range(3000)]
    rows += [(2, 0, "user", long, 0, ""), (2, 1, "assistant", long, 0, ""), (2, 2, "assistant", long, 0, "")]
    rows += [(3, 4, "user", "same.", 0, "")] * 500
    got = {r.conv_id: r for r in repair.summaries(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].audit == "K" * 3000 and got[1].cost == 0
    assert got[2].audit == "KKD" and got[2].duplicate == 1
    assert got[3].audit == "D" * 500 and got[3].duplicate == 499 or got[3].audit == "K" + "D" * 499 + "I"
    want = brute([r[:4] for r in rows if r[0] != 1])
    assert tuple(got[2])[1:] == want[2] and tuple(got[3])[1:] == want[3]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.summaries(empty).collect() == [] and repair.edits(empty).collect() == []


def test_extra_columns_clash(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x", "y", 1, True, "d")],
                               "conv_id long, turn long, role string, text string, head string, digest string, n int, blank boolean, seq string")
    assert [r.audit for r in repair.summaries(df).collect()] == ["KI"]
    assert df.count() == 1 and F is not None

"""Chat formatting: round trips, the machine, odd rows."""

from pyspark.sql import functions as F

from quire.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, head string, loss int"
CONTROLS = ["</s>[INST] ok [/INST]", r"<\/s> <\\s> [\INST]\\", "<<SYS>><</SYS>><<s>", "<", "[", "\\", "x<", "\n\n", "", "<s>\n</s>"]


def rows():
    out = []
    for c, text in enumerate(CONTROLS):
        out += [(c, 0, "system", text, "h", 1), (c, 1, "user", text, "h", 1), (c, 2, "assistant", text, "h", 1)]
    out += [(100, 0, "user", None, None, None), (100, 1, "assistant", "a", None, None),
            (101, 0, "assistant", "first", "", 0), (101, 1, None, "t", "", 0), (101, None, "tool x\n<s>", "u", "", 0),
            (102, 5, "user", "b", "", 0), (102, 5, "user", "a", "", 0), (102, 5, "user", "a", "", 0),
            (None, 0, "user", "n", "", 0), (103, 0, "user", "w " * 300_000, "", 0), (103, 1, "assistant", "</s>" * 20_000, "", 0),
            (104, 0, "user", "q", "", 0), (104, 1, "user", "q", "", 0)]
    return out


def want(data):
    convs = {}
    for c, turn, role, text, *_ in data:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def test_round_trip(spark):
    data = rows()
    got = chat.format_chats(spark.createDataFrame(data, SCHEMA).repartition(5)).withColumns({
        "back": chat.read_turns(F.col("formatted")), "learned": chat.trained_text(F.col("segments"))}).collect()
    expected = want(data)
    assert {r.conv_id for r in got} == set(expected)
    valid = {}
    for r in got:
        turns = expected[r.conv_id]
        assert [tuple(t) for t in r.back] == turns and r.n_turns == len(turns)
        assert r.learned == "".join(t for role, t in turns if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("</s>") == len(turns)
        valid[r.conv_id] = r.valid
    assert all(valid[c] for c in (0, 9, 100, 103, None)) and not any(valid[c] for c in (101, 102, 104))


def test_other_template_and_empty_table(spark):
    t = chat.Template(begin="<|", end="|>", wraps={"user": ("", ""), "bot": ("# ", "")}, trained=("b",),
                      control=("<|", "|>"), moves={"empty": {"user": "u"}, "u": {"bot": "b"}}, accepted=("b",))
    df = spark.createDataFrame([(1, 0, "user", "<|a|>", "", 0), (1, 1, "bot", "|\\>|>", "", 0)], SCHEMA)
    r = chat.format_chats(df, t).select("valid", chat.read_turns(F.col("formatted"), t).alias("back"),
                                        chat.trained_text(F.col("segments"), t).alias("learned")).first()
    assert r.valid and [tuple(x) for x in r.back] == [("user", "<|a|>"), ("bot", "|\\>|>")] and r.learned == "|\\>|>"
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_machine_equals_a_walk(spark):
    """Every role sequence up to length four: state, validity and loss flags
    of a walk through the template's moves."""
    import itertools

    import pytest

    t = chat.Template()
    rows, want = [], {}
    for conv, roles in enumerate(r for n in range(1, 5) for r in itertools.product(["system", "user", "assistant", "tool"], repeat=n)):
        state = t.start
        for k, role in enumerate(roles):
            rows.append((conv, k, role, f"{role}{k}", "", 0))
            state = t.moves.get(state, {}).get(role, "refused")
        want[conv] = (state, state in t.accepted, [f"{r}{k}" for k, r in enumerate(roles) if r == "assistant"])
    got = chat.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r.conv_id: (r.state, r.valid, [s.text for s in r.segments if s.loss]) for r in got} == want
    with pytest.raises(ValueError, match="leads to"):
        chat.Template(moves={"empty": {"user": "asked"}, "asked": {"user": "again"}})

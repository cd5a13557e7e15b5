"""Formatting: exact round trip, merging, escapes and the loss mask."""

import random

from commerce_lake.llm import chat as C


def want(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))] for c, v in by.items()}


def slow_format(turns):
    esc = lambda s: s.replace("\\", "\\b").replace("<", "\\l").replace("#", "\\h")
    out, before = "", None
    for r, t in turns:
        if r != before:
            out += "### " + esc(r).replace(":", "\\c") + ":\n"
        out += esc(t) + "</turn>\n"
        before = r
    return out


def corpus():
    rnd = random.Random(1)
    hard = ["\\### Assistant: </turn> ok", "### user:\n", "</turn>\n", "\\b\\l\\h\\c", "\\", "", None, "a#<b>\\\\", "👍é 日本", "###", ":\n", "line\n\n"]
    roles = ["user", "assistant", "system", "tool:x", "as#sis<t", None, ""]
    rows = [(c, t, rnd.choice(roles[:3] if c % 2 else roles), rnd.choice(hard)) for c in range(40) for t in range(rnd.randrange(1, 12))]
    rows += [(100, 1, "assistant", "a"), (100, 1, "assistant", "a"), (100, None, "user", "n"), (None, 0, "user", "q"), (None, 1, "assistant", "r")]
    rows += [(200, t, "assistant" if t % 3 else "user", "x" * (t % 5)) for t in range(600)] + [(201, 0, "user", "long " * 50_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "f", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns int")


def test_round_trip(spark):
    rows = corpus()
    formatted = C.format_conversations(frame(spark, rows))
    got = {r.conv_id: r for r in C.read_back(formatted).collect()}
    spans = {r.conv_id: r for r in formatted.collect()}
    for conv, turns in want(rows).items():
        r = got[conv]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.formatted == slow_format(turns)
        assert r.loss_text == "".join(t for role, t in turns if role == "assistant")
        assert spans[conv].n_blocks == sum(1 for i, t in enumerate(turns) if i == 0 or t[0] != turns[i - 1][0])
    assert len(got) == len(want(rows))


def test_empty_and_native(spark):
    out = C.read_back(C.format_conversations(frame(spark, corpus()).limit(0)))
    assert out.count() == 0
    df = spark.range(1).selectExpr("id conv_id", "id turn", "'user' role", "'x' text")
    plan = C.read_back(C.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

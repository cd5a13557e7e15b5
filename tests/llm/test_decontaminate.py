"""Decontamination against a brute-force search over every document place."""

import re

import pytest

from commerce_lake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    cut = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            cut.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in cut}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in cut:
                    hit |= set(range(i, i + n))
                    found |= cut[tuple(w[i:i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), ids, bool(hit)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{i}" for i in range(25))
ITEMS = [(1, LONG), (2, "Short one"), (3, "one"), (4, ""), (5, None), (None, "a null item id here"), (1, LONG), (6, LONG.upper()),
         (7, "é à ü ß ñ ô î û ë ï ÿ")]
DOCS = [(1, "x y " + LONG + " z"), (2, " ".join(f"W{i}" for i in range(3, 14))), (3, None), (4, ""), (5, "...!!"),
        (6, "a short ONE, then"), (6, "another text of the same id"), (6, "a short ONE, then"), (None, "one"),
        (7, " ".join(f"w{i}" for i in range(9))), (8, "a null item id here"), (9, "one " * 3000 + LONG),
        (10, "É à ü ß ñ ô î û ë ï ÿ"), (11, "é à ü ß ñ ô î û ë ï ÿ"), (12, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9x")]


def frames(spark, docs=DOCS, items=ITEMS):
    d = spark.createDataFrame([(i, t, 1, "h") for i, t in docs], "doc_id long, text string, w int, h string")
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def result(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect()], key=repr)


@pytest.mark.parametrize("broadcast", [D.BROADCAST_ROWS, 0])
def test_equals_brute_force_also_without_broadcast(spark, monkeypatch, broadcast):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
    assert result(D.decontaminate(*frames(spark))) == brute(DOCS, ITEMS)


def test_drop_keeps_clean_rows_and_all_columns(spark):
    d, b = frames(spark)
    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    clean = sorted([(doc, t) for (doc, t), r in zip(DOCS, [brute([x], ITEMS)[0] for x in DOCS]) if not r[4]], key=repr)
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == clean


def test_empty_tables(spark):
    d, b = frames(spark)
    assert D.decontaminate(d.limit(0), b).count() == 0
    rows = D.decontaminate(d, b.limit(0)).collect()
    assert len(rows) == len(DOCS) and not any(r.contaminated for r in rows)


def test_no_python_in_the_plan(spark):
    plan = D.decontaminate(*frames(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Tables whose columns have the names that operators would use inside."""

from commerce_lake.llm import decontaminate, mixing, pii, simhash, toxicity
from commerce_lake.llm.names import free_prefix

ROWS = [(1, "one two three four five six seven eight nine ten eleven", "a"), (2, "quite another text that nobody has written before now", "b"),
        (3, None, None), (3, None, None), (4, "write to x.y@example.org", "a")]
ODD = ["__d", "__t", "__mix_size", "__MIX_key", "___d", "__found", "__marks", "n", "one", "fp", "component", "text_key", "key", "size", "window_ids"]


def odd(spark):
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in ODD)
    return spark.createDataFrame([(*r, *range(len(ODD))) for r in ROWS], schema)


def kept(df):
    """Every row still has its odd columns' values."""
    return [tuple(r[c] for c in ODD) for r in df.collect()]


def test_prefixes_are_free(spark):
    df = odd(spark)
    for start in ("__", "__mix_", "n"):
        p = free_prefix(df, start)
        assert p.startswith(start) and not any(c.lower().startswith(p) for c in df.columns)


def test_rows_keep_their_columns(spark):
    df, values = odd(spark), tuple(range(len(ODD)))
    items = spark.createDataFrame([("i", ROWS[0][1])], "item_id string, text string")
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(df, items).collect()) == [2, 3, 3, 4]
    some = [decontaminate.drop_contaminated(df, items), simhash.keep_one(df), mixing.copies(df), toxicity.drop_toxic(df, toxicity.Constant(0.0)),
            pii.pseudonymise(df, "k").drop("pii")]
    for out in some:
        assert out.columns == df.columns
        rows = kept(out)
        assert rows and set(rows) == {values}
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == [1, 2, 3, 4]
    changed = {r.doc_id: r.text for r in pii.pseudonymise(df, "k").collect()}
    assert changed[1] == ROWS[0][1] and changed[4] != ROWS[4][1] and changed[4].endswith("@example.org")

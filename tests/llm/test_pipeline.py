"""Each stage keeps documents' columns, and the whole run works on the smallest tables."""

import zlib
from collections import Counter

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from commerce_lake.llm import mixing, toxicity
from tests.llm import test_decontaminate, test_mixing, test_simhash, test_token_store


def test_registration():
    q = queries()
    assert "pipeline" in q and all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 11))
    assert set(oracle_sql()) <= set(q)


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(out) == sizes[4]


def test_empty_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, sf)
        assert docs_out.count() == 0


def test_run_equals_plain_stages(spark, monkeypatch):
    """Which documents go at each stage, copies per id, and the last stage's rows."""
    stored = {}

    class Recorder(corpus_pipeline.Scratch):
        def store(self, df, name):
            stored[name] = super().store(df, name)
            return stored[name]

    monkeypatch.setattr(corpus_pipeline, "Scratch", Recorder)
    sf = "/root/testdata/sf0.001"
    out = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect())
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in stored.items()}

    table = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    docs = sorted((r.doc_id, r.text, r.source) for r in table("documents").collect())
    text = {i: t for i, t, _ in docs}
    assert len(text) == len(docs)

    taught = sorted({(r.doc_id, r.toxic, text[r.doc_id] or "") for r in table("labels").collect()
                     if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and len(text.get(r.doc_id) or "x" * 50_001) <= 50_000})
    assert all(sum(y == c for _, y, _ in taught) <= n for c, n in toxicity.PER_CLASS.items())
    scores = toxicity.fit([(t, y) for _, y, t in taught]).scores([t for _, t, _ in docs])
    docs = [d for d, s in zip(docs, scores) if s < toxicity.THRESHOLD]
    assert sorted(ids["toxicity"]) == [d[0] for d in docs] and len(docs) < len(text)

    groups = test_simhash.brute(docs, [test_simhash.slow_fingerprint(t) for _, t, _ in docs])
    docs = [d for d, g in zip(docs, groups) if d[0] == g]
    assert sorted(ids["simhash"]) == [d[0] for d in docs]

    hit = test_decontaminate.brute([d[:2] for d in docs], [(r.item_id, r.text) for r in table("benchmark").collect()])
    clean = {i for i, _, _, _, found in hit if not found}
    docs = [d for d in docs if d[0] in clean]
    assert sorted(ids["decontamination"]) == [d[0] for d in docs]

    copies = Counter(ids["mixing"])
    plan = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert copies == {i: n for i, r in plan.items() if (n := r.copies + (r.size > 0 and r.part_words * 2 >= r.size))}
    targets, _ = test_mixing.wanted_targets(docs)
    for s, target in targets.items():  # whole documents: off by half of the largest at most
        sizes = {i: len(test_mixing.WORD.findall(t or "")) for i, t, source in docs if source == s}
        assert abs(sum(copies[i] * n for i, n in sizes.items()) - target) <= max(sizes.values()) / 2 + 3, s

    want, _ = test_token_store.wanted([(i, text[i]) for i in ids["mixing"]])
    assert out == sorted(want)

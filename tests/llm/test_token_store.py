"""The ORC store against the tokenizer's encoding of whole texts."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc as orc
from tokenizers import Tokenizer

from commerce_lake.llm import token_store as S
from commerce_lake.llm.scratch import Scratch

ROWS = [(5, "Hello, World's 12 <|endoftext|> x"), (-3, None), (2, ""), (9, "café CAFÉ ẛ̣ Σίσυφος ΑΣ İx"), (7, " \t\x85a b c  d\x1ce"),
        (8, "́start é o ̈"), (4, "word " * 30000), (6, "###$$$ it's we'll"), (6, "###$$$ it's we'll"), (6, "another"), (None, "no id"),
        (1, "日本語 テキスト 👍🏽 \U0001f468‍\U0001f469")]


def wanted(rows):
    t = Tokenizer.from_file(S.vocabulary())
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out, start


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 3, [1]) for r in rows], "doc_id long, text string, part int, ids array<int>")


def test_round_trip_equals_whole_text_encoding(spark):
    path = Scratch(spark, "t").path("orc")
    S.write(frame(spark), path, S.vocabulary(), partitions=4)
    got = [tuple(r) for r in S.checksums(S.read(spark, path)).collect()]
    want, total = wanted(ROWS)
    assert sorted((i, n, c) for i, _, n, c in got if i is not None) == sorted((i, n, c) for i, _, n, c in want if i is not None)
    assert {g[0]: g[1] for g in got if g[0] not in (6, None)} == {w[0]: w[1] for w in want if w[0] not in (6, None)}
    spans = sorted((s, s + n) for _, s, n, _ in got)  # the rows tile the whole sequence
    assert spans[0][0] == 0 and spans[-1][1] == total and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_pieces_have_the_ids_of_whole_texts():
    from tests.llm.test_token_counts import odd_texts

    texts = odd_texts()[::3]
    ids, n = S.Encoder(S.vocabulary()).encode(pa.array(texts))
    want = [e.ids + [1] for e in Tokenizer.from_file(S.vocabulary()).encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_metadata_and_lookup(spark):
    path = Scratch(spark, "t").path("orc")
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text")
    S.write(docs, path, S.vocabulary(), partitions=2)
    files = [f for f in spark.read.orc(path).inputFiles()]
    assert len(files) == 2
    f = orc.ORCFile(files[0].removeprefix("file:"))
    assert f.row_index_stride == 1000 and str(f.compression).lower().endswith("zstd")
    found = S.lookup(spark, path, [17, 4711])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in found.collect()) == [17, 4711]


def test_empty(spark):
    path = Scratch(spark, "t").path("orc")
    S.write(frame(spark).limit(0), path, S.vocabulary())
    assert S.checksums(S.read(spark, path)).count() == 0

from commerce_lake.llm.components import connected_components
from commerce_lake.llm.scratch import Scratch


def test_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(999, i) for i in range(200, 260)] + [(5, 6), (6, 7), (7, 5), (7, 5), (8, 8)]
    links += [(300 + i * 7 % 50, 300 + (i + 1) * 7 % 50) for i in range(50)]
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, Scratch(spark, "t")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 200 for i in [*range(200, 260), 999]} | {5: 5, 6: 5, 7: 5}
    want |= {300 + i: 300 for i in range(50)}
    assert got == want
    assert connected_components(df.limit(0), Scratch(spark, "t")).count() == 0

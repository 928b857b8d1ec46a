from helixframe.llm.components import components


def test_shapes(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loops = [(5000, 5000), (6000, 6001), (6001, 6000), (None, 7000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star + loops, "a long, b long")).collect()}
    assert len({got[i] for i in range(201)}) == 1
    assert len({got[1000 + i] for i in range(300)}) == 1
    assert got[6000] == got[6001]
    assert len(set(got.values())) == 3
    assert 5000 not in got


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

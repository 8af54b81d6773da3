import random

from tests.llm.brute import components

from mobility.llm.components import connected_components


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)]                    # a long path
    links += [(500, 500 + i) for i in range(1, 80)]                  # a hub
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links += [(7, 7), (-5, 3), (3, -5)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame([*links, (None, 4)], "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == components({n for x in real for n in x}, real)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

"""Components of chains, stars, loops and repeated links."""

import random

from revlens.llm.components import components


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7), (9, 8), (9, 8)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(None, 3)]
    rng.shuffle(links)
    label = {x: x for pair in links if None not in pair for x in pair if pair[0] != pair[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in label and b in label and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == label


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []

import random

from gable.llm.components import components


def test_components_of_paths_and_random_links(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(45)]
    label = {n: n for link in links for n in link}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["label"] for r in found.collect()} == label


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

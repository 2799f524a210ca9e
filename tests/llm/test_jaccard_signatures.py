"""Pairs of op9 that signatures rule out never have their sets fetched."""

import random

from pricelens.llm import jaccard_join


def test_sets_of_unrelated_documents_are_not_fetched(spark, monkeypatch):
    rng = random.Random(4)
    # a passage of five words in all documents, which have nothing else in common, and two that are near copies
    rows = [(i, " ".join([f"w{rng.random()}" for _ in range(90)] + "one common passage of five".split() * 2)) for i in range(40)]
    rows += [(40, rows[3][1] + " end"), (41, None), (42, "")]
    wanted = []

    def spy(docs, keys, plain=jaccard_join.sets_of):
        wanted.append(keys.count())
        return plain(docs, keys)

    monkeypatch.setattr(jaccard_join, "sets_of", spy)
    out = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(i, 3 if i == 40 else i) for i in range(43)]
    assert sum(wanted) == 2


def test_differing_bits_are_at_most_the_differing_shingles(spark):
    rng = random.Random(5)
    pairs = []
    for n in (1, 3, 60, 64, 65, 120, 129, 250, 260, 1000):
        for edits in (0, 1, n // 10, n // 4):
            a = list(range(n))
            b = [f"e{x}" if x < edits else x for x in a] + list(range(n, n + rng.randint(0, n // 4)))
            pairs.append((" ".join(f"x{x}" for x in a), " ".join(f"x{x}" for x in b)))
    rows = []
    for a, b in pairs:
        hashes, at = jaccard_join.shingle_sets([a.encode(), b.encode()], 1)
        one, other = jaccard_join.signatures(hashes, at).to_pylist()
        x, y = set(hashes[: at[1]]), set(hashes[at[1]:])
        rows.append((one, other, len(x ^ y)))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, d int")
    got = df.select(jaccard_join.differing(df.a, df.b).alias("bits"), "d").collect()
    assert all(r.bits <= r.d and (r.bits - r.d) % 2 == 0 for r in got) and any(r.bits for r in got)

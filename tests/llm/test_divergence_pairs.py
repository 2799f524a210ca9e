"""Pairs of sources whose rows reach the shards in different orders."""

from pricelens.llm import divergence, perfect_hash


def test_pairs_are_named_one_way_round_whatever_the_order_of_rows(spark):
    hashes = spark.createDataFrame([("en", s, perfect_hash.build([t]).packed()) for s, t in ((0, b"x"), (1, b"y"))], "lang string, shard long, blob binary")
    count = lambda n: divergence.packed(divergence.np.array([n]))
    rows = [("en", "a", 0, count(3), 4, 10, 2), ("en", "b", 0, count(5), 6, 10, 2), ("en", "b", 1, count(1), 6, 10, 2), ("en", "a", 1, count(1), 4, 10, 2)]
    grid = spark.createDataFrame(rows, "lang string, source string, shard long, counts binary, n long, n_lang long, v long").coalesce(1)
    pairs = divergence.compared(grid, hashes, 5).where("part = 'pair'").select("source", "item").distinct().collect()
    assert [tuple(r) for r in pairs] == [("a", "b")]

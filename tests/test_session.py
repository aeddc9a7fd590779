"""Dealing of training rows."""

from innlake import session


def test_partitions_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "PARTITION_ROWS", 100)
    sizes = []
    for n in (500, 5000):
        dealt = session.spread(spark.range(n), "id", 8)
        parts = dealt.rdd.glom().map(lambda rows: [r["id"] for r in rows]).collect()
        assert all(p == sorted(p) for p in parts) and sorted(sum(parts, [])) == list(range(n))
        sizes.append(len(parts))
    assert sizes == [8, 50]
    assert max(map(len, parts)) < 300
    assert session.spread(spark.range(5), "id").rdd.getNumPartitions() == spark.range(5).rdd.getNumPartitions()

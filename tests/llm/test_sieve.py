"""Semi and anti joins through a bitmap against the plain joins."""
import pytest

from cargolens.llm import sieve


@pytest.mark.parametrize("bits", [sieve.BITS, 64, 1])
def test_joins(spark, monkeypatch, bits):
    """Also when the bitmap is so full that everything passes."""
    monkeypatch.setattr(sieve, "BITS", bits)
    for kind, keys in (("bigint", [*range(0, 3000, 3), 7, 7, None]), ("string", [f"k{n}" for n in range(50)] + ["", None])):
        rows = spark.createDataFrame([(k, n, "x") for n, k in enumerate(keys + keys[:5])],
                                     f"id {kind}, __at int, __may string")
        wanted = spark.createDataFrame([(k,) for k in keys[::7] + keys[:1] + [None]], f"name {kind}")
        names = {k for k in keys[::7] + keys[:1]} - {None}
        got = sieve.semi_join(rows, "id", wanted, "name")
        assert got.columns == rows.columns
        every = [tuple(r) for r in rows.collect()]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted((r for r in every if r[0] in names), key=repr)
        got = sieve.anti_join(rows, "id", wanted, "name")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted((r for r in every if r[0] not in names), key=repr)
        assert sieve.semi_join(rows, "id", wanted.where("false"), "name").collect() == []
        assert sieve.anti_join(rows, "id", wanted.where("false"), "name").count() == len(every)
        assert sieve.anti_join(rows.where("false"), "id", wanted, "name").collect() == []

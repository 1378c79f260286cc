import numpy as np
import pytest

from tablework.functions.hashing import MinHashFamily
from tablework.operators import minhash

FAMILY = MinHashFamily(size=20, seed=3)


def test_merged_signature_is_that_of_the_union(spark):
    draw = np.random.RandomState(2)
    sets = [(i, "ab"[i % 3 == 0], i % 4, [int(x) for x in draw.randint(0, 10**6, 1 + i % 7)]) for i in range(60)]
    sets += [(60, "a", 0, []), (61, "none", 0, []), (62, None, 1, [5, 9]), (63, "a", 1, sets[0][3])]
    df = spark.createDataFrame(sets, "id int, g string, part int, s array<int>")
    signed = df.join(minhash.set_signatures(df, "id", "s", FAMILY), "id", "left")
    stored = minhash.merge_signatures(signed, ["g", "part"], 20)
    for source in (stored, signed):
        merged = minhash.merge_signatures(source, ["g"], 20).collect()
        unions = {}
        for _, g, _, s in sets:
            unions.setdefault(g, set()).update(s)
        want = [(i, sorted(u)) for i, u in enumerate(unions.values())]
        union = spark.createDataFrame(want, "id int, s array<int>")
        by_id = {r.id: r.sig for r in minhash.set_signatures(union, "id", "s", FAMILY).collect()}
        assert {r.g: r.sig for r in merged} == {g: by_id[i] for i, g in enumerate(unions) if i in by_id}


def test_empty_table_and_odd_lengths(spark):
    none = spark.createDataFrame([], "g string, sig array<bigint>")
    assert minhash.merge_signatures(none, ["g"], 3).collect() == minhash.merge_signatures(none, [], 3).collect() == []
    odd = spark.createDataFrame([("a", [1, 2])], none.schema)
    with pytest.raises(Exception, match="differ in length"):
        minhash.merge_signatures(odd, ["g"], 3).collect()

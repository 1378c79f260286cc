import hashlib
import tracemalloc
from inspect import signature
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tablework.functions.hashing import PRIME, SHINGLE_BASE, MinHashFamily
from tablework.operators import lsh, minhash, sets

# Toy sets of row numbers and their exact similarities.
TOY = {0: {0, 1, 5, 6}, 1: {2, 3, 4}, 2: {0, 5, 6}, 3: {1, 2, 3, 4}}
EXACT = {(0, 1): 0, (0, 2): 3 / 4, (0, 3): 1 / 7, (1, 2): 0, (1, 3): 3 / 4, (2, 3): 0}


def test_toy_matrix_agreement_is_close_to_jaccard(spark):
    family = MinHashFamily(size=2000, seed=1)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in TOY.items()], "d bigint, rows array<bigint>")
    sig = {r.d: np.array(r.sig) for r in minhash.set_signatures(df, "d", "rows", family).collect()}
    for (a, b), jaccard in EXACT.items():
        assert (sig[a] == sig[b]).mean() == pytest.approx(jaccard, abs=0.06)
    small = minhash.set_signatures(df, "d", "rows", MinHashFamily(size=6, seed=1)).collect()
    coefficients = MinHashFamily(size=6, seed=1).coefficients
    for r in small:
        assert r.sig == [min((a * x + b) % PRIME for x in TOY[r.d]) for a, b in coefficients]


def test_text_signature_against_plain_arithmetic(spark):
    texts = {0: "one two three four", 1: "four", 2: "", 3: "one two three four", 4: "a" * 3 + " \U0001d54f\U0001d54f\U0001d54f"}
    texts[5] = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(600))
    df = spark.createDataFrame(list(texts.items()), "d bigint, text string")
    family = MinHashFamily(size=7, seed=3)
    got = {r.d: r.sig for r in minhash.text_signatures(df, "d", "text", family).collect()}

    def expected(line):
        numbers = set()
        for i in range(len(line) - 4):
            number = 0
            for c in line[i : i + 5]:
                number = (number * SHINGLE_BASE + ord(c)) % PRIME
            numbers.add(number)
        return [min((a * x + b) % PRIME for x in numbers) for a, b in family.coefficients]

    assert got == {d: expected(t) for d, t in texts.items() if len(t) >= 5}
    assert got[0] == got[3]


def test_signature_cells(spark):
    df = spark.createDataFrame([(1, [5, 6])], "d bigint, sig array<bigint>")
    assert [tuple(r) for r in minhash.signature_cells(df, "d").collect()] == [(1, 0, 5), (1, 1, 6)]


@pytest.fixture(scope="module")
def signatures(spark):
    """20-value signatures: one hot group of copies, one crowd of near copies, loose rest."""
    draw = np.random.RandomState(11)
    base, crowd = draw.randint(0, 9, 20), draw.randint(0, 9, 20)
    rows = [(i, base.tolist()) for i in range(0, 90, 3)]
    for i in range(1, 90, 3):
        near = crowd.copy()
        spots = draw.choice(20, draw.randint(0, 6), replace=False)
        near[spots] = draw.randint(0, 9, len(spots))
        rows.append((i, near.tolist()))
    rows += [(i, draw.randint(0, 3, 20).tolist()) for i in range(2, 90, 3)]
    rows = [(i, [int(v) for v in s]) for i, s in rows]
    return dict(rows), spark.createDataFrame(rows, "d bigint, sig array<bigint>")


def wanted_pairs(signatures, bands, threshold):
    reps = {}
    for d in sorted(signatures):
        reps.setdefault(tuple(signatures[d]), d)
    rows = 20 // bands
    out = {}
    for (s, a), (t, b) in combinations(reps.items(), 2):
        same = [x == y for x, y in zip(s, t)]
        shared = any(all(same[j : j + rows]) for j in range(0, 20, rows))
        if shared and sum(same) / 20 >= threshold:
            out[min(a, b), max(a, b)] = sum(same) / 20
    return out


@pytest.mark.parametrize("limit, block_rows", [(100, 4096), (3, 4096), (3, 4), (10, 5)])
def test_pairs_do_not_depend_on_bucket_limit_or_blocks(signatures, limit, block_rows):
    plain, df = signatures
    groups = lsh.copy_groups(df, "d")
    got = lsh.candidate_pairs(groups, bands=5, threshold=0.6, bucket_limit=limit, block_rows=block_rows).collect()
    assert {(r.a, r.b): r.agreement for r in got} == wanted_pairs(plain, 5, 0.6)
    assert len(got) == len({(r.a, r.b) for r in got}) > 50


def test_copies_point_to_their_smallest_id(signatures):
    plain, df = signatures
    groups = lsh.copy_groups(df, "d")
    members = {r.d: r.rep for r in lsh.copy_members(df, groups, "d").collect()}
    assert members == {d: min(e for e in plain if plain[e] == s) for d, s in plain.items()}
    assert sum(r.copies for r in groups.collect()) == len(plain)


def test_bands_must_divide_the_signature(signatures):
    with pytest.raises(ValueError):
        lsh.candidate_pairs(lsh.copy_groups(signatures[1], "d"), bands=3)


def test_no_signatures_give_no_pairs(spark):
    empty = spark.createDataFrame([], "d bigint, sig array<bigint>")
    assert lsh.candidate_pairs(lsh.copy_groups(empty, "d")).collect() == []


def test_band_keys_are_sha1_of_the_values(spark):
    df = spark.createDataFrame([(1, [1, 22, 3, 4])], "rep bigint, sig array<bigint>")
    rows = {r.band: r.key for r in lsh.band_rows(df, 2, 2).collect()}
    assert rows == {0: hashlib.sha1(b"1,22").hexdigest(), 1: hashlib.sha1(b"3,4").hexdigest()}


def test_neighbour_lists_are_cut_into_lines(spark):
    pairs = [(0, b) for b in range(1, 400)] + [(7, 9)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    rows = lsh.neighbour_lists(df, line_length=50).collect()
    found = sorted((r.a, b) for r in rows for b in r.neighbours)
    assert found == sorted(pairs)
    assert all(r.neighbours == sorted(r.neighbours) for r in rows)
    assert max(len(r.neighbours) for r in rows) < 100
    assert len(rows) == 9


def test_verified_similarity_is_exact_jaccard(spark):
    texts = {1: "alpha beta gamma delta", 2: "alpha beta gamma delto", 3: "other words entirely"}
    df = spark.createDataFrame(list(texts.items()), "d bigint, t string")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint")
    cut = lambda s: {s[i : i + 5] for i in range(len(s) - 4)}
    want = {}
    for a, b in ((1, 2), (1, 3)):
        x, y = cut(texts[a]), cut(texts[b])
        want[a, b] = len(x & y) / len(x | y)
    got = {(r.a, r.b): r.jaccard for r in lsh.verified_pairs(pairs, df, "d", "t").collect()}
    assert got == want
    kept = lsh.verified_pairs(pairs, df, "d", "t", threshold=0.5).collect()
    assert {(r.a, r.b) for r in kept} == {(1, 2)}


def test_sets_matrix_and_corner(spark):
    df = spark.createDataFrame([(5, "abcdefg"), (2, "bcdef"), (9, "xy")], "d bigint, t string")
    found = sets.shingle_sets(df, "d", "t")
    index = sets.shingle_index(found)
    assert {r.shingle: r.idx for r in index.collect()} == {"abcde": 0, "bcdef": 1, "cdefg": 2}
    ones = sets.shingle_matrix(found, "d", index)
    assert {tuple(r) for r in ones.collect()} == {(5, 0), (5, 1), (5, 2), (2, 1)}
    corner = sets.matrix_corner(df, "d", "t", 2)
    assert {(r.idx, r.col, r.d): r.present for r in corner.collect()} == {
        (0, 0, 2): 0, (0, 1, 5): 1, (1, 0, 2): 1, (1, 1, 5): 1,
    }
    lines = sorted(tuple(r) for r in sets.corner_lines(corner, "d", 2).collect())
    assert lines == [(0, "abcde", 0, 1), (1, "bcdef", 1, 1)]


def test_residues_without_division_equal_those_with_it():
    from tablework.functions import hashing

    draw = np.random.RandomState(5)
    a, b = (np.array(c, dtype=np.int64) for c in zip(*MinHashFamily(size=9, seed=2).coefficients))
    ends = np.array([0, 1, PRIME - 2, PRIME - 1])
    for numbers in (ends, draw.randint(0, PRIME, 1500), np.array([-5, 7, PRIME, PRIME + 3, 2**32])):
        want = [min((int(x) * int(n) + int(y)) % PRIME for n in numbers) for x, y in zip(a, b)]
        assert hashing.min_hashes(numbers, a, b).tolist() == want
    top = np.array([0, PRIME - 1, PRIME, PRIME * (PRIME - 1), PRIME * (PRIME - 1) - 1], dtype=np.uint64)
    values = top.copy()
    hashing._residues(values, np.empty_like(values))
    assert values.tolist() == [int(v) % PRIME for v in top]


def test_verified_pairs_stage_lines_not_sets(spark, monkeypatch):
    staged = []

    def noted(df, name):
        staged.append(df.columns)
        return df

    monkeypatch.setattr(lsh, "stage", noted)
    texts = {1: "alpha beta gamma", 2: "Alpha  beta gamma!", 3: "alpha beta gammo", 4: "abc", 5: None}
    df = spark.createDataFrame(list(texts.items()), "d bigint, t string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (1, 4), (1, 5), (4, 5)], "a bigint, b bigint")
    got = {(r.a, r.b): r.jaccard for r in lsh.verified_pairs(pairs, df, "d", "t").collect()}
    assert got == {(1, 2): 1.0, (1, 3): 11 / 13, (2, 3): 11 / 13, (1, 4): 0.0, (1, 5): None, (4, 5): None}
    # a set is many times its text; only lines are written, and no pair carries one
    assert not any("shingles" in c for cols in staged for c in cols)
    assert all("line" not in cols for cols in staged if "a" in cols)


def test_low_bytes_bound_the_agreement(spark):
    from tablework.functions.hashing import agreement, equal_bytes, low_bytes

    df = spark.createDataFrame([([1, 300, 7], [1, 44, 7]), ([1, 2, 3], [4, 5, 6])], "x array<bigint>, y array<bigint>")
    marks = df.select(agreement("x", "y").alias("all"), low_bytes("x").alias("p"), low_bytes("y").alias("q"))
    got = [(r.all, r.low) for r in marks.select("all", equal_bytes("p", "q").alias("low")).collect()]
    assert got == [(2 / 3, 1.0), (0.0, 0.0)]


def test_pairs_of_a_cell_of_alike_texts_fit_a_worker():
    rows = signature(lsh.candidate_pairs).parameters["block_rows"].default
    assert 24 * rows * rows <= 500 * 2**20  # three values of eight bytes a pair
    sig = pa.FixedSizeListArray.from_arrays(pa.array(np.ones(1000 * 10, dtype=np.int64)), 10).cast(pa.list_(pa.int64()))
    one, other = (pa.table({"rep": pa.array(np.arange(1000) + at), "sig": sig}) for at in (0, 1000))
    key = (pa.scalar({"band": 0, "key": "x"}), pa.scalar(0), pa.scalar(1))
    tracemalloc.start()
    found = lsh._close_pairs(0.8, 5)(key, one, other)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 1000 * 1000 and found.schema.names == ["a", "b", "agreement"]
    # the pairs once, not once in parts and once joined
    assert peak < 1.6 * found.nbytes, (peak, found.nbytes)
    none = lsh._close_pairs(0.8, 5)(key, one.slice(0, 0), other)
    assert none.num_rows == 0 and none.schema == found.schema


def test_lines_of_a_group_are_sent_once_not_once_a_pair(spark, monkeypatch):
    words = [chr(97 + i) * 4 for i in range(20)]
    texts = {i: " ".join(words[:i] + ["zz"] + words[i:]) for i in range(20)} | {100 + i: f"{w} other" for i, w in enumerate(words)}
    df = spark.createDataFrame([*texts.items(), (0, "a second text"), (200, "é" * 9), (201, "é" * 8 + " x")], "d bigint, t string")
    pairs = list(combinations(range(20), 2)) + [(100 + i, 101 + i) for i in range(0, 18, 2)] + [(200, 201)]
    sent = []

    def noted(df, name):
        sent.append((name, df))
        return stage(df, name)

    from tablework.plans import stage

    monkeypatch.setattr(lsh, "stage", noted)
    for chars in (lsh._BLOCK_CHARS, 300):
        monkeypatch.setattr(lsh, "_BLOCK_CHARS", chars)
        sent.clear()
        got = lsh.verified_pairs(spark.createDataFrame(pairs, "a bigint, b bigint"), df, "d", "t").collect()
        cut = lambda s: {s[i : i + 5] for i in range(len(s) - 4)}
        share = lambda x, y: len(cut(x) & cut(y)) / len(cut(x) | cut(y))
        want = {(a, b): share(texts[a], texts[b]) for a, b in pairs if 0 < a < 200}
        assert {(r.a, r.b): r.jaccard for r in got if 0 < r.a < 200} == want
        # both texts of a repeated id
        assert sorted(r.jaccard for r in got if (r.a, r.b) == (0, 5)) == sorted(share(t, texts[5]) for t in (texts[0], "a second text"))
        cells = dict(sent)["cells"].collect()
        lines = {(r.i, r.j, bytes(d)) for r in cells for d in (r.x, r.y)}
        # in one block a line is sent once, in several once for each block it meets
        assert len(cells) == len(pairs) + 19 and len(lines) < (50 if chars > 300 else 300)
        assert (len({(r.i, r.j) for r in cells}) > 3) == (chars == 300)


def test_runs_have_the_same_numbers_in_all_lines():
    draw = np.random.RandomState(3)
    lines = ["".join(chr(c) for c in draw.choice([97, 98, 233, 0x1F600], draw.randint(0, 40))) for _ in range(30)] + ["", "abcd"]
    for k in (1, 5, 40):
        runs = [set(r.tolist()) for r in lsh._run_numbers(lines, k)]
        cut = [{t[i : i + k] for i in range(len(t) - k + 1)} for t in lines]
        assert [[len(x & y) for y in runs] for x in runs] == [[len(x & y) for y in cut] for x in cut]


def test_low_bits_bound_the_agreement(spark):
    from tablework.functions.hashing import low_bits

    draw = np.random.RandomState(8)
    rows = draw.randint(0, PRIME, (40, 100))
    rows[1:, :85] = rows[0, :85]
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "sig array<bigint>")
    words = [r.bits for r in df.select(low_bits("sig").alias("bits")).collect()]
    assert {len(w) for w in words} == {2}
    differ = [sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(words[0], w)) for w in words]
    assert differ == [int(((rows[0] ^ r) & 1).sum()) for r in rows]

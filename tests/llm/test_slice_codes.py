import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference, duck
from swayline.llm import slice_codes
from swayline.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, key string, code int, error string, carried_0 int, same int"


@pytest.mark.parametrize("count", [1, 3, 16, 64, 70, 200])
def test_slices_give_the_nearest_entry(count):
    rng = np.random.default_rng(count)
    for dimensions in (1, 2, 8):
        entries = rng.integers(-40, 40, (count, dimensions))
        parts = np.vstack([rng.integers(-90, 90, (300, dimensions)), entries, rng.integers(-9000, 9000, (20, dimensions))])
        number, distance = slice_codes.Slices(entries).nearest(parts)
        every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_masks_are_exactly_the_entries_in_the_cube():
    rng = np.random.default_rng(1)
    entries, parts, radius = rng.integers(-20, 20, (130, 4)), rng.integers(-20, 20, (50, 4)), rng.integers(0, 25, 50)
    mask = slice_codes.Slices(entries).inside(parts, radius)
    inside = (np.abs(parts[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    got = np.array([[bool(int(mask[i, e // 64]) >> (e % 64) & 1) for e in range(130)] for i in range(50)])
    assert (got == inside).all()


def brute(vectors: dict[int, list[int]], parts=8, entries=16, rounds=6):
    keys = sorted(vectors)
    x = np.array([vectors[k] for k in keys], np.int64).reshape(len(keys), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    near = lambda: ((x[:, :, None] - books[None]) ** 2).sum(axis=3)
    for _ in range(rounds):
        code = near().argmin(axis=2)
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(axis=0) // len(mine)
    d = near()
    return {k: ("".join(f"{c:02x}" for c in d[i].argmin(axis=1)), int(d[i].min(axis=1).sum())) for i, k in enumerate(keys)}, books


def test_against_brute_force_and_decoding(spark):
    rng = np.random.default_rng(3)
    rows = {int(i): rng.normal(size=32).astype(np.float32) for i in rng.permutation(300)}
    rows[301] = rows[7]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in rows.items()], "vec_id long, embedding array<float>").repartition(5)
    coded, books = slice_codes.compress(df)
    want, want_books = brute({k: np.floor(4096 * v.astype(float)).astype(int).tolist() for k, v in rows.items()})
    got = {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()}
    assert got == want and (books.entries == want_books).all()
    for key in (0, 7, 301):
        apart = np.floor(4096 * rows[key].astype(float)) - 4096 * np.array(books.decode(got[key][0]))
        assert int((apart ** 2).sum()) == got[key][1]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_against_sql(spark, folder):
    assert difference(QUERIES["op11_vector_codes"](spark, folder), duck(folder), ORACLE["op11_vector_codes"]) is None


def test_awkward_rows(spark):
    whole = [float(i) for i in range(16)]
    rows = [(1, whole), (2, [x + 0.5 for x in whole]), (2, whole), (None, whole), (3, None), (4, []), (5, [1.0] * 15), (6, [None] + whole[1:]),
            (7, [float("nan")] + whole[1:]), (8, [float("inf")] + whole[1:]), (9, [1e30] + whole[1:]), (10, [0.0] * 8), (11, [-x for x in whole])]
    df = spark.createDataFrame([(i, v, None if n % 3 else n % 2, "k", 1, "e", 2, 3) for n, (i, v) in enumerate(rows)], SCHEMA)
    coded, books = slice_codes.compress(df, carry=["label"])
    out = slice_codes.with_group_error(coded, "label", "label_error").collect()
    got = sorted((str(r["vec_id"]), r["code"] is None) for r in out)
    assert got == sorted((str(i), c) for i, c in [(1, False), (2, False), (2, False), (None, False), (4, True), (5, True), (9, True), (10, True), (11, False)])
    assert books.entries.shape == (8, 4, 2)
    sums = {}
    for r in out:
        sums[r["label"]] = sums.get(r["label"], 0) + (r["error"] or 0)
    assert all((r["label_error"] or 0) == sums[r["label"]] for r in out)
    for none in (df.limit(0), df.filter("vec_id = 3"), df.filter("vec_id = 4")):
        coded, books = slice_codes.compress(none)
        assert coded.count() == (none.filter(F.col("vec_id") == 4).count()) and books.entries.size == 0
        assert len(books.digest()) == 64

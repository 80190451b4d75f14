import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import normal
from riskframe.operators import neighbors
from riskframe.operators.impute import KnnImputer


def test_a_flag_does_not_keep_cells_from_being_cut(spark):
    """Most rows have a flag's least value, which is then its median; no cut there parts any rows."""
    df = spark.range(3_000).select("id", normal(7, F.col("id"), "x").alias("x"), (F.col("id") % 10 == 0).cast("int").alias("flag"))
    index = neighbors.build_index(df, "id", ["x", "flag"], 3, cell_rows=100)
    assert index.donors.groupBy("cell", "sub").count().agg(F.max("count")).first()[0] < 600


def by_hand(q, d, of, target, reach, k):
    """One ask at a time, donors in order: (ask, donor, distance)."""
    found = []
    for ask, (row, t) in enumerate(zip(of, target)):
        near, shared = np.zeros(len(d)), np.zeros(len(d))
        with np.errstate(all="ignore"):
            for i in range(q.shape[1]):
                gap = q[row, i] - d[:, i]
                near += np.where(np.isnan(gap), 0.0, gap * gap)
                shared += ~np.isnan(gap)
            near = np.where(shared > 0, near * (q.shape[1] / shared), np.inf)
        if t >= 0:
            near[np.isnan(d[:, t])] = np.inf
        order = [i for i in np.argsort(near, kind="stable")[:k] if near[i] <= reach[ask] and np.isfinite(near[i])]
        found += [(ask, i, near[i]) for i in order]
    return found


@pytest.mark.parametrize("block, pairs", [(262_144, 262_144), (700, 40)])
@pytest.mark.parametrize("kind", ["whole", "gaps in both", "one pattern", "ties", "far off", "infinite", "huge"])
def test_nearest_equals_by_hand(monkeypatch, kind, block, pairs):
    """The donors and the very distances, whatever the fast distances round away."""
    monkeypatch.setattr(neighbors, "BLOCK_PAIRS", block)
    monkeypatch.setattr(neighbors, "EXACT_PAIRS", pairs)
    rng = np.random.default_rng(len(kind))
    q, d = rng.normal(size=(40, 6)), rng.normal(size=(500, 6))
    if kind == "gaps in both":
        q[rng.random(q.shape) < 0.3], d[rng.random(d.shape) < 0.2] = np.nan, np.nan
        q[3] = np.nan
    elif kind == "one pattern":
        q[rng.random(q.shape) < 0.3], d[:, 1] = np.nan, np.nan
        q[:20, 2:4] = np.nan
    elif kind == "ties":
        q, d = q.round(0), d.round(0)
    elif kind == "far off":
        q, d = q.round(2) + 1e7, d.round(2) + 1e7
    elif kind == "infinite":
        q[0, 0], d[:5, 0], d[5, 2] = np.inf, np.inf, -np.inf
    elif kind == "huge":
        q, d = q * 1e155, d * 1e155
    of = np.sort(rng.integers(0, 40, 80))
    target, reach = rng.integers(-1, 6, 80), np.where(rng.random(80) < 0.5, np.inf, rng.random(80) * 4)
    got = zip(*(x.tolist() for x in neighbors._nearest(q, d, of, target, reach, 4)))
    assert list(got) == by_hand(q, d, of, target, reach, 4)


def kept(monkeypatch):
    """What is stored, by name; the first of a name stays."""
    seen, real = {}, neighbors.stored

    def store(df, name):
        out = real(df, name)
        seen.setdefault(name, out)
        return out
    monkeypatch.setattr(neighbors, "stored", store)
    return seen


def test_coordinates_lacked_together_are_looked_for_once(spark, monkeypatch):
    """A row lacks three of nine coordinates, always together: five donors each, not five for every coordinate."""
    seen = kept(monkeypatch)
    df = spark.range(60).select("id", *(F.when((F.col("id") + i) % 3 != 0, normal(3, F.col("id"), str(i))).alias(f"x{i}") for i in range(9)))
    cols = tuple(f"x{i}" for i in range(9))
    filled = KnnImputer(cols, "id", 5).fit(df).transform(df)
    counts = [r["count"] for r in seen["near"].groupBy("query_key").count().collect()]
    assert len(counts) == 60 and set(counts) == {5}
    table = {r["id"]: np.array([np.nan if v is None else v for v in r[1:]]) for r in df.collect()}
    for r in filled.collect():
        own = table[r["id"]]
        for i in np.flatnonzero(np.isnan(own)):
            ids = [j for j in table if not np.isnan(table[j][i])]
            gap = {j: np.nansum((table[j] - own) ** 2) * 9 / (~np.isnan(table[j] - own)).sum() for j in ids}
            assert r[f"x{i}"] == pytest.approx(np.mean([table[j][i] for j in sorted(ids, key=lambda j: (gap[j], j))[:5]]))


def test_a_query_with_many_cells_is_sent_once_for_a_pack(spark, monkeypatch):
    """In many dimensions boxes rule out little: a query then meets nearly every cell."""
    seen = kept(monkeypatch)
    monkeypatch.setattr(neighbors, "CHUNK_ROWS", 200)
    df = spark.range(400).select("id", *(normal(4, F.col("id"), str(i)).alias(f"x{i}") for i in range(12)))
    index = neighbors.build_index(df, "id", [f"x{i}" for i in range(12)], 4, cell_rows=20)
    assert len(index.boxes["n"]) == 16
    near = neighbors.knn(index, df, "id", [f"x{i}" for i in range(12)], drop_self=True)
    table = {r["id"]: np.array(r[1:]) for r in df.collect()}
    found = {}
    for r in near.collect():
        found.setdefault(r["query_key"], {})[r["rank"]] = r["donor_key"]
    for i, x in table.items():
        want = sorted((j for j in table if j != i), key=lambda j: (((table[j] - x) ** 2).sum(), j))[:3]
        assert [found[i][rank] for rank in (1, 2, 3)] == want
    sent = seen["pack-visits"]
    assert sent.selectExpr("max(size(cells))").first()[0] > 3
    assert sent.groupBy("query_key", "cell").count().where("count > 1").isEmpty() and sent.select("cell").distinct().count() <= 4


def test_new_rows_that_lack_other_coordinates_than_the_donors(spark):
    """Whole donors: any coordinates have the same donors, but not every row looks for all of them. Keys repeat."""
    names = ("a", "b", "c")
    train = spark.createDataFrame([(1, 0.0, 1.0, 5.0), (2, 1.0, 3.0, 7.0), (3, 9.0, 50.0, 8.0)], "id long, a double, b double, c double")
    new = spark.createDataFrame([(7, 0.4, None, None), (7, 8.0, None, 8.0), (8, None, None, 7.4), (None, 0.0, None, None)],
                                "id long, a double, b double, c double")
    out = KnnImputer(names, "id", 1).fit(train).transform(new).collect()
    # of rows with one key the nearest donor of either fills both where both lack the value
    assert sorted((r["id"] or 0, *(round(r[c], 6) for c in names)) for r in out) == [
        (0, 0.0, 18.0, round(20 / 3, 6)), (7, 0.4, 1.0, 5.0), (7, 8.0, 1.0, 8.0), (8, 1.0, 3.0, 7.4)]

import numpy as np
import pytest
from llm import brute
from llm.conftest import prose
from pyspark.sql import functions as F
from scanforge.llm import components, near_text, near_vectors
from scanforge.llm.common import Scratch
from scanforge.plans import tables


def test_components(spark):
    draw = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2300)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark)).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    want = brute.groups(linked, [(a, b) for a, b in links if a != b])
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark)).count() == 0


def test_stars_need_no_round(spark, tmp_path):
    """Rounds over links at rest cost the driver two jobs for each exchange and find nothing."""
    for links, rounds in (([(1, 2), (3, 1), (1, 4), (8, 9), (9, 8)], 0), ([(1, 2), (2, 3)], 1), ([(1, 3), (2, 3)], 1)):
        scratch = Scratch(spark)
        found = components.components(spark.createDataFrame(links, "a bigint, b bigint"), scratch)
        assert {r["node"]: r["component"] for r in found.collect()} == brute.groups({x for link in links for x in link}, links)
        assert tables.exists(spark, f"{scratch.root}/components_1") == (rounds > 0)


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_nothing_left_is_not_compared(spark, monkeypatch):
    """Where each likeliest partner is similar, no component is compared as a whole, and components aren't sought a third time."""
    base = prose(5, 200).split()
    texts = {i: " ".join([*base[:i], f"c{i}", *base[i + 1 :]]) for i in range(12)} | {100 + i: prose(100 + i, 80) for i in range(8)}
    monkeypatch.setattr(near_text, "join_components", lambda *_: pytest.fail("compared"))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = []
    jobs = jobs_of(spark, "near", lambda: found.extend(near_text.near_duplicates(docs, 4).collect()))
    assert {r["doc_id"]: r["component_id"] for r in found} == brute.near_texts(texts, 4)
    assert jobs < 90


@pytest.mark.parametrize("width", [4, 5])
def test_texts_equal_brute_force(docs, width):
    rows = near_text.near_duplicates(docs, width).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = brute.near_texts(texts, width)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["n_shingles"] == len(brute.shingles(texts[r["doc_id"]], width)) for r in rows)
    assert {r["doc_id"] for r in near_text.keep_one(docs, width).collect()} == set(want.values())


def test_large_groups_and_chains(spark):
    """A group of near copies, a chain whose ends differ, texts that share half, and exact copies."""
    base = prose(5, 200).split()

    def changed(places, mark):
        return " ".join(f"{mark}{w}" if i in places else w for i, w in enumerate(base))

    texts = {1000 + i: changed({i}, f"c{i}") for i in range(150)}
    texts |= {2000 + i: changed(set(range(0, 5 * i, 5)), "k") + " tail" for i in range(12)}
    texts |= {3000 + i: " ".join(base[:100]) + " " + prose(100 + i, 100) for i in range(40)}
    texts |= {4000 + i: prose(7, 90) for i in range(50)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in near_text.near_duplicates(docs, 4).collect()}
    assert got == brute.near_texts(texts, 4)


def test_blocks_compare_all_parts_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_text, "BLOCK", 2)
    test_large_groups_and_chains(spark)


def test_odd_texts(odd_docs, no_docs):
    rows = near_text.near_duplicates(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == by_id[5]["n_shingles"] == 0
    assert all(by_id[i]["component_id"] == i for i in (3, 4, 5, 6, 8, 9, 10)) and by_id[7]["component_id"] == 6
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    kept = near_text.keep_one(odd_docs, 4)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert near_text.near_duplicates(no_docs).count() == 0


def brute_vectors(rows):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked)) if a < b]
    return dict(zip(ids, linked.sum(1).tolist())), brute.groups(ids, links)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 40)
    draw = np.random.default_rng(2)
    centers = draw.normal(size=(30, 16))
    rows = [c + draw.normal(size=16) * 0.08 for c in centers for _ in range(draw.integers(1, 20))]
    rows += [centers[0] + draw.normal(size=16) * 0.1 for _ in range(150)] + [centers[1]] * 60 + [3 * centers[1]] * 5
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(rows)]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(6)).collect()
    counts, want = brute_vectors(rows)
    found, all_links = sum(r["n_links"] for r in got), sum(counts.values())
    assert all(r["n_links"] <= counts[r["vec_id"]] for r in got)
    assert found >= 0.99 * all_links
    if found == all_links:
        assert {r["vec_id"]: r["component_id"] for r in got} == want


def test_traversal_visits_nearest_cells_first():
    draw = np.random.default_rng(3)
    rows = near_vectors.scaled(draw.normal(size=(400, 10)))
    grid, stop = near_vectors.fit_grid(rows, 8, 0.95, 0.999)
    (_, first), (_, second) = grid.halves(rows)
    for cells, x, y, own in zip(grid.visits(rows, stop), first, second, grid.cells(rows)):
        distance = (x[:, None] + y[None]).ravel()
        assert cells[0] == own
        assert sorted(cells) == np.flatnonzero(distance <= stop).tolist()
        assert all(a <= b + 1e-12 for a, b in zip(distance[cells], distance[cells][1:]))


def test_forest_connects_what_is_linked():
    draw = np.random.default_rng(4)
    for share in (0.02, 0.1, 0.6):
        linked = draw.random((40, 50)) < share
        pairs = near_vectors.forest(linked)
        assert all(linked[r, c] for r, c in pairs) and len(pairs) < 90
        ids = range(90)
        full = [(int(r), 40 + int(c)) for r, c in zip(*np.nonzero(linked))]
        assert brute.groups(ids, full) == brute.groups(ids, [(r, 40 + c) for r, c in pairs])


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1.0]), (11, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("n_links", F.lit("x")).withColumn("cell", F.lit(1))
    got = near_vectors.near_vectors(df).collect()
    assert len(got) == len(rows)
    by_id = {r["vec_id"]: r for r in got}
    assert by_id[1]["n_links"] == 3 and by_id[10]["component_id"] == 1 and not by_id[10]["kept"]
    for i in (3, 4, 5, 6, 7, 8, 9, 11):
        assert (by_id[i]["n_links"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert near_vectors.near_vectors(df.where("false")).count() == 0

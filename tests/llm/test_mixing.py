import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from scanforge.llm import mixing, queries


def shares(budget, children):
    """Fractions by filling up: children is {key: (weight, capacity)}."""
    left, out, open_ = float(min(budget, sum(c for w, c in children.values() if w))), dict.fromkeys(children, 0.0), {k for k, (w, c) in children.items() if w}
    while open_:
        total = sum(children[k][0] for k in open_)
        full = {k for k in open_ if children[k][1] <= left * children[k][0] / total + 1e-9}
        if not full:
            return out | {k: left * children[k][0] / total for k in open_}
        for k in full:
            out[k] = float(children[k][1])
        left -= sum(out[k] for k in full)
        open_ -= full
    return out


TREE = {
    ("a", "x", "1"): 1000, ("a", "x", "2"): 10, ("a", "y", "3"): 50, ("a", "y", "4"): 50,
    ("b", "x", "5"): 400, ("b", "z", "6"): 7, ("c", "z", "7"): 3, ("c", "z", "8"): 0,
}
WEIGHTS = {"a": 5, "b": 3, "c": 2, "x": 2, "y": 1, "z": 4}


@pytest.mark.parametrize("percent,epochs", [(10, 1), (60, 2), (100, 1), (150, 2), (190, 2), (300, 2)])
def test_budgets_fill_siblings_first(spark, percent, epochs):
    leaves = spark.createDataFrame([(*k, v) for k, v in TREE.items() if v], "domain string, lang string, source string, supply bigint")
    entries = ", ".join(f"'{k}', {v}" for k, v in WEIGHTS.items())
    known = lambda c: F.expr(f"coalesce(element_at(map({entries}), {c}), 1)")
    rows = mixing.leaf_budgets(leaves, ["domain", "lang", "source"], [known(c) for c in ("domain", "lang", "source")], percent, epochs).collect()
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in rows}

    def below(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        capacity = defaultdict(int)
        for k, v in TREE.items():
            if k[:depth] == prefix and v:
                capacity[k[depth]] += v * epochs
        out = {}
        for k, b in shares(budget, {k: (WEIGHTS.get(k, 1), c) for k, c in capacity.items()}).items():
            out |= below((*prefix, k), b)
        return out

    total = sum(TREE.values()) * percent // 100
    want = below((), total)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) <= 3 for k in want)
    assert sum(got.values()) == min(total, sum(TREE.values()) * epochs)
    assert all(got[k] <= TREE[k] * epochs for k in got)


def test_prefix_of_each_leaf(docs):
    path = ["lang", "source"]
    rows = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, None).otherwise("s"))
    drawn = mixing.mix(rows, path, [F.lit(1), F.lit(1)], 70, 2, 9).collect()
    tokens = {r["doc_id"]: len(r["text"].split()) for r in rows.collect()}
    leaf = {r["doc_id"]: (r["lang"], r["source"] or mixing.NOTHING) for r in rows.collect()}
    got = defaultdict(set)
    for r in drawn:
        assert r["n_tokens"] == tokens[r["doc_id"]] and (r["lang"], r["source"]) == leaf[r["doc_id"]]
        got[leaf[r["doc_id"]], r["epoch"]].add(r["doc_id"])
    for (key, epoch), chosen in got.items():
        members = [i for i in leaf if leaf[i] == key and tokens[i]]
        order = sorted(members, key=lambda i: hashlib.md5(f"9:{epoch}:{i}".encode()).hexdigest())
        assert chosen == set(order[: len(chosen)])
        if epoch:
            assert got[key, epoch - 1] == set(members)


def test_stage_draws_what_the_query_draws(spark, docs):
    query = queries.op10_mixing(spark, "/root/testdata/sf0.001").groupBy("doc_id").count()
    stage = mixing.take_mixed(docs, queries.tree(), [F.expr(w) for w in queries.WEIGHTS])
    assert stage.columns == docs.columns
    assert sorted(map(tuple, query.collect())) == sorted(map(tuple, stage.groupBy("doc_id").count().collect()))


def test_odd_rows(odd_docs, no_docs):
    weights = [F.expr(w) for w in queries.WEIGHTS]
    out = mixing.take_mixed(odd_docs, queries.tree(), weights, 100, 1)
    assert out.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in odd_docs.collect() if (r["text"] or "").split())
    assert mixing.take_mixed(no_docs, queries.tree(), weights).count() == 0
    assert mixing.take_mixed(odd_docs, queries.tree(), weights, 0).count() == 0

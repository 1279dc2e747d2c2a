import datetime as dt
import random

import pytest

from tidemark.errors import DefinitionError
from tidemark.operators import hierarchy as H
from tidemark.plans.steps import ordered, run_steps


def brute(edges, targets, depth):
    parent = {}
    for worker, manager in edges:
        if worker not in parent or (manager is not None and (parent[worker] is None or manager < parent[worker])):
            parent[worker] = manager
    out = {}
    for worker, node in parent.items():
        out[worker], level = (None, None), 1
        while node is not None and level <= depth:
            if node in targets:
                out[worker] = (node, level)
                break
            node, level = parent.get(node), level + 1
    return out


def resolve(spark, edges, targets, depth):
    found = H.resolve_ancestor(spark.createDataFrame(edges, "worker_id string, manager_id string"),
                               spark.createDataFrame([(t,) for t in targets], "target_id string"), depth)
    return {r.worker_id: (r.target_id, r.depth) for r in found.collect()}


def test_chain_of_six_levels(spark):
    chain = [(f"W{i}", f"W{i + 1}") for i in range(1, 6)] + [("W6", "P1"), ("W7", "P2"), ("W8", "W9"), ("W9", "W8"), ("W10", None)]
    assert resolve(spark, chain, ["P1", "P2"], 6) == {
        **{f"W{i}": ("P1", 7 - i) for i in range(1, 7)}, "W7": ("P2", 1), "W8": (None, None), "W9": (None, None), "W10": (None, None)}


@pytest.mark.parametrize("depth", [1, 2, 3, 6])
def test_random_links_equal_brute_force(spark, depth):
    draw = random.Random(depth)
    name = lambda: f"n{draw.randrange(60):02d}"
    edges = [(name(), draw.choice([name(), name(), "n00", None])) for _ in range(120)]
    targets = {name() for _ in range(4)}
    assert resolve(spark, edges, sorted(targets), depth) == brute(edges, targets, depth)


STEPS = [
    {"id": "b", "after": "a", "sourceTable": "t1", "transformation": "rename", "sourceTableColumn": "id:key", "targetTable": "t2"},
    {"id": "a", "after": "", "sourceTable": "src", "transformation": "select", "sourceTableColumn": "id, v", "snapshotDuration": "Currently", "targetTable": "t1"},
    {"id": "c", "after": "b", "sourceTable": "t2", "transformation": "join", "joinType": "left", "condition": "key = other.oid", "targetTable": "t3"},
    {"id": "d", "after": "c", "sourceTable": "t3", "transformation": "select", "selectExpr": "key, COALESCE(other.name, 'none, at all') AS name", "targetTable": "t4"}]


def test_steps_follow_their_links(spark):
    day = dt.date(2024, 1, 1)
    src = spark.createDataFrame([(1, "x", day), (2, "y", day), (3, "z", dt.date(2024, 1, 2))], "id int, v string, partition_dt date")
    other = spark.createDataFrame([(1, "one")], "oid int, name string")
    with pytest.raises(DefinitionError, match="run date"):
        run_steps(STEPS, {"src": src, "other": other})
    # the current snapshot is cut before the columns are selected
    results = run_steps(STEPS, {"src": src, "other": other}, day)
    assert list(results) == ["t1", "t2", "t3", "t4"]
    assert sorted(tuple(r) for r in results["t4"].collect()) == [(1, "one"), (2, "none, at all")]


def test_bad_step_chains():
    step = lambda i, after: {"id": i, "after": after}
    for steps, text in (([step("a", "x")], "unknown"), ([step("a", "b"), step("b", "a")], "cycle"), ([step("a", ""), step("a", "")], "repeat")):
        with pytest.raises(DefinitionError, match=text):
            ordered(steps)


def test_paths_stop_at_the_target_the_bound_and_in_cycles(spark):
    edges = spark.createDataFrame([(i, i - 1 if i else None) for i in range(12)] + [(20, 21), (21, 20), (30, 30)], "worker_id long, manager_id long")
    goals = spark.createDataFrame([(0,), (7,)], "target_id long")
    found = {r.worker_id: r.path for r in H.resolve_ancestor(edges, goals, max_depth=5, with_path=True).collect()}
    for i in range(1, 12):
        end = 7 if i > 7 else 0
        assert found[i] == (list(range(i, end - 1, -1)) if i - end <= 5 else None)
    assert found[0] is found[20] is found[21] is found[30] is None

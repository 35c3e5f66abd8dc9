from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.operators.hierarchy import clean_parent, descendants, intervals, resolve_trees, tree_nodes
from tarnlake.operators.lookup import hot_keys, lookup_join

NODES = "id string, parent string, payload string"


def brute(parents: dict):
    out = {}
    for x in parents:
        path, at = [x], {x: 0}
        while True:
            p = parents[path[-1]]
            if p is None or p not in parents:
                out[x] = (path[-1], len(path) - 1, "whole" if p is None else "lost", "/".join(path[::-1]))
                break
            if p in at:
                i = at[p]
                out[x] = (min(path[i:]), i, "cycle" if i == 0 else "below_cycle", "/".join(path[: max(i, 1)][::-1]))
                break
            at[p] = len(path)
            path.append(p)
    return out


def check(spark, parents: dict, rounds: int = 2):
    df = spark.createDataFrame([(k, v, None) for k, v in parents.items()], NODES)
    got = {r.id: (r.root, r.depth, r.state, "/".join(r.path)) for r in resolve_trees(df, rounds, True, True).collect()}
    assert got == brute(parents)


def test_shapes(spark):
    chain = {f"c{i:03d}": f"c{i - 1:03d}" if i else None for i in range(40)}
    star = {"s": None} | {f"s{i}": "s" for i in range(30)}
    loops = {"a": "b", "b": "c", "c": "a", "d": "a", "e": "d", "self": "self", "under": "self"}
    lost = {"l1": "gone", "l2": "l1"}
    check(spark, chain | star | loops | lost)


def test_subtree_sizes(spark):
    df = spark.createDataFrame([("a", None, None), ("b", "a", None), ("c", "b", None), ("d", "c", None), ("e", "d", None), ("f", "a", None)], NODES)
    got = {r.id: r.subtree for r in resolve_trees(df, 1, True).collect()}
    assert got == {"a": 6, "b": 4, "c": 3, "d": 2, "e": 1, "f": 1}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 25), st.one_of(st.none(), st.integers(0, 30)), min_size=1, max_size=26))
def test_any_graph(spark, g):
    check(spark, {str(k): None if v is None else str(v) for k, v in g.items()}, 1)


def test_empty_and_repeated_and_extra_columns(spark):
    empty = spark.createDataFrame([], NODES)
    assert resolve_trees(empty, with_paths=True, with_sizes=True).count() == 0
    raw = spark.createDataFrame([(" A1 ", "None", 1, "x"), ("a1", "B2 ", 2, "y"), ("b2", "0000", 1, "z"), (None, "b2", 1, "w"), ("", "b2", 1, "w")], "line_id string, frontID string, at int, id string")
    got = {r.id: (r.root, r.state) for r in resolve_trees(tree_nodes(raw, "line_id", "frontID", "at")).collect()}
    assert got == {"a1": ("b2", "whole"), "b2": ("b2", "whole")}


def test_no_parent_spellings(spark):
    df = spark.createDataFrame([(x,) for x in ["None", "", " ", "null", "0", "0000000000000000", "ZERO", None, "00a0"]], "p string")
    assert [r[0] for r in df.select(clean_parent(F.col("p"))).collect()] == [None] * 8 + ["00a0"]


def test_hot_keys_and_loops_take_the_plan_of_large_data(spark, monkeypatch):
    """Half of all rows under one parent, and many below one loop: with a low bound the hot ones travel, results stay."""
    from tarnlake.operators import hierarchy, lookup

    monkeypatch.setattr(lookup, "HOT_LEAST", 3)
    monkeypatch.setattr(hierarchy, "HOT_LEAST", 3)
    star = {"s": None} | {f"s{i}": "s" for i in range(60)} | {f"d{i}": f"s{i}" for i in range(5)}
    loop = {"a": "b", "b": "a"} | {f"u{i}": "a" for i in range(30)} | {f"v{i}": f"u{i}" for i in range(4)} | {f"w{i:02d}": f"w{i - 1:02d}" if i else "v0" for i in range(9)}
    check(spark, star | loop | {f"o{i}": "gone" for i in range(20)}, 1)
    check(spark, {f"r{i}": f"r{(i + 1) % 7}" for i in range(7)}, 0)


def test_rides_fold_any_way(spark):
    """The hash of a way doesn't depend on how the way was put together."""
    from tarnlake.operators.chat import HASHED, _key

    rows = [("a", None, "1"), ("b", "a", "2"), ("c", "b", "3"), ("x", None, "1"), ("y", "x", "2"), ("z", "y", "3"), ("z2", "z", "4"), ("q", None, "2")]
    df = spark.createDataFrame(rows, "id string, parent string, p string").select("id", "parent", F.sha2("p", 256).alias("payload"))
    for rounds in (0, 1, 3):
        got = {r.id: (r.k, r.up) for r in resolve_trees(df, rounds, ride=HASHED).select("id", _key("ride", 0).alias("k"), _key("ride", 1).alias("up")).collect()}
        assert got["c"] == got["z"] and got["b"] == got["y"] and got["a"] == got["x"] and got["c"][1] == got["b"][0]
        assert len({v[0] for v in got.values()}) == 5


def test_descendants(spark):
    df = spark.createDataFrame([("a", None, None), ("b", "a", None), ("c", "b", None)], NODES)
    got = {tuple(r) for r in descendants(resolve_trees(df, with_paths=True)).collect()}
    assert got == {("a", "b", 1), ("b", "c", 1), ("a", "c", 2)}


def test_hot_keys_travel(spark):
    left = spark.range(200).select(F.when(F.col("id") < 150, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("160", 2)], "r string, v int")
    hot = hot_keys(left.groupBy("k").agg(F.count("*").alias("n")), "k", "n", 200, share=4, least=10)
    assert hot == ["hot"]
    joined = lookup_join(left, right, F.col("k") == F.col("r"), "k", "r", hot)
    assert joined.count() == 200 and joined.where("v is not null").count() == 151


def test_intervals_hold_all_descendants(spark):
    rows = [("a", None), ("b", "a"), ("c", "b"), ("d", "a"), ("e", "d"), ("f", "d"), ("x", "gone"), ("y", "x"), ("l", "m"), ("m", "l"), ("n", "m"), ("s", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], NODES)
    got = {r.id: (r.root, r.enter, r["exit"]) for r in intervals(df).collect()}
    pairs = {(a, b) for a, (r, e, x) in got.items() for b, (q, f, _) in got.items() if r == q and e < f <= x}
    assert pairs == {(r.ancestor, r.descendant) for r in descendants(resolve_trees(df, with_paths=True).where("state in ('whole', 'lost')")).collect()}
    assert got["a"] == ("a", 0, 5) and set(got) == set("abcdefsxy") and intervals(df.limit(0)).count() == 0

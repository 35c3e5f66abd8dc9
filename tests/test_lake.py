import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnlake import api, sinks
from tarnlake.functions import models
from tarnlake.operators import chat, lake, packing, pipelines, vectors


def test_packing_never_exceeds(spark):
    sizes = [30, 40, 50, 100, 10, 10, 90, 120, 5]
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate(sizes)], "g string, i long, n long")
    rows = packing.pack_exactly(df, ["g"], "i", "n", 100).orderBy("i").collect()
    used: dict = {}
    for r in rows:
        used.setdefault(r.file_no, []).append(r.n)
    assert sorted(used) == list(range(len(used)))
    assert all(sum(v) < 100 or len(v) == 1 for v in used.values())


def test_running_sum_without_keys(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("n"))
    got = packing.running_sum(df, [], ["id"], "n", "s", block_rows=7).orderBy("id").collect()
    total = 0
    for r in got:
        total += r.n
        assert r.s == total
    assert packing.running_sum(df.limit(0), [], ["id"], "n", "s").count() == 0


def test_running_sum_by_keys_over_blocks(spark):
    # one key holds most rows, another begins inside a block, some are tiny; a null size adds nothing
    rows = [("hot", i, i % 5) for i in range(90)] + [("a", i, 1) for i in range(3)] + [("z", i, None if i == 1 else 2) for i in range(20)] + [(None, 1, 4), (None, 2, 4)]
    df = spark.createDataFrame([(k, i, n, "x", True) for k, i, n in rows], "k string, i long, n long, _clash string, b boolean")
    got = packing.running_sum(df, ["k"], ["i"], "n", "s", block_rows=9).collect()
    want, total = {}, {}
    for k, i, n in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        total[k] = total.get(k, 0) + (n or 0)
        want[k, i] = total[k]
    assert {(r.k, r.i): r.s for r in got} == want and set(got[0].asDict()) == {"k", "i", "n", "_clash", "b", "s"}


def test_exact_packing_over_blocks(spark):
    import random

    rnd = random.Random(3)
    rows = [(k, i, rnd.choice([1, 2, 3, 30, 99, 100, 140])) for k, n in (("hot", 200), ("b", 7), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i long, n long")
    for block in (1 << 20, 11, 3):
        got = {(r.k, r.i): r.file_no for r in packing.pack_exactly(df, ["k"], "i", "n", 100, block).collect()}
        want = {}
        for key in ("hot", "b", "c"):
            used, no = 0, 0
            for k, i, n in rows:
                if k == key:
                    if used and used + n >= 100:
                        used, no = 0, no + 1
                    used += n
                    want[k, i] = no
        assert got == want
    assert packing.pack_exactly(df.limit(0), ["k"], "i", "n", 100).count() == 0


def test_greedy_with_skip(spark):
    sizes = [40, 70, 30, None, 50, 0, 20, 9, 10, 1, 1]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n long")
    left, want = 100, []
    for i, n in enumerate(sizes):
        if n is not None and n <= left:
            want.append(i)
            left -= n
    assert sorted(r.i for r in packing.greedy_with_skip(df, ["i"], "n", 100).collect()) == want
    assert packing.greedy_with_skip(df.limit(0), ["i"], "n", 100).count() == 0 and packing.greedy_with_skip(df, ["i"], "n", -1).count() == 0


def test_unset_shared_folder_raises_on_a_cluster():
    from types import SimpleNamespace

    from tarnlake.session import shared_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        shared_dir(far)


def test_register(spark):
    old = spark.createDataFrame([(7, "a")], "dataset_id short, dataset_name string")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("b", 4), (None, 5)], "dataset_name string, dataset_id int")
    got = {(r.dataset_id, r.dataset_name, r.folder) for r in lake.register(old, new).collect()}
    assert got == {(8, "b", "0008"), (9, "c", "0009")}


def test_delete_uses_equality(spark):
    lines = spark.createDataFrame([("0001", "t", 1), ("0011", "t", 11), ("0002", "u", 1), ("0003", None, 1)], "line_id string, title string, dataset_id int")
    kept = lake.delete_by_title(lines, lines.select("line_id"), lines.select("line_id"), ["t"], [1])
    assert {r.line_id for r in kept[0].collect()} == {"0011", "0002", "0003"} == {r.line_id for r in kept[1].collect()}


def test_blend():
    assert lake.blend(["0.3", "a", "0.7", "b"]) == (["a", "b"], [0.3, 0.7])
    assert lake.blend(["a", "b"]) == (["a", "b"], None)
    with pytest.raises(ValueError):
        lake.blend(["0.3", "a", "b", "c"])


def test_lake_round_trip_and_delete(spark, tmp_path):
    df = spark.createDataFrame([("0001000000000000", "ä\n"), ("0001000000000001", "b"), ("0002000000000000", "c")], "line_id string, text string")
    p = str(tmp_path / "lake")
    sinks.write_lake(df, p)
    assert {tuple(r) for r in sinks.read_lake(spark, p).collect()} == {tuple(r) for r in df.collect()}
    sinks.delete_from_lake(spark, p, spark.createDataFrame([("0001000000000001",)], "line_id string"))
    assert {r[0] for r in sinks.read_lake(spark, p).where("line_id is not null").collect()} == {"0001000000000000", "0002000000000000"}


def test_keys_and_messages(spark):
    cases = ['{"Question":"q","Output":"o","z":"1"}', '{"x":"1"}', "no json", None, '{"input":"a","question":"b"}']
    df = spark.createDataFrame([(x,) for x in cases], "j string")
    got = [r[0] for r in df.select(chat.normalize_keys(F.col("j"))).collect()]
    assert got == [{"user": "q", "assistant": "o", "z": "1"}, {"x": "1"}, None, None, {"user": "b"}]
    lists = ['[{"from":"human","value":"a"},{"speaker":"x","text":"b"}]', '[["q","a"],["x"]]', '["u","v","w"]', "[Human]: hi <eoh>[MOSS]: yo <eoa>[Other]: n <eoa>", "[]", None]
    df = spark.createDataFrame([(x,) for x in lists], "m string")
    got = [[tuple(y) for y in r[0]] if r[0] is not None else None for r in df.select(chat.normalize_messages(F.col("m"))).collect()]
    assert got[:4] == [[("human", "a"), ("x", "b")], [("user", "q"), ("assistant", "a")], [("user", "u"), ("assistant", "v"), ("user", "w")], [("user", "hi"), ("assistant", "yo")]]
    assert not got[4] and not got[5]


def test_message_tree(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "a", "b"), (2, 0, "u", "a"), (2, 1, "a", "c"), (3, 0, "u", "a"), (4, 0, None, None)]
    t = chat.message_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, content string"))
    assert t.count() == 4
    assert {(r.conv_id, r.turn) for r in chat.leaf_paths(t).collect()} == {(1, 1), (2, 1), (4, 0)}
    scored = spark.createDataFrame([(1, 0, "u", "a", None), (1, 1, "a", "b", 1.0), (2, 0, "u", "a", None), (2, 1, "a", "b", 2.0)], "conv_id long, turn long, role string, content string, score double")
    g = chat.preference_groups(chat.message_tree(scored, score="score")).collect()
    assert len(g) == 1 and [x.score for x in g[0].responses] == [1.0, 2.0]


def test_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r)[:2] for r in vectors.search(v, v, 5, 0.87).orderBy("query_id", "rank").collect()]
    assert got == [(1, 6), (1, 2), (2, 1), (2, 6), (6, 1), (6, 2)]
    assert vectors.search(v.limit(0), v).count() == 0
    unit = [r[0] for r in v.orderBy("vec_id").select(vectors.l2_normalize(F.col("embedding"))).collect()]
    assert unit[3] == [0.0, 0.0] and unit[4] is None and abs(unit[1][0] ** 2 + unit[1][1] ** 2 - 1) < 1e-9


def test_search_in_blocks_and_by_index(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=16)).tolist()) for i in range(1_000)] + [(1_000, None), (1_001, [0.0] * 16)]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = base.where("vec_id % 20 = 0")
    exact = {(r.query_id, r.vec_id) for r in vectors.search(asked, base, 5, 0.5).collect()}
    assert exact == {(r.query_id, r.vec_id) for r in vectors.search(asked, base, 5, 0.5, block=7).collect()} and len(exact) == 250
    c = vectors.fit_lists(base, 24)
    vectors.index_vectors(base, c, str(tmp_path / "ix"))
    assert spark.read.parquet(str(tmp_path / "ix")).count() == 1_001  # every row with a vector
    got = {(r.query_id, r.vec_id) for r in vectors.search_index(asked, c, str(tmp_path / "ix"), 5, 0.5, probes=4).collect()}
    assert len(got & exact) >= 0.9 * len(exact) and got <= exact | got
    assert vectors.search_index(asked.limit(0), c, str(tmp_path / "ix")).count() == 0


def test_keep_decisions(spark):
    chunks = spark.createDataFrame([(t, c, n) for t, n in (("one", 1), ("two", 2), ("three", 3), ("free", 1), ("other", 3)) for c in range(n)], "text_id string, chunk_no int, n_chunks int")
    hits = spark.createDataFrame([("one", 0, "d"), ("two", 0, "d"), ("two", 1, "e"), ("three", 0, "d"), ("three", 1, "d"), ("other", 0, "d"), ("other", 1, "f")], "text_id string, chunk_no int, prefix string")
    got = dict(map(tuple, vectors.keep_decisions(chunks, hits).collect()))
    assert got == {"one": False, "two": True, "three": False, "free": True, "other": True}


def test_embedded_keep(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:59], "other"])
    rows = [(1, " ".join(words)), (2, near), (3, " ".join(f"x{i}" for i in range(60))), (4, "水果很甜今天天气很好" * 3), (5, "水果很甜今天天气很好" * 3 + "。"), (6, None), (7, " ".join(words))]
    df = spark.createDataFrame(rows, "text_no long, text string")
    chunked = vectors.chunk_vectors(df, pipelines.embed_udf(), 600, 100)
    assert dict(map(tuple, vectors.embedded_keep(chunked).collect())) == {1: True, 2: False, 3: True, 4: True, 5: False, 7: False}
    store = vectors.chunk_vectors(df.where("text_no = 3").withColumn("text_no", F.lit(-9).cast("long")), pipelines.embed_udf(), 600, 100)
    assert dict(map(tuple, vectors.embedded_keep(chunked, store).collect()))[3] is False
    assert vectors.earlier_hits(chunked, chunked, k=5, block=2).count() == vectors.earlier_hits(chunked, chunked).count() == 4
    assert vectors.embedded_keep(chunked.limit(0)).count() == 0


def test_earlier_hits_by_bounds(spark):
    """The search takes full products of few pairs only, and finds what all products find."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 64)) * (0.9 ** np.arange(64))
    v = (centres[rng.integers(0, 12, 900)] + 0.4 * rng.normal(size=(900, 64)) * (0.95 ** np.arange(64))).astype(np.float32)
    v[600:900:2] = v[0:300:2] + 0.05 * rng.normal(size=(150, 64)).astype(np.float32)
    v[5] = 0
    df = spark.createDataFrame([(i // 2, i % 2, 2, x.tolist()) for i, x in enumerate(v)], "text_no long, chunk_no int, n_chunks int, embedding array<float>")
    u = vectors.unit_rows(pd.Series(list(v)))
    axes = vectors.bounding_axes(u, 0.95)
    bound, whole = (lambda x: x @ x.T)(vectors.bounded(u, axes)), u @ u.T
    assert (bound >= whole - 1e-5).all() and axes.shape[1] < 64 and (bound >= 0.95).mean() < 0.2
    want = set()
    for i in range(900):
        near = sorted((-whole[i, j], j // 2, j % 2) for j in range(i // 2 * 2) if whole[i, j] >= 0.95)[:5]
        want |= {(i // 2, i % 2, n[1]) for n in near}
    assert len(want) > 150
    for block in (70, 32_768):
        assert {(r.text_id, r.chunk_no, r.prefix) for r in vectors.earlier_hits(df, df, 5, 0.95, block).collect()} == want


def test_import_drops_near_repeats(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(60))
    for k, lines in enumerate(([words, words + " more", "the harbour and the ferry"], [words + " again", "a wholly new line of text"])):
        (tmp_path / f"in{k}").mkdir()
        (tmp_path / f"in{k}" / "a.jsonl").write_text("\n".join(json.dumps({"text": x, "title": "t"}) for x in lines))
        assert api.import_documents(spark, str(tmp_path / f"in{k}"), "jsonl", "text", k + 1, str(tmp_path / "out")).count() == 2 - k


def test_quality(spark):
    good = [("the report on law and court cases was long", 1), ("a study of the law in courts", 1)] * 10
    bad = [("click buy now cheap cheap", 0), ("buy cheap now click", 0)] * 10
    df = spark.createDataFrame(good + bad, "text string, label int")
    out = models.predict_quality(df, models.train_quality(df, features=1 << 10, rounds=20))
    assert models.evaluate(out.withColumnRenamed("should_keep", "prediction")).collect()[0].f1 > 0.9
    assert set(out.columns) == {"text", "label", "doc_score", "should_keep"}
    assert out.select(models.keep_by_score(F.lit(0.999), "pareto")).count() == 40


def test_report(spark, tmp_path):
    df = spark.createDataFrame([(0.1,), (0.9,)], "doc_score double")
    sinks.score_report(df, str(tmp_path / "a.csv"), str(tmp_path / "a.md"))
    assert (tmp_path / "a.csv").read_text().startswith("n,mean") and "0.5" in (tmp_path / "a.md").read_text()


def test_threads(spark, tmp_path):
    df = spark.createDataFrame([(f"{i:02d}", ['{"role":"u","content":"a"}', '{"role":"a","content":"b"}']) for i in range(9)], "root string, messages array<string>")
    sinks.write_threads(df, str(tmp_path / "t"), "message", per_file=200)
    lines = spark.read.text(str(tmp_path / "t"))
    assert json.loads(lines.first().value) == {"message": [{"role": "u", "content": "a"}, {"role": "a", "content": "b"}]}
    assert lines.count() == 9 and lines.select("part").distinct().count() == 3


def test_linked_tree_and_end_flags(spark):
    rows = [("1", None, "u", "a"), ("2", "1", "a", "b"), ("3", None, "u", "a"), ("4", "3", "a", "b"), ("5", "3", "a", "c"), ("6", "gone", "u", "x"), ("4", "3", "a", "b"), (None, "1", "a", "b")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "line_id string, frontID string, role string, content string, added_date int")
    t = chat.linked_message_tree(df)
    assert {(r.line_id, r.depth, r.n_uses) for r in t.collect()} == {("1", 0, 2), ("2", 1, 2), ("5", 1, 1)}
    assert {r.line_id for r in chat.leaf_paths(t).collect()} == {"2", "5"}
    assert chat.linked_message_tree(df.limit(0)).count() == 0
    turns = spark.createDataFrame([("a", 3), ("a", 5), ("b", 1), (None, 2)], "c string, t int")
    assert {(r.c, r.t, r.end) for r in chat.end_flags(turns, "c", "t").collect()} == {("a", 3, "false"), ("a", 5, "true"), ("b", 1, "false"), (None, 2, "false")}

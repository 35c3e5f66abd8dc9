import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tarnlake import api
from tarnlake.functions import clean, models, text, tokenizers
from tarnlake.operators import pipelines
from tarnlake.sources import files


def test_web_and_paper(spark):
    long = "A sentence about the harbour and the ferry that is long enough to stay. Another one."
    rows = [(1, f"https://a.b/c {long} {long}"), (2, "short"), (3, None), (4, ""), (5, "#!#!#! 12 34 56 -- ;; ,, !! ??  .. :: ** (( )) [[ ]] 78 90 11 22 33 44"), (6, f"# {long}")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, cleaned string")
    assert {r.doc_id: r.text for r in pipelines.clean_web(df).collect()} == {1: f" {long}".strip()}
    assert {r.doc_id for r in pipelines.clean_paper(df).collect()} == {1, 2, 3, 4, 5, 6}
    ppl = spark.createDataFrame([(1, 3000.0), (2, 10.0)], "doc_id long, perplexity double")
    assert {r.doc_id for r in pipelines.clean_paper(df, perplexity=ppl).collect()} == {2}


def test_web_texts_once(spark):
    """Each text is cleaned by one function called once, and as by the column functions one after the other."""
    tail = " and the harbour stays open to all who come. It is long enough."
    odd = ["", " ", "/* Copyright 1 */", "/* other */", "/*", "x. x. Same one here. Same one here?", "水果 很甜。水果 ", "!!  __ ......a", "龥龦 一上", "ﬁ１é\u3000", "a\r\n\n\tb", "“a.”b ’", "https://a.b/c\u3000", "# ", "/" + "/* copyright */" + "/", "1 2 3 4 5 6 7 8 9 - - - - - - - - ; ; ; ; ; ; , , , , , , , 1 2 3 4 5 6 7 8 9"]
    df = spark.createDataFrame([(i, a + tail + b) for i, (a, b) in enumerate([*((x, "") for x in odd), *(("", x) for x in odd)])], "doc_id long, text string")
    c = F.col("text")
    steps = df.withColumn("text", clean.strip_garbled(clean.strip_urls(c))).where(clean.keep_special(c, 0.0, 0.5)).localCheckpoint()
    for f in (clean.clean_common, clean.strip_copyright, text.drop_repeated_sentences, clean.normalize_spaces):
        steps = steps.withColumn("text", f(c)).localCheckpoint()
    web = pipelines.clean_web(df)
    assert set(web.collect()) == set(steps.where(clean.keep_line(c)).collect())
    plan = web._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and len(plan) < 5_000


def test_small_steps(spark):
    df = spark.createDataFrame([("a good answer with many words in it",), ("",), (None,)], "t string")
    s = [r[0] for r in df.select(pipelines.message_score(F.col("t"))).collect()]
    assert 0 < s[1] < s[0] < 1 and s[2] is None
    v = [r[0] for r in df.select(pipelines.embed_udf(16)("t")).collect()]
    assert abs(sum(x * x for x in v[0]) - 1) < 1e-5 and not any(v[1]) and not any(v[2])
    one = spark.range(1).select(pipelines.labels_from_scores(F.array(F.lit(0.6), F.lit(0.9), F.lit(0.2), F.lit(0.9)), ["a", "b", "c", "d"], 2), pipelines.registered_at(F.to_timestamp(F.lit("2025-01-01 00:00:00")))).collect()[0]
    assert one[0] == ["b", "d"] and str(one[1]) == "2025-01-01 08:00:00"
    assert pipelines.keywords_chinese(spark.createDataFrame([(1, None), (2, "x"), (3, "水果水果很甜"), (4, "天气很甜")], "doc_id long, text string"), top=1).orderBy("doc_id").collect()[0].keywords == "水果"
    assert pipelines.keywords_chinese(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    r = spark.range(1).select(pipelines.classifier_row(F.lit("l"), F.lit("The cat, 中文 the é dog"), ["the"])).collect()[0][0]
    assert r.doc_label == ["l"] and r.doc_token == ["cat", "中文", "dog"]


def test_files(spark, tmp_path):
    (tmp_path / "w.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    (tmp_path / "z.txt").write_text("")
    (tmp_path / "s.txt").write_text("a\n\nb\na\n")
    assert files.read_whole_json(spark, str(tmp_path)).count() == 2
    assert files.read_stop_words(str(tmp_path / "s.txt")) == ["a", "b"]
    assert {r.path[-5:] for r in files.nonempty(files.file_sizes(spark, str(tmp_path), ".txt")).collect()} == {"s.txt"}
    df = spark.createDataFrame([("# T\n> **b** [x](u) ![i](v)\n---\n`c`",)], "t string")
    assert df.select(files.markdown_to_plain(F.col("t"))).collect()[0][0] == "T\nb x \n\nc"
    assert files.pdf_pages(b"<< /Type /Pages >> << /Type /Page >> <</Type/Page>>") == 2


def test_trie_and_sentences(spark, tmp_path):
    v = tmp_path / "v.txt"
    v.write_text("1 'a' 1\n2 'ab' 2\n3 ' ' 1\n4 b'\\xe4' 1\n5 '.' 1\n")
    t = tokenizers.build_tokenizer("trie", str(v))
    assert t.tokenize("aba a") == [2, 1, 3, 1] and t.detokenize([2, 1, 0]) == "aba"
    with pytest.raises(ValueError):
        t.tokenize("z")
    df = spark.createDataFrame([("a. ab",)], "t string")
    assert tuple(df.select(tokenizers.encode_udf("trie", str(v), by_sentence=True)("t")).collect()[0][0]) == ([1, 5, 2, 0], [2, 2])


def test_models_saved_and_labels(spark, tmp_path):
    df = spark.createDataFrame([("the weather and the notes", "en"), ("die kosten und das wetter", "de")] * 5, "text string, label string")
    m = models.train_labels(df, features=1 << 10)
    assert m.transform(df).where("said = label").count() == 10
    q = models.train_quality(df.select("text", (F.col("label") == "en").cast("int").alias("label")), features=64, rounds=5)
    q.write().overwrite().save(str(tmp_path / "m"))
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        for p in (tmp_path / "m").rglob("*"):
            if p.is_file():
                z.write(p, p.relative_to(tmp_path / "m"))
    assert len(models.load_model(str(tmp_path / "m.zip"), str(tmp_path / "u")).stages) == 3


def test_export_and_delete(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join('{"text":"text number %d","title":"t%d"}' % (i, i % 3) for i in range(30)))
    out = str(tmp_path / "out")
    api.import_documents(spark, str(src), "jsonl", "text", 3, out)
    target = str(tmp_path / "exports")
    parts = spark.read.text(api.export(spark, out, target, "random", datasets=["0003"], per_file=100))
    assert parts.count() == 30 and parts.select("part").distinct().count() > 3
    assert 0 < api.chosen_lines(spark, out, "certain_sampling", budget=100).count() <= 7
    assert api.chosen_lines(spark, out, "select", conditions={"title": ["t1", "t2"]}).count() == 20
    some = api.chosen_lines(spark, out, "subject_sampling", conditions={"title": "t1"}, budget=50).collect()
    assert 2 <= len(some) and sum(len(r.text) for r in some) <= 50
    v = tmp_path / "v.json"
    v.write_text(json.dumps(WORD_FILE))
    folder = api.export(spark, out, target, "random", "binidx", "HFTokenizer", str(v))
    assert spark.read.format("tokens").load(f"{folder}/{folder.rpartition('/')[2]}").count() == 30
    assert api.export(spark, out, target, "select", conditions={"title": "none such"}) is None
    assert api.delete_titles(spark, out, ["t1"], [3]) == 10 and api.delete_titles(spark, out, ["t1"]) == 0
    assert api.chosen_lines(spark, out, "random").count() == 20
    for bad in (dict(method="none"), dict(method="random", data_type="csv"), dict(method="random", data_type="binidx")):
        with pytest.raises(ValueError):
            api.export(spark, out, target, **bad)


#: A tokenizer file that knows a few words.
WORD_FILE = {
    "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
    "model": {"type": "WordLevel", "vocab": {"[UNK]": 0, "text": 1, "number": 2, "<|endoftext|>": 3}, "unk_token": "[UNK]"},
}


def test_registry(spark, tmp_path):
    out = str(tmp_path / "o")
    assert api.register_dataset(spark, "a", out, dataset_type="PT") == 1 and api.register_dataset(spark, "b", out, dataset_type="SFT") == 2
    with pytest.raises(ValueError, match="01"):
        api.register_dataset(spark, "a", out, dataset_type="PT")


def test_chat_file(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"Conversations":[{"from":"h","value":"x"}]}\n{"question":"q","output":"o"}\n')
    api.normalize_chat_file(spark, str(tmp_path / "c.jsonl"), str(tmp_path / "o"))
    got = {r[0] for r in spark.read.text(str(tmp_path / "o")).collect()}
    assert got == {'{"messages":[{"role":"h","content":"x"}]}', '{"user":"q","assistant":"o"}'}


def test_chats_end_to_end(spark, tmp_path):
    say = lambda *turns: {"messages": [{"role": r, "content": c, **({"score": x[0]} if x else {})} for r, c, *x in turns]}
    chats = [say(("user", "a"), ("assistant", "b"), ("user", "c")), say(("user", "a"), ("assistant", "b")), say(("user", "a"), ("assistant", "d")), say(("user", "x")), say()]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(c) for c in chats))
    rows = {r.content: r for r in api.import_chats(spark, str(tmp_path / "c.jsonl"), 5, str(tmp_path / "o")).collect()}
    assert set(rows) == set("abcdx") and all(r.line_id.startswith("00050000") for r in rows.values())
    assert rows["a"].line_id < rows["b"].line_id < rows["c"].line_id < rows["d"].line_id  # in the order of the file
    assert rows["b"].frontID == rows["d"].frontID == rows["a"].line_id and rows["c"].indexID == rows["a"].line_id == rows["a"].indexID
    assert {c: r.end for c, r in rows.items()} == {"a": "false", "b": "false", "c": "true", "d": "true", "x": "false"}
    threads = sorted([m["content"] for m in json.loads(r.value)["message"]] for r in spark.read.text(str(tmp_path / "o" / "threads_sft" / "0005")).collect())
    assert threads == [["a", "b", "c"], ["a", "d"], ["x"]]
    pairs = [say(("user", "p", None), ("assistant", "good", 2.0)), say(("user", "p", None), ("assistant", "bad", 1.0))]
    (tmp_path / "d.jsonl").write_text("\n".join(json.dumps(c) for c in pairs))
    assert api.import_chats(spark, str(tmp_path / "d.jsonl"), 6, str(tmp_path / "o"), preferences=True).count() == 3
    got = [json.loads(r.value)["messages"] for r in spark.read.text(str(tmp_path / "o" / "threads_dpo" / "0006")).collect()]
    assert [[(m["content"], m.get("score")) for m in g] for g in got] == [[("p", None), ("good", 2.0), ("bad", 1.0)]]


def test_presets_and_predictor(spark):
    df = spark.createDataFrame([("a b", 1), ("c d", 0)] * 5, "text string, label int")
    m = models.train_quality(df, features=64, rounds=5)
    assert models.predict_preset(df, m, "gpt3").count() == 10
    for bad in (("none", None), ("chinese", None)):
        with pytest.raises(ValueError):
            models.predict_preset(df, m, *bad)
    f = models.labels_udf(lambda ts: [[float(len(t)), 0.0] for t in ts], ["x", "y"])
    got = [r[0] for r in spark.createDataFrame([("",), ("abc",), (None,)], "t string").select(f(F.col("t"))).collect()]
    assert got[0] == {"x": 0.5, "y": 0.5} == got[2] and got[1]["x"] > 0.9 and abs(sum(got[1].values()) - 1) < 1e-9

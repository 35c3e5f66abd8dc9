import io
import json
import zipfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake import api
from tarnlake.functions import tokenizers
from tarnlake.sources import files
from tarnlake.sources.token_files import best_type, merge_indexes, prefixes, read_index, read_sequence, TokenFiles, write_index


def test_json_lines(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.jsonl").write_bytes(b'{"body":"x","title":"T","n":1}\nbroken\n{"other":1}\n{"body":null}\n{"body":"y\xff"}\n')
    got = {(r.text, r.title) for r in files.read_json_lines(spark, str(tmp_path), "body").collect()}
    assert got == {("x", "T"), ("y", "")}


def test_parquet(spark, tmp_path):
    spark.createDataFrame([("x", 1), (None, 2)], "body string, n int").write.parquet(str(tmp_path / "p" / "a.parquet"))
    assert [tuple(r) for r in files.read_parquet_text(spark, str(tmp_path / "p"), "body").collect()] == [("x", "", '{"n":1}')]
    assert files.read_parquet_text(spark, str(tmp_path / "p"), "none").count() == 0
    with pytest.raises(NotImplementedError):
        files.load_dataset(spark, "x.csv")
    assert files.load_datasets(spark, []) is None


def test_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text(" one \ntwo")
    (tmp_path / "b.md").write_text("# b")
    (tmp_path / "c.html").write_text("<html><head><title>x</title></head><h1>Head</h1><script>var a='</p>'</script><p>Text &amp; more<li>item")
    (tmp_path / "d.pdf").write_bytes(b"%PDF")
    (tmp_path / "e.docx").write_bytes(b"not a zip")
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>Par</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>h</w:t></w:r></w:p></w:tc></w:tr><w:tr><w:tc><w:p><w:r><w:t>v</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
    (tmp_path / "f.docx").write_bytes(b.getvalue())
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("x/2.xhtml", "<p>two</p>")
        z.writestr("x/1.xhtml", "<p>one</p>")
        z.writestr("x/c.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="a" href="1.xhtml"/><item id="b" href="2.xhtml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
    (tmp_path / "g.epub").write_bytes(b.getvalue())
    got = {r.title: (r.text, r.error) for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got["a"][0] == "*one*\n*two*" and got["b"][0] == "# b" and got["c"][0] == "# Head\n\nText & more\n- item"
    assert got["d"] == (None, "no converter for .pdf") and "BadZipFile" in got["e"][1]
    assert got["f"][0] == "Par\n\n| h |\n| --- |\n| v |\n" and got["g"][0] == "one\n\ntwo"


def test_markdown_rows(spark):
    df = spark.createDataFrame([("a\na\n \n<>\n> b（\nPROMO x\nc",), (None,)], "t string")
    assert [r[0] for r in df.select(files.clean_markdown_rows(F.col("t"), ("PROMO",))).collect()] == ["a\nb\nc", None]


def test_token_files(spark, tmp_path):
    spark.dataSource.register(TokenFiles)
    rows = [([1, 2, 3], [3]), ([], []), ([4, 5], [1, 1]), ([65000], [1])]
    df = spark.createDataFrame(rows, "ids array<int>, lens array<int>").repartition(3)
    p = str(tmp_path / "tok")
    df.write.format("tokens").mode("append").option("dtype", "uint16").save(f"{p}-parts")
    assert sorted((r.ids, r.lens) for r in spark.read.format("tokens").option("rowsPerPartition", 1).load(f"{p}-parts").collect()) == sorted(rows) and len(prefixes(f"{p}-parts")) == 3
    df.write.format("tokens").mode("append").option("dtype", "uint16").option("single", "true").save(p)
    back = spark.read.format("tokens").load(p).collect()
    assert sorted((r.ids, r.lens) for r in back) == sorted(rows)
    ix = read_index(f"{p}.idx")
    assert ix.dtype == "uint16" and ix.lengths.sum() == 6 and len(ix.bounds) == 5
    assert list(ix.pointers) == list(np.concatenate([[0], np.cumsum(ix.lengths)[:-1]]) * 2)
    i = int(np.argmax(ix.lengths))
    assert list(read_sequence(p, ix, i, 1, 2)) == [2, 3]
    write_index(str(tmp_path / "e.idx"), "int32", np.zeros(0, np.int32), np.zeros(1, np.int64))
    lengths, bounds = merge_indexes([ix, read_index(str(tmp_path / "e.idx")), ix])
    assert len(lengths) == 2 * len(ix.lengths) and list(bounds[:5]) == list(ix.bounds)
    assert best_type(50_000) == "uint16" == best_type(65_534) and best_type(65_535) == "int32" and best_type(100_000) == "int32" and best_type(None) == "int32"


def test_tokenizers(spark, tmp_path):
    assert tokenizers.build_tokenizer("null", 10).tokenize("1 2") == [1, 2]
    with pytest.raises(NotImplementedError):
        tokenizers.build_tokenizer("none")
    assert tokenizers.padded_vocabulary(50_257) == 50_304 and tokenizers.padded_vocabulary(128, 128, 2) == 256
    v = tmp_path / "v.txt"
    v.write_text("\n".join(["[UNK]", "[SEP]", "un", "##aff", "##able", "cafe", ",", "中"]))
    t = tokenizers.build_tokenizer("wordpiece", str(v))
    assert t.tokenize("Unaffable, café 中x") == [2, 3, 4, 6, 5, 7, 0]
    df = spark.createDataFrame([("1 2",), ("",), (None,)], "t string")
    got = [tuple(r[0]) for r in df.select(tokenizers.encode_udf("null", 9)("t")).collect()]
    assert got == [([1, 2, 9], [3]), ([], []), ([], [])]


def test_import_and_export(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [{"body": "Hello  world!!", "title": "t"}, {"body": "Hello world!", "title": "t2"}, {"body": "Other text"}]
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, lines)))
    meta = api.import_documents(spark, str(tmp_path / "in"), "jsonl", "body", 26, str(tmp_path / "out")).collect()
    assert len(meta) == 2 and all(r.line_id.startswith("001a0000") for r in meta)
    chats = [{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, {"messages": [{"role": "user", "content": "a"}]}, {"x": 1}]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, chats)))
    assert api.import_chats(spark, str(tmp_path / "c.jsonl"), 1, str(tmp_path / "out")).count() == 2
    api.export_tokens(spark.createDataFrame([("1 2 3",), ("4",)], "text string"), str(tmp_path / "tok"), "null", 100)
    assert sorted(r.ids for r in spark.read.format("tokens").load(str(tmp_path / "tok")).collect()) == [[1, 2, 3, 100], [4, 100]]


def test_stream(spark, tmp_path):
    from tarnlake.streaming.ingest import import_stream, windowed_counts

    src = tmp_path / "src"
    rows = [("1", "a"), ("2", "a"), ("3", "b"), ("4", None)]
    spark.createDataFrame(rows, "line_id string, text string").coalesce(1).write.parquet(str(src))
    run = lambda: import_stream(spark.readStream.schema("line_id string, text string").parquet(str(src)), str(tmp_path / "store"), str(tmp_path / "cp")).start().awaitTermination()
    run()
    spark.createDataFrame([("0", "b"), ("5", "c")], "line_id string, text string").coalesce(1).write.mode("append").parquet(str(src))
    run()
    assert {(r.line_id, r.text) for r in spark.read.parquet(str(tmp_path / "store")).collect()} == {("1", "a"), ("3", "b"), ("5", "c")}
    e = spark.createDataFrame([("x", "2025-01-01 00:10:00"), ("x", "2025-01-01 00:50:00")], "event_type string, t string").select("event_type", F.to_timestamp("t").alias("ts"))
    assert windowed_counts(e).collect()[0].n == 2


def test_json_keeps_types(spark, tmp_path):
    lines = ['{"n":1,"o":{"k":[1,2.5,null]},"b":true,"z":null,"t":"x","title":"a \\"b\\""}', "{broken", '{"n":1}', '{"t":null}', '{"t":"y","title":7}', "[1]", '{"t":"z","title":null,"big":12345678901234567890}', ""]
    (tmp_path / "a.jsonl").write_bytes("\n".join(lines).encode() + b'\n{"t":"q\xff"}')
    got = {r.text: (r.title, r.other) for r in files.read_json_lines(spark, str(tmp_path), "t").collect()}
    assert set(got) == {"x", "y", "z", "q"}
    assert got["x"] == ('a "b"', '{"n":1,"o":{"k":[1,2.5,null]},"b":true,"z":null,"title":"a \\"b\\""}')
    assert got["y"] == ("7", '{"title":7}') and got["z"][0] == "" and got["z"][1] == '{"title":null,"big":12345678901234567890}'


def test_parquet_folder_with_other_files(spark, tmp_path):
    spark.createDataFrame([("x", 1)], "body string, n int").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("y", "w")], "other_text string, m string").write.parquet(str(tmp_path / "b"))
    assert [r.text for r in files.read_parquet_text(spark, str(tmp_path), "body").collect()] == ["x"]


def test_chats_are_numbered_in_file_order(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"messages": [{"role": "user", "content": f"{name}{i:03d}"}]}) for i in range(300)))
    want = [f"{n}{i:03d}" for n in "ab" for i in range(300)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert [r.messages[0].content for r in files.read_chats(spark, str(tmp_path)).orderBy("conv_id").collect()] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_special_tokens_and_merges(tmp_path):
    v, m = tmp_path / "vocab.json", tmp_path / "merges.txt"
    v.write_text(json.dumps({t: i for i, t in enumerate(["l", "o", "w", "Ġ", "lo", "low", "Ġlow", "<|endoftext|>"])}))
    m.write_text("#version: 0.2\nl o\nlo w\nĠ low\n")
    t = tokenizers.build_tokenizer(*tokenizers.tokenizer_arguments("GPT2BPETokenizer", str(v), str(m)))
    assert t.tokenize("low low") == [5, 6] and t.detokenize([5, 6, 7]) == "low low" and t.eod == 7 and t.inv_vocab[6] == "Ġlow"
    with pytest.raises(NotImplementedError):
        t.mask
    with pytest.raises(NotImplementedError):
        tokenizers.tokenizer_arguments("none")
    found = sorted(Path("/opt/tokenizers").glob("*.model"))
    if found:
        p = tokenizers.build_tokenizer("pieces", str(found[0]), "plain", 2)
        ids = p.tokenize("a word<EOD>and more<extra_id_1>")
        assert p.eod in ids and p.vocab["<extra_id_1>"] in ids and p.detokenize(ids).count("<EOD>") == 1
        assert p.vocab_size == len(p.vocab) and p.mask != p.cls


def test_sentences_for_encoding():
    assert tokenizers.text_sentences("One. Two!\nThree") == ["One.", "Two!", "Three"]
    assert tokenizers.text_sentences("One. Two!\nThree", keep_space=True) == ["One. ", "Two!\n", "Three"]
    assert [len(x) for x in tokenizers.text_sentences("x" * 25, piece=10)] == [10, 10, 5] and tokenizers.text_sentences("") == []


def test_page_limit_and_tree(spark, tmp_path):
    rows = [("a", b"/Type /Page\n" * 3), ("b", b"/Type/Page\n" * 11), ("c", b""), ("d", None)]
    assert [r.path for r in files.few_pages(spark.createDataFrame(rows, "path string, content binary"), 10).collect()] == ["a"]
    (tmp_path / "Z").mkdir()
    (tmp_path / "Z" / "f.txt").write_text("")
    (tmp_path / ".git").mkdir()
    (tmp_path / "a.txt").write_text("")
    assert files.folder_tree(str(tmp_path)) == ["Z/", "  f.txt", "a.txt"]

"""Files read as tables: tolerant line-wise JSON, Parquet, chats, and document formats turned into Markdown."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from functools import reduce
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.clean import SPACE
from tarnlake.operators.packing import running_sum


def _reader(spark: SparkSession, suffix: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")


def split_record(value: Column, text_key: str) -> Column:
    """(text, title, other) of a JSON object: the text under ``text_key``, the title as text, all other fields as JSON with
    the types and the order they had (fields of nested objects by name). Null for what is no object; the text is null where the key is missing or null."""
    fields = F.from_json(value, "map<string,variant>", {"mode": "PERMISSIVE"})

    def said(m: Column, key: str) -> Column:
        v = F.try_element_at(m, F.lit(key))
        kind = F.schema_of_variant(v)
        # nested values and numbers stand for themselves as JSON, texts without quotation marks
        return F.when(kind == "VOID", F.lit(None).cast("string")).when(kind == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))

    def parts(m: Column) -> Column:
        # a title that says nothing (missing, null, empty, zero, false) is empty
        title = F.coalesce(said(m, "title"), F.lit(""))
        return F.struct(said(m, text_key).alias("text"), F.when(title.isin("0", "false", "[]", "{}"), "").otherwise(title).alias("title"), F.to_json(F.map_filter(m, lambda k, v: k != text_key)).alias("other"))

    # the record is parsed once: what is made of it is made inside one lambda
    return F.get(F.transform(F.array(fields), parts), 0)


def read_parquet_text(spark: SparkSession, path: str, text_key: str) -> DataFrame:
    """(text, title, other) of Parquet files below ``path``; files without ``text_key`` give no rows, whatever the others hold."""
    df = _reader(spark, ".parquet").option("mergeSchema", True).parquet(path)
    if text_key not in df.columns:
        return spark.createDataFrame([], "text string, title string, other string")
    rest = [c for c in df.columns if c != text_key]
    other = F.to_json(F.struct(*rest)) if rest else F.lit("{}")
    return df.select(F.col(text_key).cast("string").alias("text"), (F.col("title").cast("string") if "title" in df.columns else F.lit("")).alias("title"), other.alias("other")).where("text is not null")


def read_json_lines(spark: SparkSession, path: str, text_key: str, suffix: str = ".jsonl") -> DataFrame:
    """(text, title, other) of line-wise JSON. A malformed line, one without ``text_key`` or with a null text is skipped;
    bytes that are no UTF-8 don't stop the reading. ``other`` is the rest of the record as JSON. Gzipped files are read too."""
    lines = _reader(spark, f"{suffix}*").text(path)
    return lines.select(split_record(F.regexp_replace("value", "�", ""), text_key).alias("r")).select("r.*").where("text is not null")


def load_dataset(spark: SparkSession, path: str, text_key: str = "text", only_text: bool = False, schema: str | None = None) -> DataFrame:
    """A dataset by its suffix: .json, .jsonl or .parquet, the text column renamed to text; others raise.

    With ``only_text`` or a ``schema`` JSON is read once; else Spark reads it once more to learn its fields.
    """
    if path.rstrip("/").endswith((".json", ".jsonl")):
        schema = schema or (f"`{text_key}` string" if only_text else None)
        df = (spark.read.schema(schema) if schema else spark.read).json(path)
    elif path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        raise NotImplementedError(f"{path}: only .json, .jsonl and .parquet are read")
    df = df.withColumnRenamed(text_key, "text") if text_key != "text" else df
    return df.select("text") if only_text else df


def load_datasets(spark: SparkSession, paths: list[str], text_key: str = "text", label: int | None = None) -> DataFrame | None:
    """The texts of several datasets together, with a constant label if given; None for no path."""
    if not paths:
        return None
    df = reduce(DataFrame.unionByName, (load_dataset(spark, p, text_key, True) for p in paths))
    return df if label is None else df.withColumn("label", F.lit(label))


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """(conv_id, messages) of chat lines, numbered in the order of file paths and lines, however files are split into tasks;
    a record without messages has none, other fields are dropped."""
    schema = "messages array<struct<role:string,content:string,score:double>>"
    df = _reader(spark, ".jsonl").schema(schema).option("mode", "DROPMALFORMED").json(path)
    # within a piece of a file, tasks number lines in their order; pieces are ordered by where they begin
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
    rows = df.select(*place, F.coalesce("messages", F.array().cast("array<struct<role:string,content:string,score:double>>")).alias("messages"), F.lit(1).alias("one"))
    return running_sum(rows, [], ["path", "block", "line"], "one", "conv_id").select((F.col("conv_id") - 1).alias("conv_id"), "messages")


def explode_chats(chats: DataFrame) -> DataFrame:
    return chats.select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", "turn", "m.*")


def read_positional_csv(spark: SparkSession, path: str, columns: tuple[str, ...] = ("topic", "label", "text")) -> DataFrame:
    df = spark.read.option("multiLine", True).option("escape", '"').csv(path)
    return df.select(*[F.col(df.columns[i]).alias(c) for i, c in enumerate(columns) if i < len(df.columns)])


def text_to_markdown(c: Column) -> Column:
    """Every line trimmed and set in stars."""
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.concat(F.lit("*"), F.regexp_replace(x, rf"\A{SPACE}+|{SPACE}+\z", ""), F.lit("*"))), "\n")


def clean_markdown_rows(c: Column, promotions: tuple[str, ...] = ()) -> Column:
    """Rows of a converted book: trimmed; one that repeats the row kept before, that is blank or only spaces and
    angle brackets, or that holds a promotion is dropped; one leading > and trailing （ ］ are cut."""
    rows = F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, rf"\A{SPACE}+|{SPACE}+\z", ""))

    def step(kept: Column, row: Column) -> Column:
        drop = row.rlike(r"\A[\s<>]*\z") | (F.coalesce(F.try_element_at(kept, F.lit(-1)), F.lit("")) == row)
        for p in promotions:
            drop = drop | row.contains(p)
        cut = F.regexp_replace(F.regexp_replace(F.regexp_replace(row, "[（］]+$", ""), "^>", ""), rf"\A{SPACE}+|{SPACE}+\z", "")
        return F.when(drop, kept).otherwise(F.concat(kept, F.array(cut)))

    return F.array_join(F.aggregate(rows, F.array().cast("array<string>"), step), "\n")


class _Markdown(HTMLParser):
    """The readable part of a page as Markdown: headings, paragraphs, lists; scripts, styles and links' targets left out."""

    BLOCK = {"p", "div", "section", "article", "br", "tr", "table", "ul", "ol", "blockquote", "pre", "header", "footer", "main", "body"}
    SKIP = {"script", "style", "head", "nav", "noscript", "template", "svg"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag in self.BLOCK:
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in self.BLOCK or re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(re.sub(r"\s+", " ", data))


def html_to_markdown(html: str) -> str:
    p = _Markdown()
    p.feed(html)
    p.close()
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(p.out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def docx_to_markdown(data: bytes) -> str:
    """Paragraphs, a blank line, then tables with a rule under their first row."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{w}body")
    if body is None:
        return ""
    said = lambda node: "".join(t.text or "" for t in node.iter(f"{w}t"))
    out = [said(p) for p in body.findall(f"{w}p")] + [""]
    for t in body.findall(f"{w}tbl"):
        rows = [[said(c).strip() for c in r.findall(f"{w}tc")] for r in t.findall(f"{w}tr")]
        for i, r in enumerate(rows):
            out.append("| " + " | ".join(r) + " |")
            if i == 0:
                out.append("| " + " | ".join(["---"] * len(r)) + " |")
        out.append("")
    return "\n".join(out)


def epub_to_markdown(data: bytes, promotions: tuple[str, ...] = ()) -> str:
    """The book's pages in reading order, each as Markdown with its rows cleaned, and a blank line between."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = [n for n in z.namelist() if n.lower().endswith((".html", ".xhtml", ".htm"))]
        order = names
        opf = next((n for n in z.namelist() if n.endswith(".opf")), None)
        if opf:
            root = ElementTree.fromstring(z.read(opf))
            ns = {"o": "http://www.idpf.org/2007/opf"}
            items = {i.get("id"): i.get("href") for i in root.findall(".//o:manifest/o:item", ns)}
            base = opf.rpartition("/")[0]
            spine = [f"{base}/{items[r.get('idref')]}".lstrip("/") for r in root.findall(".//o:spine/o:itemref", ns) if r.get("idref") in items]
            order = [n for n in spine if n in names] + [n for n in names if n not in spine]
        pages = [html_to_markdown(z.read(n).decode("utf-8", "replace")) for n in order]
    return "\n\n".join(kept_rows(p, promotions) for p in pages)


def kept_rows(text: str, promotions: tuple[str, ...] = ()) -> str:
    """As ``clean_markdown_rows``, for one text."""
    kept: list[str] = []
    for row in (r.strip() for r in text.split("\n")):
        if not row.strip(" <>") or (kept and row == kept[-1]) or any(p in row for p in promotions):
            continue
        kept.append(row.rstrip("（］").removeprefix(">").strip())
    return "\n".join(kept).strip()


def read_documents(spark: SparkSession, path: str, convert: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """(title, text, error) of every document file below ``path``, converted once each by its suffix.

    .txt, .md, .html, .docx and .epub are built in; .pdf, .doc and others need a function in ``convert`` and are else
    reported in ``error``, as are files that can't be read.
    """
    known: dict[str, Callable[[bytes], str]] = {
        "txt": lambda b: "\n".join(f"*{x.strip()}*" for x in b.decode("utf-8", "replace").split("\n")), "md": lambda b: b.decode("utf-8", "replace"),
        "html": lambda b: html_to_markdown(b.decode("utf-8", "replace")), "htm": lambda b: html_to_markdown(b.decode("utf-8", "replace")), "docx": docx_to_markdown, "epub": epub_to_markdown,
    } | (convert or {})

    def run(batches):
        for b in batches:
            rows = []
            for p, data in zip(b.path, b.content):
                name = p.rpartition("/")[2]
                stem, _, ext = name.rpartition(".")
                try:
                    rows.append((stem or name, known[ext.lower()](bytes(data)), None))
                except KeyError:
                    rows.append((stem or name, None, f"no converter for .{ext}"))
                except Exception as e:  # a broken file is reported, the others are read
                    rows.append((stem or name, None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=["title", "text", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInPandas(run, "title string, text string, error string")


def read_whole_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON files that hold one object or a list over many lines."""
    return _reader(spark, ".json").option("multiLine", True).json(path)


def read_stop_words(path: str) -> list[str]:
    """One word a line; blank lines and repeats dropped, order kept."""
    with open(path, encoding="utf-8") as f:
        return list(dict.fromkeys(w for w in (line.strip() for line in f) if w))


def markdown_to_plain(c: Column) -> Column:
    """Markdown without headings' marks, emphasis, links' targets, images and rules."""
    c = F.regexp_replace(c, r"!\[[^\]]*\]\([^)]*\)", "")
    c = F.regexp_replace(c, r"\[([^\]]*)\]\([^)]*\)", "$1")
    c = F.regexp_replace(c, r"(?m)^\s{0,3}(?:#{1,6}\s+|>\s?|[-*_]{3,}\s*$)", "")
    return F.regexp_replace(c, r"(\*\*|__|\*|_|`)(\S(?:.*?\S)?)\1", "$2")


def file_sizes(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, length) of files below ``path``; contents aren't read."""
    return _reader(spark, suffix).format("binaryFile").load(path).select("path", "length")


def nonempty(files: DataFrame) -> DataFrame:
    return files.where("length > 0")


def pdf_pages(data: bytes) -> int:
    """Pages of an uncompressed page tree; compressed ones need a converter of their own."""
    return len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", data))


def few_pages(files: DataFrame, most: int = 10, pages: Callable[[bytes], int] = pdf_pages) -> DataFrame:
    """(path, n_pages) of the files (path, content) of at most ``most`` pages; unreadable ones are left out."""

    @F.pandas_udf("int")
    def count(contents: pd.Series) -> pd.Series:
        def one(data):
            try:
                return pages(bytes(data))
            except Exception:  # a file that can't be read has no known number of pages
                return None

        return contents.map(one).astype("Int32")

    return files.select("path", count("content").alias("n_pages")).where(F.col("n_pages").between(1, most))


def folder_tree(path: str, depth: int = 0) -> list[str]:
    """The folder's tree as lines, folders before files, both by name without case; folders of version control are left out."""
    import os

    hidden = {".git", ".svn", ".hg"}
    entries = sorted(os.scandir(path), key=lambda e: (not e.is_dir(), e.name.lower()))
    out = []
    for e in entries:
        if e.name in hidden:
            continue
        out.append("  " * depth + e.name + ("/" if e.is_dir() else ""))
        if e.is_dir(follow_symlinks=False):
            out += folder_tree(e.path, depth + 1)
    return out

"""Statistics, sentences, chunks and ids of texts as column expressions. Everything stays inside one row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarnlake.functions.clean import HAN, SPACE


def positions(n: Column) -> Column:
    """0 .. n - 1; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: it is bound as the element of an array of one."""
    return F.element_at(F.transform(F.array(value), use), 1)


def runs(items: Column) -> Column:
    """Of an array: (neg_count, first, item) of each distinct element, by one sort of the array."""
    s = F.sort_array(F.transform(items, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def boundaries(s: Column) -> Column:
        starts = F.filter(positions(F.size(s)), lambda i: (i == 0) | (F.get(s, i)["x"] != F.get(s, i - 1)["x"]))
        return let(starts, lambda at: F.transform(at, lambda p, j: F.struct((p - F.coalesce(F.get(at, j + 1), F.size(s))).alias("neg_count"), F.get(s, p)["i"].alias("first"), F.get(s, p)["x"].alias("item"))))

    return let(s, boundaries)


def tokens_for_ngrams(c: Column) -> Column:
    """Words between white space if the text has a space, else its characters."""
    words = F.filter(F.split(c, rf"{SPACE}+"), lambda w: w != "")
    return F.when(c.contains(" "), words).otherwise(F.filter(F.split(c, ""), lambda w: w != ""))


def ngram_repeat_rate(c: Column, n: int) -> Column:
    """Distinct n-grams that occur more than once, over all n-grams; 0 for a text of fewer than n tokens.

    n-grams are told apart by a 64-bit hash, so a long text needs no longer array than it has tokens.
    """

    def rate(t: Column) -> Column:
        total = F.size(t) - (n - 1)
        grams = F.transform(positions(total), lambda i: F.xxhash64(F.slice(t, i + 1, n)))
        repeated = let(F.sort_array(grams), lambda g: F.size(F.filter(positions(F.size(g)), lambda i: (i > 0) & (F.get(g, i) == F.get(g, i - 1)) & ((i < 2) | (F.get(g, i - 2) != F.get(g, i - 1))))))
        return F.when(total > 0, repeated / total).otherwise(F.lit(0.0))

    return F.when(c.isNotNull(), let(tokens_for_ngrams(c), rate))


def words(c: Column) -> Column:
    """Tokens without outer punctuation, as they are written."""
    return F.filter(F.transform(F.split(c, rf"{SPACE}+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")), lambda w: w != "")


def keywords(c: Column, stop_words: list[str], top: int = 5) -> Column:
    """The ``top`` most frequent alphabetic words that aren't stop words, ties by first appearance, joined by ", "."""
    good = F.filter(words(c), lambda w: w.rlike(r"^\p{L}+$") & ~F.lower(w).isin(stop_words))
    best = F.slice(F.sort_array(runs(good)), 1, top)
    return F.when(c.isNotNull(), F.array_join(F.transform(best, lambda r: r["item"]), ", "))


def split_sentences(c: Column) -> Column:
    """Sentences: a break after an end mark, six dots or a double ellipsis unless a closing quote follows, and after that quote."""
    c = F.regexp_replace(c, "([.。！!?])([^’”])", "$1\n$2")
    c = F.regexp_replace(c, r"(\.{6})([^’”])", "$1\n$2")
    c = F.regexp_replace(c, "(…{2})([^’”])", "$1\n$2")
    c = F.regexp_replace(c, "([.。！!?{}26…][’”])([^’”])", "$1\n$2")
    return F.split(c, "\n")


def drop_repeated_sentences(c: Column, least: int = 3) -> Column:
    """Each sentence of a text only where it first stands; sentences under ``least`` letters and digits always stay."""
    key = lambda s: F.regexp_replace(s, r"[^a-zA-Z0-9\x{4e00}-\x{9fa5}]", "")
    flat = F.flatten(F.transform(F.split(c, "\n"), lambda line, i: F.transform(F.when(line == "", F.array(F.lit(""))).otherwise(split_sentences(line)), lambda s: F.struct(i.alias("line"), s.alias("s"), key(s).alias("k")))))

    def fold(all_: Column) -> Column:
        # the first places of all keys, by one sort; a key too short to count stands wherever it is
        firsts = F.transform(F.filter(runs(F.transform(all_, lambda x: x["k"])), lambda r: F.length(r["item"]) >= least), lambda r: r["first"])
        return let(F.map_from_arrays(firsts, firsts), lambda known: let(F.transform(all_, lambda x, i: F.struct(x["line"].alias("line"), F.when((F.length(x["k"]) < least) | F.map_contains_key(known, i), x["s"]).otherwise(F.lit("")).alias("s"))), joined))

    def joined(kept: Column) -> Column:
        # lines are consecutive: a line end before each sentence that begins one
        return F.array_join(F.transform(kept, lambda x, i: F.concat(F.when((i > 0) & (F.get(kept, i - 1)["line"] != x["line"]), F.lit("\n")).otherwise(F.lit("")), x["s"])), "")

    return F.when(c.isNotNull(), let(flat, fold))


def _latin_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\b[a-zA-Z]+\b"))


def han_terms(c: Column) -> Column:
    """Distinct pairs of neighbouring Han characters: the stand-in for the terms of a word segmenter."""
    return F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(c, F.lit(rf"({HAN}{{2,}})")), lambda r: F.transform(positions(F.length(r) - 1), lambda i: F.substring(r, i + 1, F.lit(2))))))


def complexity(c: Column) -> Column:
    """Complexity of one text: length per sentence, sentences and, for Chinese, terms per sentence, unrounded."""
    zh = c.rlike(HAN)
    parts = F.when(zh, F.size(F.split(c, "[。？！]"))).otherwise(F.size(F.split(c, "[.?!]")))
    length = F.when(zh, F.length(c)).otherwise(_latin_words(c))
    n = parts - 1
    terms = F.when(zh & (n > 0), 0.4 * F.size(han_terms(c)) / F.when(n > 0, n)).otherwise(F.lit(0.0))
    return 0.3 * length / parts + 0.3 * n + terms


def complexity_qa(q: Column, a: Column) -> Column:
    """(question_length, answer_length, syntactic, term, overall) of a question and its answer, unrounded; term is null unless Chinese."""
    zh = q.rlike(HAN) | a.rlike(HAN)
    parts = lambda c: F.when(zh, F.size(F.split(c, "[.?!。？！]"))).otherwise(F.size(F.split(c, "[.?!]")))
    length = lambda c: F.when(zh, F.length(c)).otherwise(_latin_words(c)) / parts(c)
    n = parts(q) + parts(a) - 2
    term = F.when(zh, F.when(n > 0, F.size(F.array_union(han_terms(q), han_terms(a))) / F.when(n > 0, n)).otherwise(F.lit(0.0)))
    return F.struct(length(q).alias("question_length"), length(a).alias("answer_length"), n.alias("syntactic"), term.alias("term"), (0.2 * length(q) + 0.2 * length(a) + 0.3 * n + F.coalesce(0.3 * term, F.lit(0.0))).alias("overall"))


def chunks(c: Column, size: int = 5164, overlap: int = 200) -> Column:
    """Pieces of ``size`` characters that overlap; the last is filled up from the piece before it, less that one's last character."""
    step = size - overlap
    n = F.length(c)
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / F.lit(step)).cast("int") + 1)

    def piece(i: Column) -> Column:
        last = F.substring(c, i * step + 1, n)
        missing = F.lit(size) - F.length(last)
        before = F.substring(c, (i - 1) * step + size - missing, missing)
        return F.when(count == 1, c).when(i < count - 1, F.substring(c, i * step + 1, F.lit(size))).otherwise(F.when(missing > 0, F.concat(before, last)).otherwise(last))

    return F.transform(positions(count), piece)


def line_id(dataset: Column, file: Column, line: Column) -> Column:
    """16 hex digits: dataset (4), file (4), line (8)."""
    h = lambda x, n: F.lpad(F.lower(F.hex(x.cast("long"))), n, "0")
    return F.concat(h(dataset, 4), h(file, 4), h(line, 8))


def point_id(text: Column, chunk: Column) -> Column:
    """Id of a chunk's vector: the first 24 digits of the text's MD5, then the chunk's number, so that the same text overwrites itself."""
    return F.concat(F.left(F.md5(text), F.lit(24)), F.lpad(chunk.cast("string"), 8, "0"))


def chunk_table():
    """A table function (chunk_no, chunk) of a text, as ``chunks`` cuts it: register it with ``spark.udtf.register``."""
    from pyspark.sql.functions import udtf

    class Chunks:
        def eval(self, text: str, size: int, overlap: int):
            if text is None:
                return
            n, step = len(text), size - overlap
            count = 1 if n <= size else -(-(n - size) // step) + 1
            for i in range(count):
                part = text[i * step : i * step + size]
                if count > 1 and i == count - 1 and len(part) < size:
                    # filled up from the chunk before, whose last character doesn't count
                    before, missing = text[(i - 1) * step : (i - 1) * step + size], size - len(part)
                    part = before[-(missing + 1) : -1] + part
                yield i, part

    return udtf(Chunks, returnType="chunk_no int, chunk string")

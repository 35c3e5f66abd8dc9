"""Language of documents and passages by error-correcting output codes.

Each language has a codeword of bits; every bit is predicted by a binary classifier over character n-grams
(smoothed log-odds of the languages with that bit against those without). Loss-weighted decoding takes the
codeword with the least summed logistic loss; the share of its rival is the doubt.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.textunits import WORD, WordRows, portions, sentences, sums
from tarnlake.llm.textunits import words as words_of

LANGS = ("en", "zh", "de", "fr", "es", "ru")
#: Names and codes by which providers call the six languages, without case and region.
NAMES = {
    "en": "en eng english englisch anglais inglés ingles английский 英语 英文".split(),
    "zh": "zh zho chi cmn chinese mandarin chinesisch chinois chino китайский 中文 汉语 漢語 华语 简体中文 普通话".split(),
    "de": "de deu ger german deutsch allemand alemán aleman немецкий 德语 德文".split(),
    "fr": "fr fra fre french français francais französisch francés frances французский 法语 法文".split(),
    "es": "es spa spanish español espanol castellano spanisch espagnol испанский 西班牙语 西语".split(),
    "ru": "ru rus russian русский russisch russe ruso 俄语 俄文".split(),
}
#: Values that name no language.
SAYS_NOTHING = "null none nil nan na n/a unknown unk und undefined undetermined mis mul zxx xx other ? - -- auto multi mixed".split()
#: A few lines in each language, so that none is unknown to the model where a sample lacks it.
SEED = {
    "en": "The reason for this is that they had not been asked before. It was one of those which should have been there, and we could see what you would do with it when there is no other way. She said that most people from here know their own story about him.",
    "zh": "这是因为以前没有人问过他们。我们可以看到，如果没有别的办法，你会怎么做。她说这里的大多数人都知道自己的故事，但是他已经不在了，所以还需要更多的时间和工作。",
    "de": "Der Grund dafür ist, dass sie vorher nicht gefragt wurden. Es war eines von denen, die dort hätten sein sollen, und wir konnten sehen, was man damit macht, wenn es keinen anderen Weg gibt. Sie sagte, die meisten Leute von hier kennen ihre eigene Geschichte über ihn.",
    "fr": "La raison en est qu'ils n'avaient pas été interrogés avant. C'était l'un de ceux qui auraient dû être là, et nous pouvions voir ce que vous feriez avec cela quand il n'y a pas d'autre moyen. Elle a dit que la plupart des gens d'ici connaissent leur propre histoire.",
    "es": "La razón es que no les habían preguntado antes. Era uno de los que deberían haber estado allí, y podíamos ver qué harías con eso cuando no hay otra manera. Ella dijo que la mayoría de la gente de aquí conoce su propia historia sobre él, pero ya no está.",
    "ru": "Причина в том, что их раньше не спрашивали. Это был один из тех, кто должен был быть там, и мы могли видеть, что вы будете с этим делать, когда нет другого пути. Она сказала, что большинство людей отсюда знают свою историю о нём, но его уже нет.",
}


def named_language(c: Column) -> Column:
    """One of LANGS for any usual spelling of it, null if the value is missing or says nothing, else its base name."""
    low = F.lower(F.regexp_replace(c, r"^[\s\x{00a0}\x{3000}]+|[\s\x{00a0}\x{3000}]+$", ""))
    base = F.regexp_extract(low, r"^([^-_.@(\s]+)", 1)
    out = F.when(c.isNull() | (low == "") | low.isin(*SAYS_NOTHING), F.lit(None).cast("string"))
    for k, names in NAMES.items():
        out = out.when(base.isin(*names), k)
    return out.otherwise(F.when(low.rlike(r"\p{L}"), low))


@lru_cache(maxsize=None)
def codewords(n: int) -> np.ndarray:
    """Code for n classes, +-1: each class against the rest, and every split into halves (for 6: 16 bits, words 8 apart)."""
    sets = {frozenset([i]) for i in range(n)} | {frozenset(c) for c in combinations(range(n), n // 2) if 0 in c or n % 2}
    return np.array([[1.0 if i in c else -1.0 for c in sorted(sets, key=sorted)] for i in range(n)], np.float32)


class LanguageModel:
    """``bits``: sums of per-word log-odds, one per code bit; ``decode``: the nearest codeword and its confidence."""

    DIM = 1 << 15

    def __init__(self, langs: tuple[str, ...], weights: np.ndarray):
        self.langs, self.weights, self.codes = langs, weights, codewords(len(langs))
        self.uid = zlib.crc32(weights.tobytes())

    @staticmethod
    def grams(word: str) -> list[int]:
        w, b = f"^{word}$", zlib.crc32
        out = [b(w.encode()), *(b(c.encode()) for c in word)]
        for n in (2, 3, 4):
            out += [b(w[i : i + n].encode()) for i in range(len(w) - n + 1)]
        return [x % LanguageModel.DIM for x in out]

    @classmethod
    def of_counts(cls, table: np.ndarray, langs: tuple[str, ...] = LANGS) -> LanguageModel:
        """Log-odds from counts of n-grams (DIM x languages), to which those of the seeds are added."""
        seeds = GramCounts(len(langs))
        seeds.add([WORD.findall(SEED[k].lower()) for k in langs if k in SEED], [i for i, k in enumerate(langs) if k in SEED])
        table = table + seeds.table()
        p = (table + 0.02 * table.sum(0) / cls.DIM + 1e-9) / (table.sum(0) + 1e-6)
        bit = codewords(len(langs)) > 0
        on = np.stack([p[:, bit[:, b]].mean(1) for b in range(bit.shape[1])], 1)
        off = np.stack([p[:, ~bit[:, b]].mean(1) for b in range(bit.shape[1])], 1)
        return cls(langs, np.clip(np.log(on / off), -6, 6).astype(np.float32))

    def word_row(self, word: str) -> np.ndarray:
        g = self.grams(word)
        return np.append(self.weights[g].mean(0), 1.0)

    def bits(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log-odds by bit and the number of words, of each of ``units``."""
        return self.bits_of([words_of(u.lower()) for u in units])

    def bits_of(self, units: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """As ``bits``, of units given as their words."""
        rows = _rows(self)
        words, counts = list(chain.from_iterable(units)), np.fromiter(map(len, units), np.int64, len(units))
        s = sums(rows.rows, ids, counts) if len(ids := rows.ids(words)) else np.zeros((len(units), rows.width), np.float32)
        return s[:, :-1], s[:, -1]

    def decode(self, bits: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language whose codeword has the least loss, and the confidence in it."""
        f = bits / np.sqrt(np.maximum(words, 1))[:, None]
        loss = np.logaddexp(0, -f[:, None, :] * self.codes[None]).sum(2) / (self.codes.shape[1] / 4)
        e = np.exp(loss.min(1, keepdims=True) - loss)
        return loss.argmin(1), e.max(1) / e.sum(1)

    def label(self, units: list[str], floor: float = 0.0) -> tuple[list[str | None], np.ndarray]:
        """The language of each unit, None without words or below ``floor``, and its confidence."""
        if not units:
            return [], np.zeros(0)
        bits, words = self.bits(units)
        best, conf = self.decode(bits, words)
        conf = np.where(words > 0, conf, 0.0)
        return [self.langs[b] if c > floor and n else None for b, c, n in zip(best, conf, words)], conf


class GramCounts:
    """How often n-grams stand in texts of each language: a word counts five times a text at most."""

    def __init__(self, langs: int):
        self.langs, self.counted = langs, np.zeros((LanguageModel.DIM, langs), np.int64)
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.words = np.zeros((0, self.langs), np.int64)

    def add(self, texts: list[list[str]], langs: list[int]) -> None:
        """``texts`` as their words, and the number of the language of each."""
        words = list(chain.from_iterable(texts))
        for w in set(words).difference(self.at):
            self.at[w] = len(self.at)
        ids = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        key, n = np.unique(np.repeat(np.arange(len(texts)), [len(t) for t in texts]) * len(self.at) + ids if words else ids, return_counts=True)
        lang, word = np.asarray(langs, np.int64)[key // max(len(self.at), 1)], key % max(len(self.at), 1)
        grown = np.bincount(word * self.langs + lang, np.minimum(n, 5), len(self.at) * self.langs).astype(np.int64).reshape(-1, self.langs)
        grown[: len(self.words)] += self.words
        self.words = grown
        if len(self.at) > 200_000:
            self.table()

    def table(self) -> np.ndarray:
        """The counts so far (DIM x languages)."""
        for w, i in self.at.items():
            np.add.at(self.counted, LanguageModel.grams(w), self.words[i])
        self._forget()
        return self.counted


_TABLES: dict[int, WordRows] = {}


def _rows(model: LanguageModel) -> WordRows:
    """The word matrix of a model, kept while the Python worker lives."""
    if model.uid not in _TABLES:
        _TABLES.clear()
        _TABLES[model.uid] = WordRows(model.codes.shape[1] + 1, model.word_row)
    return _TABLES[model.uid]


def labelled(documents: DataFrame) -> DataFrame:
    """(text, lang) of all ``documents`` (text, lang) whose declared language is one of the six."""
    return documents.select("text", named_language(F.col("lang")).alias("lang")).where(F.col("lang").isin(*LANGS) & (F.col("text") != ""))


#: What callers knew it by when it took a bounded number.
labelled_sample = labelled


def train_language_model(texts: DataFrame, passes: int = 2) -> LanguageModel:
    """The model of all ``texts`` (text, lang), counted where they lie; after the first pass texts whose label the model
    disputes are left out, as labels are dirty. Whatever the input, at most DIM counts a language reach the driver."""
    model = None
    for _ in range(passes):

        def count(batches, before=model):
            counts = GramCounts(len(LANGS))
            for b in batches:
                langs, at = [LANGS.index(x) for x in b.lang], 0
                for part in portions(b.text.tolist()):
                    words, own, at = [words_of(t.lower()) for t in part], langs[at : at + len(part)], at + len(part)
                    if before:
                        bits, n = before.bits_of(words)
                        ok = (before.decode(bits, n)[0] == own) & (n > 0)
                        words, own = [w for w, x in zip(words, ok) if x], [y for y, x in zip(own, ok) if x]
                    counts.add(words, own)
            table = counts.table().ravel()
            k = np.flatnonzero(table)
            yield pd.DataFrame({"k": k.astype(np.int32), "n": table[k]})

        got = texts.select("text", "lang").mapInPandas(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros(LanguageModel.DIM * len(LANGS))
        table[got.k.to_numpy()] = got.n.to_numpy()
        model = LanguageModel.of_counts(table.reshape(-1, len(LANGS)))
    return model


#: Words a sentence must have to be judged, a Han character counting half; confidence it must reach.
LEAST_WORDS, LEAST_CONFIDENCE = 3, 0.6
#: Confidence that a sentence too short or too doubtful to judge must reach to belong to a foreign one beside it.
LEAST_BESIDE = 0.4
PASSAGES = "lang string, confidence double, passages array<struct<lang:string,start:int,end:int,confidence:double>>"


def judge(model: LanguageModel, texts: list[str]) -> list[tuple | None]:
    """(language, confidence, passages) of each text; None where it has no words of a known language.

    Passages are runs of sentences in one language; sentences too short or too doubtful to judge join the run they stand in,
    and count to a foreign one beside them if they speak rather its language than another.
    """
    spans, (bits, words, best, conf, weight, sure) = _sentences_judged(model, texts)
    if not len(best):
        return [None] * len(texts)
    # a text without a sure sentence is judged as a whole
    out, k = [], 0
    for t, ss in zip(texts, spans):
        n = len(ss)
        b, c, w, ok = best[k : k + n], conf[k : k + n], weight[k : k + n], sure[k : k + n]
        total = bits[k : k + n].sum(0, keepdims=True), words[k : k + n].sum(keepdims=True)
        k += n
        if not n or not total[1][0]:
            out.append(None)
            continue
        if not ok.any():
            i, p = model.decode(*total)
            out.append((model.langs[i[0]], float(p[0]), []))
            continue
        share = np.bincount(b[ok], w[ok], len(model.langs))
        main = int(share.argmax())
        mean = float((c * w)[ok & (b == main)].sum() / share[main])
        runs: list[list] = []
        doubtful: list[tuple] = []  # sentences not sure since the last sure one
        for (s, e), i, p, good, x in zip(ss, b, c, ok, w):
            if not good:
                # one that speaks rather the language of the foreign sentence before it belongs to that passage
                if x and p >= LEAST_BESIDE and runs and i != main and runs[-1][0] == i and not doubtful:
                    runs[-1][2], runs[-1][3], runs[-1][4] = e, runs[-1][3] + p, runs[-1][4] + 1
                else:
                    doubtful.append((i, s, e, p, x))
                continue
            before = []
            while doubtful and i != main and doubtful[-1][0] == i and doubtful[-1][4] and doubtful[-1][3] >= LEAST_BESIDE:
                before.append(doubtful.pop())
            doubtful = []
            if runs and runs[-1][0] == i:
                runs[-1][2], runs[-1][3], runs[-1][4] = e, runs[-1][3] + p + sum(d[3] for d in before), runs[-1][4] + 1 + len(before)
            else:
                runs.append([i, before[-1][1] if before else s, e, p + sum(d[3] for d in before), 1 + len(before)])
        out.append((model.langs[main], mean * float(share[main] / share.sum()) if len(runs) == 1 else mean, [(model.langs[i], s, e, p / m, m) for i, s, e, p, m in runs]))
    return out


def _sentences_judged(model: LanguageModel, texts: list[str]) -> tuple[list[list[tuple[int, int]]], tuple]:
    """The sentences of each text; of all of them bits, words, the nearest language, its confidence, their weight, whether they are sure."""
    spans = [sentences(t) for t in texts]
    flat = [t[a:b] for t, ss in zip(texts, spans) for a, b in ss]
    if not flat:
        return spans, (np.zeros(0),) * 6
    bits, words = model.bits(flat)
    best, conf = model.decode(bits, words)
    zh = model.langs.index("zh") if "zh" in model.langs else -1
    weight = np.where(best == zh, words / 2, words)
    return spans, (bits, words, best, conf, weight, (weight >= LEAST_WORDS) & (conf >= LEAST_CONFIDENCE))


def judge_whole(model: LanguageModel, texts: list[str]) -> list[tuple[str, float] | None]:
    """Language and confidence of each text as ``judge`` gives them, without passages."""
    spans, (bits, words, best, conf, weight, sure) = _sentences_judged(model, texts)
    out: list[tuple[str, float] | None] = [None] * len(texts)
    if not len(best):
        return out
    n, width = np.fromiter(map(len, spans), np.int64, len(texts)), len(model.langs)
    owner, first = np.repeat(np.arange(len(texts)), n), np.cumsum(n) - n
    share = np.bincount(owner * width + best, np.where(sure, weight, 0), len(texts) * width).reshape(-1, width)
    main = share.argmax(1)
    at = np.flatnonzero(sure & (best == main[owner]))
    if len(at):
        own, each = owner[at], conf[at] * weight[at]
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1])).tolist()
        for i, j in zip(new, [*new[1:], len(at)]):
            k = own[i]
            out[k] = model.langs[main[k]], float((each[i] if j == i + 1 else each[i:j].sum()) / share[k, main[k]])
    # a text without a sure sentence is judged as a whole
    total = np.bincount(owner, words, len(texts))
    rest = [k for k in np.flatnonzero(total > 0).tolist() if out[k] is None]
    if rest:
        summed = np.stack([bits[first[k] : first[k] + n[k]].sum(0) for k in rest]), total[rest].astype(words.dtype)
        for k, i, p in zip(rest, *model.decode(*summed)):
            out[k] = model.langs[i], float(p)
    return out


def label_udf(model: LanguageModel):
    """Column function: (lang, confidence) of a text as a whole; null for null and for texts without words."""

    @F.pandas_udf("lang string, confidence double")
    def run(texts: pd.Series) -> pd.DataFrame:
        said, conf = [], []
        for part in portions(texts.fillna("").tolist()):
            a, b = model.label(part)
            said += a
            conf += b.tolist()
        return pd.DataFrame({"lang": said, "confidence": [c if s else None for s, c in zip(said, conf)]})

    return run


def passages_udf(model: LanguageModel, least_sentences: int = 2, repair=None):
    """Column function: language, confidence and the passages of at least ``least_sentences`` sentences of a text."""

    @F.pandas_udf(PASSAGES)
    def run(texts: pd.Series) -> pd.DataFrame:
        ts = texts.fillna("").tolist()
        got = []
        for part in portions(ts):
            if not repair:
                got += judge(model, part)
                continue
            restored = repair(part)
            for g, r in zip(judge(model, [r.text for r in restored]), restored):
                got.append((g[0], g[1], [(x[0], r.place(x[1]), r.place(x[2]), *x[3:]) for x in g[2]]) if g and r.edits else g)
        rows = [(None, None, []) if g is None else (g[0], g[1], [{"lang": x[0], "start": x[1], "end": x[2], "confidence": x[3]} for x in g[2] if x[4] >= least_sentences]) for g in got]
        return pd.DataFrame(rows, columns=["lang", "confidence", "passages"])

    return run


def languages_of_documents(documents: DataFrame, model: LanguageModel, repair=None) -> DataFrame:
    """``documents`` (line_id, dataset_id, text) -> line_id, dataset_id, lang, confidence, passages.

    Documents without line_id or text are left out. Places of passages are those in the stored text, repaired or not.
    """
    text = documents.where(F.col("line_id").isNotNull() & F.col("text").rlike(r"\S"))
    return text.select("line_id", "dataset_id", passages_udf(model, repair=repair)("text").alias("r")).select("line_id", "dataset_id", "r.*")


def wrong_labels(documents: DataFrame, lines: DataFrame, meta: DataFrame, messages: DataFrame, model: LanguageModel, repair=None) -> tuple[DataFrame, DataFrame]:
    """Cases and languages: ``(kind, record_id, lang)`` and what ``languages_of_documents`` found, staged.

    - line: a line of ``lines`` (line_id, language, added_date; the latest row of a line counts, ties go to the
      greater label) whose document has text in ``lang``, and whose label is missing, says nothing or names another;
    - meta: a dataset of ``meta`` (dataset_id, language) whose label fails likewise against the language of most
      of its lines, documents and ``messages`` (dataset_id, content) together; ties go to the first by name;
    - mixed: a document with passages in more than one language, one row per language of a passage, and the main one.
    Nulls and empty tables give no cases.
    """
    from tarnlake.session import stage

    found = stage(languages_of_documents(documents, model, repair), "languages")
    label = F.max_by(F.struct("language"), F.struct("added_date", F.coalesce("language", F.lit(""))))
    told = lines.where("line_id is not null").groupBy("line_id").agg(label.alias("r")).select("line_id", named_language(F.col("r.language")).alias("told"))
    line = found.where("lang is not null").join(told, "line_id").where("told is null or told <> lang").select(F.lit("line").alias("kind"), F.col("line_id").alias("record_id"), "lang")
    said = messages.where(F.col("content").rlike(r"\p{L}")).select("dataset_id", label_udf(model)("content").alias("r")).select("dataset_id", "r.lang")
    votes = found.select("dataset_id", "lang").unionByName(said).where("lang is not null").groupBy("dataset_id", "lang").count()
    most = votes.groupBy("dataset_id").agg(F.min_by("lang", F.struct(-F.col("count"), "lang")).alias("lang"))
    sets = meta.groupBy("dataset_id").agg(F.max_by(F.struct("language"), F.struct("added_date", F.coalesce("language", F.lit("")))).alias("r")).select("dataset_id", named_language(F.col("r.language")).alias("told"))
    kept = most.join(sets, "dataset_id").where("told is null or told <> lang").select(F.lit("meta").alias("kind"), F.col("dataset_id").cast("string").alias("record_id"), "lang")
    langs = F.array_distinct(F.concat(F.array("lang"), F.transform("passages", lambda p: p["lang"])))
    mixed = found.where(F.size(langs) > 1).select(F.lit("mixed").alias("kind"), F.col("line_id").alias("record_id"), F.explode(langs).alias("lang"))
    return line.unionByName(kept).unionByName(mixed).distinct(), found

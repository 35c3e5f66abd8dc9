"""Subject areas of texts by curated weighted terms.

A multi-pattern automaton finds all terms in one pass: a curated list of general terms, and the terms that reviewed texts
use of one subject only. A hit weighs its term's weight times its rarity over all texts; a text's score for a subject is the weight of its hits per word. A text is assigned every
subject whose score and number of sentences pass thresholds that are calibrated on judged texts.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.subject_terms import TERMS
from tarnlake.llm.textunits import portions
from tarnlake.session import stage

SUBJECTS = tuple(sorted(TERMS))
#: Weights of terms that other subjects use too, and of terms learned from reviewed texts.
WEAK, LEARNED = 0.4, 0.7
_GAP = re.compile(r"[^\w]+|_+")
_STOP = re.compile(r"[.!?…。！？\n](?:(?<=[。！？\n])|(?=\s|[A-ZÀ-ÖØ-ÞА-ЯЁ㐀-鿿¿¡«“„]))")
_HAN = re.compile("[㐀-鿿]")
_HANS = re.compile("[㐀-鿿]+")


class Terms:
    """Terms as they stand in normal text, and the weight of each for every subject (terms x subjects)."""

    def __init__(self, terms: list[str], weights: np.ndarray):
        self.terms, self.weights = terms, weights.astype(np.float32)
        self._automaton: ahocorasick.Automaton | None = None

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "_automaton": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                a.add_word(t, (i, len(t)))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def hits(self, text: str) -> tuple[list[tuple[int, int]], int, int]:
        """((sentence number, term number) of every hit, number of sentences, number of words).

        Of hits that overlap the longer one counts. A Han character counts as half a word.
        """
        flat, stops, n_words = normal(text)
        out: list[tuple[int, int]] = []
        last_end, last_len, k = -1, 0, 0
        for end, (i, n) in self.automaton().iter(flat):
            start = end - n + 1
            if start <= last_end - 1 and out:
                if n <= last_len:
                    continue
                out.pop()
            while k < len(stops) and stops[k] <= start:
                k += 1
            out.append((k, i))
            last_end, last_len = end, n
        return out, len(stops) + 1, n_words

    def with_learned(self, judged: list[tuple[str, set[str]]], least: int = 5, purity: float = 0.9) -> Terms:
        """These and the words, pairs of words and runs of two to four Han characters that reviewed texts use of one subject.

        ``judged``: (text, subjects). A term is learned if at least ``least`` of them hold it and at least ``purity`` of
        those are of the subject, which must be more than twice the subject's share of all; it weighs LEARNED.
        """
        if not judged:
            return self
        of_term = TermCounts()
        for text, names in judged:
            of_term.add(text, names)
        return self.with_counted(of_term, least, purity)

    def with_counted(self, of_term: dict[str, np.ndarray], least: int = 5, purity: float = 0.9) -> Terms:
        """As ``with_learned``, from the counts of candidates (see ``TermCounts``)."""
        total = of_term.get("", np.zeros(len(SUBJECTS) + 1, np.int64))
        automaton = self.automaton()
        new, weights = [], []
        for t, n in of_term.items():
            if not t or n[-1] < least or next(automaton.iter(t), None):
                continue  # what holds a curated term says no more than that
            s = int(n[:-1].argmax())
            if n[s] >= least and n[s] >= purity * n[-1] and n[s] * total[-1] > 2 * total[s] * n[-1]:
                new.append(t)
                weights.append(np.eye(len(SUBJECTS), dtype=np.float32)[s] * LEARNED)
        return Terms(self.terms + new, np.concatenate([self.weights, np.stack(weights)]) if new else self.weights)

    def with_learned_from(self, judged: DataFrame, least: int = 5, purity: float = 0.9) -> Terms:
        """As ``with_learned``, from rows (text, names), any number of them: what may be learned is counted where they lie,
        and only the counts of terms that are often and purely of a subject reach the driver."""
        columns = [f"n{k}" for k in range(len(SUBJECTS) + 1)]

        def count(batches):
            of_term = TermCounts()
            for b in batches:
                for text, names in zip(b.text, b.names):
                    of_term.add(text, set(names))
                    if len(of_term) > 100_000:
                        yield pd.DataFrame(np.stack(list(of_term.values())), columns=columns).assign(term=list(of_term))
                        of_term.clear()
            if of_term:
                yield pd.DataFrame(np.stack(list(of_term.values())), columns=columns).assign(term=list(of_term))

        counted = judged.select("text", "names").mapInPandas(count, ", ".join(f"{c} long" for c in columns) + ", term string")
        counted = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])
        top = F.greatest(*columns[:-1])
        rows = counted.where((F.col("term") == "") | ((top >= least) & (top >= purity * F.col(columns[-1])))).orderBy("term").collect()
        return self.with_counted({r.term: np.array([r[c] for c in columns]) for r in rows}, least, purity)


class TermCounts(dict):
    """Of each candidate: in how many texts of each subject it stands, and in how many in all; of "" the numbers of texts."""

    def add(self, text: str, names: set[str]) -> None:
        row = np.append([s in names for s in SUBJECTS], True).astype(np.int64)
        for t in ("", *candidates(text)):
            self[t] = self[t] + row if t in self else row


def candidates(text: str) -> set[str]:
    """What may be learned as a term of ``text``: whole words and pairs of them, runs of two to four Han characters."""
    flat = normal(text)[0]
    out: set[str] = set()
    before = ""
    for w in flat.split():
        if _HAN.search(w):
            for run in _HANS.findall(w):
                out.update(run[i : i + n] for n in (2, 3, 4) for i in range(len(run) - n + 1))
            before = ""
        elif w.isalpha():
            if len(w) > 3:
                out.add(f" {w} ")
            if before:
                out.add(f" {before} {w} ")
            before = w
        else:
            before = ""
    return out


@lru_cache(maxsize=1)
def curated() -> Terms:
    """The curated terms; one that stands under several subjects weighs for each."""
    seen: dict[str, np.ndarray] = {}
    for k, s in enumerate(SUBJECTS):
        for lang, text in TERMS[s].items():
            for t in text.split(";"):
                t = t.strip()
                w = WEAK if t.startswith("~") else 1.0
                t = t.lstrip("~").lower()
                key = t if lang == "zh" else f" {t}"
                if lang != "zh" and (len(key) <= 4 or key.endswith("$")):
                    key = key.rstrip("$") + " "  # whole words only, as are very short ones
                row = seen.setdefault(key, np.zeros(len(SUBJECTS), np.float32))
                row[k] = max(row[k], w)
    return Terms(list(seen), np.stack(list(seen.values())))


#: The characters of the lowest plane: those of words and line ends stay, all else becomes a space.
_FLAT = np.full(1 << 16, 32, np.uint16)
for _m in re.finditer(r"[^\W_]+", "".join(map(chr, range(1 << 16)))):
    _FLAT[_m.start() : _m.end()] = np.arange(_m.start(), _m.end())
_FLAT[10] = 10
_ASCII_FLAT = bytes(_FLAT[:128].astype(np.uint8)) + bytes(128)


def normal(text: str) -> tuple[str, list[int], int]:
    """``text`` in small letters with single spaces for all else, the places where sentences end in it, and its words."""
    low = "\n".join(parts := _STOP.split(text)).lower()
    if low.isascii() and "_" not in low:
        flats = low.encode().translate(_ASCII_FLAT).decode().split("\n")
    elif "_" in low or "Σ" in text or len(c := low.encode("utf-16-le", "surrogatepass")) > 2 * len(low):
        # the one is a gap beside other gaps, the other's small letter depends on what follows, the last are in no table
        flats = None
    else:
        flats = _FLAT[np.frombuffer(c, np.uint16)].tobytes().decode("utf-16-le").split("\n")
    flats = [" ".join(s.split()) for s in flats] if flats else [_GAP.sub(" ", s.lower()).strip() for s in parts]
    parts = [s for s in flats if s]
    ends = list(accumulate([len(s) + 1 for s in parts]))
    joined = " " + " ".join(parts) + " "
    return joined, ends[:-1], max(1, joined.count(" ") - 1 + _han(joined) // 2)


def _han(text: str) -> int:
    """How many Han characters ``text`` holds."""
    if text.isascii():
        return 0
    c = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    return int(np.count_nonzero((c >= 0x3400) & (c < 0xA000)))


def term_hits_udf(terms: Terms, repair=None):
    """Column function: (terms, sents, words): the terms hit, the sentence of each hit, the number of words.

    ``repair``: a function that restores wrongly decoded texts first (``encoding.full_repair``).
    """

    @F.pandas_udf("terms array<int>, sents array<int>, words int")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for part in portions(texts.fillna("").tolist()):
            for t in [r.text for r in repair(part)] if repair else part:
                h, _, w = terms.hits(t) if t else ([], 0, 0)
                rows.append(([i for _, i in h], [s for s, _ in h], w))
        return pd.DataFrame(rows, columns=["terms", "sents", "words"])

    return run


def features(weights: np.ndarray, terms: np.ndarray, sents: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """(subjects x 3): weight of hits, sentences whose heaviest subject it is, share of those among sentences with hits."""
    return features_of_all(weights, terms, sents, np.array([len(terms)]), rarity)[0]


def features_of_all(weights: np.ndarray, terms: np.ndarray, sents: np.ndarray, counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """(texts x subjects x 3): as ``features``, of texts whose hits lie one after the other, ``counts`` of each."""
    n, width = len(counts), len(SUBJECTS)
    out = np.zeros((n, width, 3), np.float32)
    if not len(terms):
        return out
    text = np.repeat(np.arange(n), counts)
    key, row = np.unique(text * (int(sents.max()) + 1) + sents, return_inverse=True)
    hit, subject = np.nonzero(weights[terms])
    w = weights[terms[hit], subject] * rarity[terms[hit]]
    weight, grid = np.zeros(n * width, np.float32), np.zeros(len(key) * width, np.float32)
    np.add.at(weight, text[hit] * width + subject, w)  # hit after hit, as a sum by columns goes
    np.add.at(grid, row[hit] * width + subject, w)
    grid = grid.reshape(-1, width)
    strong = grid.max(1) >= 0.5
    owner = key[strong] // (int(sents.max()) + 1)
    out[:, :, 0] = weight.reshape(n, width)
    out[:, :, 1] = np.bincount(owner * width + grid.argmax(1)[strong], minlength=n * width).reshape(n, width)
    out[:, :, 2] = out[:, :, 1] / np.maximum(out[:, :, 1].sum(1, keepdims=True), np.float32(1))
    return out


def rarity(hit: DataFrame, n_terms: int) -> np.ndarray:
    """Rarity of each term over all rows of ``hit`` (terms): log inverse document frequency over that of the median term.

    A table of (term, count) of the size of the term list is all that reaches the driver.
    """
    counts = hit.select(F.explode(F.array_distinct("terms")).alias("t")).groupBy("t").count().collect()
    total = hit.count()
    df = np.zeros(n_terms)
    for t, n in counts:
        df[t] = n
    idf = np.log((total + 1) / (df + 0.5))
    seen = idf[df > 0]
    return np.clip(idf / (np.median(seen) if len(seen) else 1.0), 0.25, 1.5).astype(np.float32)


class Thresholds:
    """What a subject must reach: weight per hundred words, sentences, share of the sentences with hits."""

    def __init__(self, density: float = 0.8, sentences: int = 2, share: float = 0.15):
        self.density, self.sentences, self.share = density, sentences, share

    def passes(self, f: np.ndarray, words: int) -> np.ndarray:
        return self.passes_of_all(f[None], np.array([words]))[0]

    def passes_of_all(self, f: np.ndarray, words: np.ndarray) -> np.ndarray:
        """(texts x subjects), from the features and the number of words of each text."""
        return (100 * f[:, :, 0] / np.maximum(words, 8).astype(np.float32)[:, None] >= self.density) & (f[:, :, 1] >= self.sentences) & (f[:, :, 2] >= self.share)

    @classmethod
    def grid(cls, least_sentences: int) -> list[Thresholds]:
        return [cls(d, n, sh) for d in (0.2, 0.5, 0.8, 1.2, 1.8, 2.5) for n in (least_sentences, least_sentences + 1) for sh in (0.0, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3)]

    @classmethod
    def calibrate(cls, judged: DataFrame, terms: Terms, rare: np.ndarray, least_sentences: int) -> Thresholds:
        """The laxest thresholds near the best F1 over ``judged`` (text, names); few judgements: the defaults.

        A document must give a subject two sentences at least, by definition; that bound isn't calibrated away. Each task
        sums what the thresholds of the grid assign.
        """
        grid = cls.grid(least_sentences)

        def count(batches):
            for b in batches:
                if not len(b):
                    continue
                hits = [terms.hits(t) for t in b.text]
                flat = np.array([x for h, _, _ in hits for x in h], np.int64).reshape(-1, 2)
                fs = features_of_all(terms.weights, flat[:, 1], flat[:, 0], np.array([len(h) for h, _, _ in hits]), rare)
                dens = 100 * fs[:, :, 0] / np.maximum(np.array([w for _, _, w in hits]), 8)[:, None]
                truth = np.array([[s in set(y) for s in SUBJECTS] for y in b.names])
                got = [(dens >= g.density) & (fs[:, :, 1] >= g.sentences) & (fs[:, :, 2] >= g.share) for g in grid]
                yield pd.DataFrame({"k": range(len(grid)), "both": [(x & truth).sum() for x in got], "either": [x.sum() + truth.sum() for x in got], "n": len(b)})

        sums = judged.select("text", "names").mapInPandas(count, "k int, both long, either long, n long").groupBy("k").agg(F.sum("both").alias("both"), F.sum("either").alias("either"), F.sum("n").alias("n")).orderBy("k").collect()
        default = cls(0.8, least_sentences, 0.15)
        if not sums or sums[0].n < 30:
            return default
        best = (-1.0, default)
        for r in sums:
            f1 = 2 * r.both / max(1, r.either)
            if f1 > best[0] + 0.002:  # judgements are not so exact as to tell less
                best = (f1, grid[r.k])
        return best[1]


def assign_udf(weights: np.ndarray, rare: np.ndarray, limits: Thresholds):
    """Column function: subjects assigned, from (terms, sents, words)."""

    @F.pandas_udf("array<string>")
    def run(terms: pd.Series, sents: pd.Series, words: pd.Series) -> pd.Series:
        counts = np.array([0 if t is None else len(t) for t in terms], np.int64)
        t, s = (np.concatenate([np.zeros(0, np.int64), *(x for x, n in zip(c, counts) if n)]).astype(np.int64) for c in (terms, sents))
        out: list[list[str]] = [[] for _ in counts]
        found = limits.passes_of_all(features_of_all(weights, t, s, counts, rare), words.fillna(0).to_numpy()) & (counts > 0)[:, None]
        for k, i in zip(*(x.tolist() for x in np.nonzero(found))):
            out[k].append(SUBJECTS[i])
        return pd.Series(out)

    return run


def judged_rows(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(line_id, text, names, held) of all reviewed ``texts``: the subjects most of their reviewers named, and whether a text
    is held out for calibration, as every second one is by hash of line_id. Staged."""
    named = labels.where("subjects is not null and line_id is not null").groupBy("line_id").agg(F.collect_list("subjects").alias("all"))
    most = F.filter(F.array_distinct(F.flatten("all")), lambda s: 2 * F.size(F.filter("all", lambda one: F.array_contains(one, s))) > F.size("all"))
    rows = texts.where(F.col("text").rlike(r"\p{L}")).select("line_id", "text").join(named.select("line_id", most.alias("names")), "line_id")
    return stage(rows.select("line_id", "text", "names", (F.pmod(F.xxhash64("line_id"), F.lit(2)) == 1).alias("held")), "judged")


def judged_texts(texts: DataFrame, labels: DataFrame) -> list[tuple[str, str, set[str]]]:
    """(line_id, text, the subjects most of its reviewers named) of all reviewed ``texts``, which must be few, by line_id."""
    return [(r.line_id, r.text, set(r.names)) for r in judged_rows(texts, labels).orderBy("line_id").collect()]


def learned_terms(*judged: DataFrame) -> Terms:
    """The curated terms and those learned from every second reviewed text (see ``judged_rows``); the others are left to calibrate thresholds on."""
    rows = judged[0]
    for more in judged[1:]:
        rows = rows.unionByName(more)
    return curated().with_learned_from(rows.where("not held"))


def subjects_of(texts: DataFrame, judged: DataFrame | list[tuple[str, str, set[str]]], least_sentences: int, terms: Terms | None = None, repair=None) -> DataFrame:
    """``texts`` (line_id, text) -> line_id, subjects (an array, empty for a text of none).

    ``judged`` (see ``judged_rows``, or ``judged_texts``, of which every second is held out) may be empty: then the curated terms and usual thresholds count. Null and blank texts
    get an empty array; repeated rows stay. The hits of all texts are staged once: rarity is counted over all of them
    before any is scored.
    """
    if isinstance(judged, list):
        rows = [(line, t, sorted(y), k % 2 == 1) for k, (line, t, y) in enumerate(judged)]
        judged = texts.sparkSession.createDataFrame(rows, "line_id string, text string, names array<string>, held boolean")
    terms = terms or learned_terms(judged)
    hit = stage(texts.select("line_id", term_hits_udf(terms, repair)("text").alias("h")).select("line_id", "h.*"), "hits")
    rare = rarity(hit, len(terms.terms))
    limits = Thresholds.calibrate(judged.where("held"), terms, rare, least_sentences)
    return hit.select("line_id", assign_udf(terms.weights, rare, limits)("terms", "sents", "words").alias("subjects"))

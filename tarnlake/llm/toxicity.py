"""Abusive, hateful or sexual passages by a linear-chain conditional random field.

Two labels, outside and offending. A token's evidence is a weight for itself and for each of its neighbours up to
two places away, over word and word-class features. Forward-backward gives each token's marginal; a sentence's
score is the mean marginal of its two most offending tokens (of a single token, its own), a text's score that of its worst
sentence.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.textunits import WordRows, portions, sentences
from tarnlake.llm.toxic_terms import CLASSES, EXAMPLES, FILL
from tarnlake.session import stage

DIM = 1 << 15
AROUND = (-2, -1, 0, 1, 2)
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_]{1,2}[ .*_-]{1,3}){4,}[^\W\d_]{1,2}(?!\w)")
_SPACED_HAN = re.compile(r"(?<=[一-鿿])[ .*_\-·]{1,2}(?=[一-鿿])")
_LONG = re.compile(r"([^\W\d_])\1{2,}")


@lru_cache(maxsize=1)
def _lexicon() -> tuple[re.Pattern, dict[str, list[str]], dict[str, list[str]]]:
    """Token pattern, classes of whole terms, classes of beginnings."""
    whole: dict[str, list[str]] = {}
    starts: dict[str, list[str]] = {}
    han: list[str] = []
    for cls, by in CLASSES.items():
        for lang, text in by.items():
            for t in text.split():
                if lang == "zh":
                    han.append(t)
                    whole.setdefault(t, []).append(cls)
                elif t.endswith("$"):
                    for w in [t[:-1]] if "[" not in t else [t[:-1].replace("[oa]", x) for x in "oa"]:
                        whole.setdefault(w, []).append(cls)
                else:
                    starts.setdefault(t, []).append(cls)
    terms = "|".join(map(re.escape, sorted(set(han), key=len, reverse=True)))
    terms = f"(?=[{''.join(sorted({t[0] for t in han}))}])(?:{terms})"  # most characters begin none
    return re.compile(rf"[^\W\d_㐀-鿿]+|{terms}|[㐀-鿿]|[“”\"«»„「」]|[.!?…。！？\n]+"), whole, starts


#: What every spaced word has: two letters or pairs of them between blanks or marks.
_MAYBE_SPACED = re.compile(r"[ .*_\n-]\w\w?[ .*_-]{1,3}\w\w?[ .*_-]{1,3}\w\w?[ .*_-]")
_HAN = re.compile("[㐀-鿿]")
#: The token pattern for texts in ASCII, and for those without Han characters: the same tokens, found faster.
_ASCII_TOKEN, _NO_HAN_TOKEN = re.compile(r"[a-z]+|\"|[.!?\n]+"), re.compile(r"[^\W\d_]+|[“”\"«»„「」]|[.!?…。！？\n]+")
#: The letters of the lowest plane as ranges, which are found faster than by their properties; the same tokens for texts without higher characters.
_LETTERS = "".join(f"{m.group()[0]}-{m.group()[-1]}" for m in re.finditer(r"[^\W\d_]+", "".join(map(chr, range(1 << 16)))))
_LOW_TOKEN = re.compile(_NO_HAN_TOKEN.pattern.replace(r"[^\W\d_]", f"[{_LETTERS}]"))


def plain(text: str) -> str:
    """``text`` in small letters with the usual disguises undone: spaced letters, marks between Han characters."""
    text = text.lower()
    if _MAYBE_SPACED.search(f" {text}"):
        text = _SPACED.sub(lambda m: re.sub(r"[ .*_-]+", "", m.group()), text)
    if not text.isascii() and _HAN.search(text):
        text = _SPACED_HAN.sub("", text)
    return text


def tokens(text: str) -> list[str]:
    """Words, Han characters or terms, quotation marks, and the marks that end sentences."""
    text = plain(text)
    if text.isascii():
        return _ASCII_TOKEN.findall(text)
    if _HAN.search(text):
        return _lexicon()[0].findall(text)
    low = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return (_LOW_TOKEN if low else _NO_HAN_TOKEN).findall(text)


def is_stop(token: str) -> bool:
    return token[0] in ".!?…。！？\n"


def classes(word: str) -> list[str]:
    _, whole, starts = _lexicon()
    return whole.get(word, []) + [c for n in range(1, len(word) + 1) for c in starts.get(word[:n], ())]


def word_features(word: str) -> list[int]:
    """Numbers of the word and of its classes; stretched letters are shortened first."""
    word = _LONG.sub(r"\1", word)
    return [zlib.crc32(f"w{word}".encode()) % DIM, *(zlib.crc32(f"c{c}".encode()) % DIM for c in dict.fromkeys(classes(word)))]


class Tagger:
    """``weights`` (around x DIM): log-odds of offending over outside by feature and place; ``trans``: scores of moves."""

    def __init__(self, weights: np.ndarray, bias: float, trans: np.ndarray):
        self.weights, self.bias, self.trans = weights.astype(np.float32), float(bias), trans.astype(np.float64)
        self.uid = zlib.crc32(self.weights.tobytes())

    def word_row(self, word: str) -> np.ndarray:
        """What the word adds to the tokens around it, and whether it ends a sentence."""
        out = np.zeros(len(AROUND) + 1, np.float32)
        self.weights[:, word_features(word)].sum(1, out=out[:-1])
        out[-1] = is_stop(word)
        return out

    def evidence(self, toks: list[str], texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all tokens but stops, in one row: log-odds, sentence number, text number (given as ``texts``)."""
        rows = _rows(self)
        ids = rows.ids(toks)
        stop = rows.rows[ids, -1] > 0
        new = stop.copy()
        new[1:] |= texts[1:] != texts[:-1]
        sent = np.cumsum(new)
        ids, sent, texts = ids[~stop], sent[~stop], texts[~stop]
        own = rows.rows[ids]
        e = own[:, AROUND.index(0)] + np.float32(self.bias)
        for d in range(1, max(AROUND) + 1):
            if d >= len(ids):
                break
            same = sent[d:] == sent[:-d]
            e[:-d] += own[d:, AROUND.index(d)] * same
            e[d:] += own[:-d, AROUND.index(-d)] * same
        return e, sent, texts

    def bound(self, top: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What no marginal of a sentence surely exceeds, by its highest evidence and length; infinite where nothing is proven.

        With r = exp(highest evidence + gain of staying), the odds of a token are at most those of all offending
        stretches around it: exp(cost) * sum over lengths L of L * r**L = exp(cost) * r / (1 - r)**2 for those with
        an outside token beside them, and r**n * exp(-gain of staying) for the whole sentence of n tokens.
        """
        stay = self.trans[1, 1] - self.trans[0, 0]
        enter, leave = self.trans[0, 1] - self.trans[0, 0], self.trans[1, 0] - self.trans[0, 0]
        cost = max(enter + leave, enter, leave) - stay
        r = np.exp(np.minimum(top + stay, -1e-3))
        return np.where(top + stay < -0.1, np.exp(cost) * r / (1 - r) ** 2 + np.exp(counts * np.log(r) - stay), np.inf)

    def marginals(self, e: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Marginal of offending of every token, by forward-backward over all sentences at once."""
        return forward_backward(e.astype(np.float64), counts, self.trans, False)[0]

    def scores(self, texts: list[str], least: float = 0.0) -> np.ndarray:
        """Score of each text, 0 for one without words.

        The sentence of the highest bound goes first; others that can't exceed its score don't matter to the text's.
        Where only scores over ``least`` matter, sentences that provably have none are left out: lower scores may come out
        lower still, those over ``least`` are the same.
        """
        found = [tokens(t) for t in texts]
        n = np.array([len(f) for f in found])
        out = np.zeros(len(texts))
        flat = [w for f in found for w in f]
        if not flat:
            return out
        e, sent, text = self.evidence(flat, np.repeat(np.arange(len(texts)), n))
        if not len(e):
            return out
        starts = np.flatnonzero(np.concatenate([[True], sent[1:] != sent[:-1]]))
        counts = np.diff(np.append(starts, len(e)))
        owner = text[starts]
        bound = self.bound(np.maximum.reduceat(e, starts).astype(np.float64), counts)
        order = np.lexsort((-bound, owner))
        first = np.zeros(len(starts), bool)
        first[order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]] = True
        for part in (first, ~first):
            hot = np.flatnonzero(part & (bound > np.maximum(out[owner], 0.999 * least)))  # below it by more than rounding
            if len(hot):
                at = np.cumsum(counts[hot]) - counts[hot]  # first token of each among those picked
                picked = np.repeat(starts[hot] - at, counts[hot]) + np.arange(counts[hot].sum())
                np.maximum.at(out, owner[hot], _two_highest(self.marginals(e[picked], counts[hot]), at))
        return out

    def spans(self, text: str, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, score) of the offending sentences of ``text``."""
        ss = sentences(text)
        return [(a, b, float(s)) for (a, b), s in zip(ss, self.scores([text[a:b] for a, b in ss], least)) if s > least]


def _two_highest(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the two highest values of each stretch of ``p``, given where each begins; a single one counts in full."""
    top = np.maximum.reduceat(p, first)
    n = np.diff(np.append(first, len(p)))
    own = np.repeat(np.arange(len(first)), n)
    where = np.flatnonzero(p == top[own])
    rest = p.copy()
    rest[where[np.unique(own[where], return_index=True)[1]]] = -1.0  # one occurrence of the highest
    return np.where(n > 1, (top + np.maximum.reduceat(rest, first)) / 2, top)


_TABLES: dict[int, WordRows] = {}


def _rows(model: Tagger) -> WordRows:
    if model.uid not in _TABLES:
        _TABLES.clear()
        _TABLES[model.uid] = WordRows(len(AROUND) + 1, model.word_row)
    return _TABLES[model.uid]


def forward_backward(x: np.ndarray, counts: np.ndarray, trans: np.ndarray, moving: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of label 1 of all tokens, and expected moves (2 x 2) summed over all sentences (left at zero unless ``moving``).

    ``x``: log-odds of label 1 of the tokens, sentence after sentence, ``counts`` of each. Probabilities are scaled to
    sum to one at each place, so none vanishes; sentences are walked together, the longest first.
    """
    p, moves = np.zeros(len(x)), np.zeros((2, 2))
    counts = np.asarray(counts)
    if not len(x):
        return p, moves
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    first, n = (np.cumsum(counts) - counts)[order], counts[order]
    live = np.searchsorted(-n, -np.arange(n[0]), "left")  # how many sentences have a token at each place
    odds = np.exp(np.clip(x, -60, 60))
    m = np.exp(np.clip(trans, -60, 60))
    steps = []
    a0, a1 = np.ones(len(n)), odds[first].astype(np.float64)
    for t in range(n[0]):
        k = live[t]
        at = first[:k] + t
        if t:
            a0, a1 = a0[:k] * m[0, 0] + a1[:k] * m[1, 0], (a0[:k] * m[0, 1] + a1[:k] * m[1, 1]) * odds[at]
        z = a0 + a1
        a0, a1 = a0 / z, a1 / z
        steps.append((at, a0, a1))
    b0, b1 = np.ones(0), np.ones(0)
    for t in range(n[0] - 1, -1, -1):
        at, a0, a1 = steps[t]
        k = len(b0)
        c0, c1 = np.ones(live[t]), np.ones(live[t])
        if k:
            nxt = b1 * odds[at[:k] + 1]
            c0[:k], c1[:k] = m[0, 0] * b0 + m[0, 1] * nxt, m[1, 0] * b0 + m[1, 1] * nxt
            if moving:
                h0, h1 = a0[:k], a1[:k]
                z = h0 * c0[:k] + h1 * c1[:k]
                h0, h1 = h0 / z, h1 / z
                moves += [[h0 @ b0 * m[0, 0], h0 @ nxt * m[0, 1]], [h1 @ b0 * m[1, 0], h1 @ nxt * m[1, 1]]]
        z = c0 + c1
        b0, b1 = c0 / z, c1 / z
        q = a1 * b1
        p[at] = q / (q + a0 * b0)
    return p, moves


def _words(sentence: str) -> list[str]:
    return [t for t in tokens(sentence) if not is_stop(t)]


def examples() -> list[tuple[list[str], list[int]]]:
    """The written examples with all their fillings, as tokens and labels."""
    out = []
    for lang, text in EXAMPLES.items():
        for line in text.split("\n"):
            slots = sorted(set(re.findall(r"\{(\w)\}", line)))
            for values in itertools.product(*(FILL[lang].get(s, "x").split("|") for s in slots)):
                filled = line
                for s, v in zip(slots, values):
                    filled = filled.replace("{" + s + "}", v)
                toks, labs = [], []
                for j, piece in enumerate(re.split(r"[\[\]]", filled)):
                    t = [x for x in tokens(piece) if not is_stop(x)]
                    toks += t
                    labs += [j % 2] * len(t)
                if toks:
                    out.append((toks, labs))
    return out


def train_tagger(clean_sentences: list[str], rounds: int = 120, l2: float = 2e-4, flagged: list[str] = (), start: Tagger | None = None) -> Tagger:
    """Fitted by gradient ascent (Adam) on the written examples, sentences of texts judged harmless, and
    ``flagged`` sentences of texts judged offending, all of whose tokens count as offending. ``start``: a tagger to go on from."""
    data = examples() + [(t, [0] * len(t)) for t in map(_words, clean_sentences) if t] + [(t, [1] * len(t)) for t in map(_words, flagged) if t]
    words = {w: i for i, w in enumerate(dict.fromkeys(w for t, _ in data for w in t))}
    feats = [word_features(w) for w in words]
    of_word, feat = np.repeat(np.arange(len(words)), [len(f) for f in feats]), np.concatenate(feats).astype(np.int64)
    ids = np.array([words[w] for t, _ in data for w in t])
    gold = np.array([y for _, ys in data for y in ys], np.float64)
    counts = np.array([len(t) for t, _ in data])
    sent = np.repeat(np.arange(len(data)), counts)
    gold_moves = np.zeros((2, 2))
    inside = sent[1:] == sent[:-1]
    np.add.at(gold_moves, (gold[:-1][inside].astype(int), gold[1:][inside].astype(int)), 1)
    near = [np.flatnonzero(sent[d:] == sent[: len(sent) - d]) for d in range(max(AROUND) + 1)]  # tokens with one d places on
    size = len(AROUND) * DIM
    theta = np.zeros(size + 1 + 4)
    theta[size] = -2.0
    if start is not None:
        theta[:size], theta[size], theta[size + 1 :] = start.weights.ravel(), start.bias, start.trans.ravel()
    mom, var = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w = theta[:size].reshape(len(AROUND), DIM)
        x = np.full(len(ids), theta[size])
        for k, d in enumerate(AROUND):
            row = np.bincount(of_word, w[k][feat], len(words))[ids]
            at = near[abs(d)]
            x[at + max(-d, 0)] += row[at + max(d, 0)]
        trans = theta[size + 1 :].reshape(2, 2)
        p, moves = forward_backward(x, counts, trans)
        err = gold - p
        grad = np.zeros_like(theta)
        g = grad[:size].reshape(len(AROUND), DIM)
        for k, d in enumerate(AROUND):
            at = near[abs(d)]
            by_word = np.bincount(ids[at + max(d, 0)], err[at + max(-d, 0)], len(words))
            g[k] += np.bincount(feat, by_word[of_word], DIM)
        grad[size] = err.sum()
        grad[size + 1 :] = (gold_moves - moves).ravel()
        grad -= l2 * len(data) * theta
        grad[size + 1 :] -= 0.05 * theta[size + 1 :] * len(data)
        mom = 0.9 * mom + 0.1 * grad
        var = 0.999 * var + 0.001 * grad**2
        theta += 0.08 * (mom / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.999**step)) + 1e-8)
    return Tagger(theta[:size].reshape(len(AROUND), DIM).copy(), theta[size], theta[size + 1 :].reshape(2, 2))


def judged(documents: DataFrame, labels: DataFrame, toxic: bool, bound: int = 1_200) -> list[str]:
    """Texts of at most ``bound`` documents whose reviewers all called them toxic, or none did, first by hash of line_id."""
    votes = labels.where("toxic is not null").groupBy("line_id").agg(F.min("toxic").alias("least"), F.max("toxic").alias("most"))
    some = documents.where(F.col("text").rlike(r"\p{L}")).select("line_id").distinct().join(votes.where("least > 0" if toxic else "most = 0"), "line_id")
    some = F.broadcast(some.select("line_id").orderBy(F.xxhash64("line_id"), "line_id").limit(bound))
    return [t for _, t in documents.join(some, "line_id", "left_semi").select("line_id", "text").orderBy("line_id").collect()]


def train_reviewed(harmless: list[str], toxic: list[str], common: int = 1_500, others: int = 3_000, rounds: int = 80) -> Tagger:
    """The tagger trained on the written examples and on all these reviewed texts (see ``learned``)."""
    kinds = kinds_of_sentences(harmless)
    first = kinds[:common] + sorted(kinds[common:], key=lambda k: (zlib.crc32(k.encode("utf-8", "surrogatepass")), k))[:others]
    known = {sentence_kind(s) for s in kinds}
    each = [own for t in toxic if (own := [s for s in offered(t) if sentence_kind(s) not in known])]

    def wrong(model: Tagger, taught: set[str], most: int) -> list[str]:
        new = [k for k in kinds if k not in taught]
        return [s for _, s in sorted((-x, s) for s, x in zip(new, model.scores(new, UNSURE).tolist()) if x > UNSURE)[:most]]

    def suspected(model: Tagger) -> list[str]:
        flagged: dict[str, None] = {}
        for own in each:
            scores = model.scores(own)
            flagged |= {sentence_kind(s): None for s, x in zip(own, scores) if x > CANDIDATE and x >= 0.3 * scores.max()}
        return sorted(flagged)

    return learned(first, wrong, suspected, rounds, bool(each))


def train_on_reviewed(documents: DataFrame, labels: DataFrame, common: int = 1_500, others: int = 3_000, rounds: int = 80) -> Tagger:
    """The tagger trained on the written examples and on all reviewed ``documents`` (line_id, text), which are read where they lie.

    ``labels`` (line_id, toxic): a text counts as harmless or toxic if all its reviewers say so. The driver gets the sentences
    that training starts with, those that the tagger is wrong about, and the kinds of those taken as offending (see ``learned``).
    """
    votes = labels.where("toxic is not null").groupBy("line_id").agg(F.min("toxic").alias("least"), F.max("toxic").alias("most"))
    sure = votes.where("least > 0 or most = 0").select("line_id", (F.col("most") == 0).alias("harmless"))
    texts = documents.where(F.col("text").rlike(r"\p{L}")).select("line_id", "text").join(sure, "line_id")

    def split(batches):
        for b in batches:
            calm: Counter = Counter()
            first: dict[str, str] = {}
            rows = []
            for line, text, harmless in zip(b.line_id, b.text, b.harmless):
                if harmless:
                    for s in (text[i:j] for i, j in sentences(text)):
                        k = sentence_kind(s)
                        calm[k] += 1
                        first[k] = min(s, first.get(k, s))
                else:
                    key = f"{line} {zlib.crc32(text.encode('utf-8', 'surrogatepass'))}"
                    rows += [(key, sentence_kind(s), s, 0) for s in offered(text)]
            rows += [(None, k, first[k], n) for k, n in calm.items()]
            yield pd.DataFrame(rows, columns=["text_key", "kind", "sentence", "n"])

    found = stage(texts.mapInPandas(split, "text_key string, kind string, sentence string, n long"), "reviewed")
    calm = stage(found.where("text_key is null").groupBy("kind").agg(F.sum("n").alias("n"), F.min("sentence").alias("sentence")), "harmless")
    toxic = stage(found.where("text_key is not null").join(calm.select("kind"), "kind", "left_anti").select("text_key", "kind", "sentence"), "toxic")

    def over(rows: DataFrame, model: Tagger, least: float, taught: frozenset = frozenset()) -> DataFrame:
        def run(batches):
            for b in batches:
                b = b[[s not in taught for s in b.sentence]]
                x = [s for part in portions(b.sentence.tolist()) for s in model.scores(part, least).tolist()]
                b = b.assign(score=np.array(x, np.float64))
                yield b[b.score > least]

        return rows.mapInPandas(run, f"{', '.join(f'{c} string' for c in rows.columns)}, score double")

    def wrong(model: Tagger, taught: set[str], most: int) -> list[str]:
        got = over(calm.select("sentence"), model, UNSURE, frozenset(taught))
        return [r.sentence for r in got.orderBy(F.desc("score"), "sentence").limit(most).collect()]

    def suspected(model: Tagger) -> list[str]:
        top = F.max("score").over(Window.partitionBy("text_key"))
        got = over(toxic, model, CANDIDATE).withColumn("top", top).where("score >= 0.3 * top").select("kind").distinct()
        return sorted(r.kind for r in got.collect())

    usual = [r.sentence for r in calm.orderBy(F.desc("n"), "kind").limit(common).collect()]
    some = [r.sentence for r in calm.orderBy(F.crc32(F.col("sentence").cast("binary")), "sentence").limit(common + others).collect()]
    first = usual + [s for s in some if s not in set(usual)][:others]
    return learned(first, wrong, suspected, rounds, not toxic.isEmpty())


def learned(first: list[str], wrong, suspected, rounds: int, toxic: bool) -> Tagger:
    """The tagger trained on the written examples and on what all sentences of reviewed texts have to teach it.

    It is trained on the written examples and the harmless sentences ``first``, and then goes on: ``wrong`` (tagger, sentences taught,
    most) reads all other harmless sentences and gives those it scores over UNSURE, the highest first, at most so many
    a turn; they join until there are none. The rest of them teach nothing, as their gradient vanishes. Reviewers call whole texts
    toxic, not sentences: in all texts called so, ``suspected`` takes the sentences of no harmless kind with a word of some class as
    offending that the tagger scores over CANDIDATE and not far under the text's worst; so twice over. Names in them
    don't count. Each weighs as much as WEIGHT written examples, as there are few.
    """
    taught = dict.fromkeys(first)
    model = train_tagger(list(taught), rounds)
    flagged: list[str] = []
    turns = 2 if toxic else 0
    while True:
        more = wrong(model, set(taught), A_TURN)
        if turns:
            flagged = suspected(model)
        elif not more:
            return model
        turns = max(turns - 1, 0)
        taught |= dict.fromkeys(more)
        model = train_tagger(list(taught), rounds // 3, flagged=flagged * WEIGHT, start=model)


def offered(text: str) -> list[str]:
    """The sentences with a word of some class that may offend."""
    own = [text[a:b] for a, b in sentences(text)]
    return [s for s in own if any(c not in ("mention", "neutral") for w in _words(s) for c in classes(w))]


#: Score from which a sentence of a text that reviewers call toxic is taken as what they mean, and how often it counts.
CANDIDATE = 0.2
WEIGHT = 3
#: Score over which a harmless sentence joins those that the tagger learns from, and how many may in a turn.
UNSURE = 0.1
A_TURN = 4_000


def sentence_kind(sentence: str) -> str:
    """A sentence without its names and numbers."""
    return re.sub(r"(?<!^)\b[A-ZА-ЯÀ-Þ][^\W\d_]+|\d+", "0", sentence.strip())


def kinds_of_sentences(texts: list[str]) -> list[str]:
    """One sentence of each kind, the commonest kinds first; names and numbers don't make a kind."""
    seen: Counter = Counter()
    first: dict[str, str] = {}
    for t in texts:
        for a, b in sentences(t):
            k = sentence_kind(t[a:b])
            seen[k] += 1
            first.setdefault(k, t[a:b])
    return [first[k] for k, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))]


def score_udf(model: Tagger, repair=None, least: float = 0.0):
    """Column function: score of a text; 0 for null and for texts without words. Only scores over ``least`` are sure to be exact."""
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        out: list[float] = []
        for part in portions(texts.fillna("").tolist()):
            out += model.scores([r.text for r in repair(part)] if repair else part, least).tolist()
        return pd.Series(out)

    return run


def spans_udf(model: Tagger, repair=None, least: float = 0.5):
    """Column function: the offending sentences (start, end, score) of a text, as places in the text as it is stored.

    Empty for null and for texts whose score isn't over ``least``.
    """

    @F.pandas_udf("array<struct<start:int,end:int,score:double>>")
    def run(texts: pd.Series) -> pd.Series:
        out: list[list[dict]] = []
        for part in portions(texts.fillna("").tolist()):
            read = repair(part) if repair else None
            plain_ = [r.text for r in read] if read else part
            for k, score in enumerate(model.scores(plain_, least)):
                place = read[k].place if read else int
                out.append([{"start": place(a), "end": place(b), "score": s} for a, b, s in model.spans(plain_[k], least)] if score > least else [])
        return pd.Series(out)

    return run


def score_texts(texts: DataFrame, model: Tagger, repair=None, least: float = 0.0) -> DataFrame:
    """``texts`` (..., text) with score; null, blank and wordless texts score 0, repeated rows stay. Only scores over ``least`` are sure to be exact."""
    return texts.withColumn("score", F.when(F.col("text").rlike(r"\p{L}"), score_udf(model, repair, least)("text")).otherwise(F.lit(0.0)))

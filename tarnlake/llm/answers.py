"""Defective answers: empty, truncated, refusing, copied from the question, or in another language.

Copies are told by compression: an answer adds hardly a byte where its prompt is the dictionary, and the prompt
hardly one where the answer is. Refusals are told by dictionaries, languages by the language model, truncation
by a model of how texts end: the mark, and the words that end and begin sentences.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.language import NAMES, LanguageModel, judge_whole
from tarnlake.llm.messages import has_content, speaker
from tarnlake.llm.textunits import WORD, portions, sentences, words
from tarnlake.operators.hierarchy import clean_id, clean_parent
from tarnlake.operators.lookup import hot_keys, lookup_join
from tarnlake.session import stage

#: First-person words of declining, and what is declined; a refusal has one of each near its beginning.
DECLINE = {
    "en": r"\bi(?: am|'m|’m)? (?:\w+ )?(?:unable|not able|not allowed|not permitted|not in a position|not comfortable)|\bi (?:can't|can’t|cannot|can not|won't|won’t|will not|must refuse|must decline|have to (?:decline|refuse|pass)|decline|refuse|would rather not|prefer not|am going to pass)|i'd rather not|i’d rather not|as an ai|(?:as a|am a) (?:large )?language model|my (?:guidelines|rules|policy|policies|instructions)|no comment|not something i|against my (?:policy|rules|guidelines)",
    "zh": r"我(?:无法|不能|没法|不便|不方便|必须拒绝|拒绝|不得|不想|不愿|只能拒绝|不可以|恐怕不能)|作为(?:一个)?(?:人工智能|AI|ai|语言模型|大模型)|超出了?我|恕(?:我)?(?:不能|无法|难)|无可奉告|不予置评|不允许我|不便(?:回答|评论|讨论)",
    "de": r"\bich (?:kann|darf|werde|möchte|will|muss)\b[^.!?]{0,60}\b(?:nicht|ablehnen|kein\w*)|\b(?:kann|darf|möchte|werde) ich\b[^.!?]{0,60}\b(?:nicht|kein\w*)|muss ich[^.!?]{0,40}ablehnen|als (?:sprachmodell|ki\b|künstliche)|kein kommentar|meine (?:richtlinien|regeln|vorgaben)",
    "fr": r"je (?:ne |n[’'])\w+ (?:\w+ )?pas|je préfère ne pas|je (?:dois|suis obligée?|suis contrainte?) (?:de |d[’'])?(?:refuser|décliner)|je (?:refuse|décline)|en tant qu[e’'] ?(?:modèle|ia|intelligence)|sans commentaire|mes (?:consignes|règles|directives)|aucun commentaire",
    "es": r"\bno (?:puedo|podré|estoy autorizad|me es posible|voy a|quiero)|no se me permite|prefiero no|(?:debo|tengo que) (?:rechazar|negarme|declinar)|me niego|como (?:modelo|ia\b|inteligencia)|sin comentarios|mis (?:directrices|normas|reglas|pautas)",
    "ru": r"не (?:могу|имею права|вправе|буду|стану|хочу|готов)|предпоч[её]л[аи]? бы не|предпочитаю не|(?:вынужден|должен|придётся)\w* (?:отказ|отклон)|отказываюсь|как (?:языковая модель|ии\b|искусственный)|без комментариев|мои (?:правила|инструкции)",
}
DECLINED = {
    "en": r"help|assist|answer|discuss|respond|repl|request|question|topic|provide|write|talk|content|subject|this|that|ask (?:some|any)",
    "zh": r"回答|请求|要求|问题|内容|帮|讨论|话题|咨询|谈|评论|提供|写|方面|协助",
    "de": r"helfen|beantwort|äußern|anfrage|frage|thema|wunsch|schreib|antwort|inhalt|unterstütz|dazu|darüber",
    "fr": r"répondre|aider|demande|sujet|question|exprimer|traiter|adress|écrire|parler|discuter|là-dessus|contenu",
    "es": r"ayudar|responder|petición|solicitud|tema|pregunta|opinar|escribir|hablar|contestar|esto|contenido",
    "ru": r"помо|отвеча|ответ|запрос|вопрос|тем[уые]|высказ|спросите|просьб|писать|обсужд|говорить|этого",
}
_DECLINE = re.compile("|".join(DECLINE.values()), re.I)
_DECLINED = re.compile("|".join(DECLINED.values()), re.I)


def _all_of(item, most: int = 200) -> set[str] | None:
    """Everything that a parsed item of a pattern (or a list of them) matches, None where that is no short list."""
    if not isinstance(item, tuple):
        out = {""}
        for x in item:
            own = _all_of(x, most)
            if own is None or len(out) * len(own) > most:
                return None
            out = {a + b for a in out for b in own}
        return out
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "AT":
        return {""}
    if op == "IN" and all(str(x) == "LITERAL" for x, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if op == "SUBPATTERN":
        return _all_of(arg[3], most)
    if op == "BRANCH":
        every = [_all_of(x, most) for x in arg[1]]
        return None if None in every else set().union(*every)
    if op == "MAX_REPEAT" and arg[1] == 1 and (own := _all_of(arg[2], most)) is not None:
        return own if arg[0] else own | {""}
    return None


def anchors(items) -> set[str]:
    """Strings in small letters of which every match of the parsed pattern ``items`` holds one; of several such sets that with the longest."""
    best, run = {""}, {""}

    def better(a: set[str], b: set[str]) -> set[str]:
        return a if min(map(len, a)) >= min(map(len, b)) else b

    for item in items:
        own = _all_of(item)
        if own is not None and len(run) * len(own) <= 200:
            run = {a + b for a in run for b in own}
            continue
        best, run = better(best, run), {""}
        op, arg = str(item[0]), item[1]
        if op == "BRANCH":
            best = better(best, set().union(*map(anchors, arg[1])))
        elif op == "SUBPATTERN":
            best = better(best, anchors(arg[3]))
        elif own is not None:
            run = own
    return better(best, run)


class Anchored:
    """A pattern of any case, searched only in texts that hold one of the strings without which it can't match."""

    def __init__(self, pattern: str):
        self.pattern, self.automaton = re.compile(pattern, re.I), ahocorasick.Automaton()
        for a in anchors(re._parser.parse(pattern)):
            self.automaton.add_word(a, a)
        self.automaton.make_automaton()
        own = set("".join(self.automaton))
        #: Characters that the pattern takes for its own, but that have other small letters.
        odd = "".join(c for c in map(chr, range(0x80, 1 << 16)) if c.lower() not in own)
        self.odd = re.compile("[" + "".join(re.findall("[" + re.escape("".join(sorted(own))) + "]", odd, re.I)) + "\uffff]")

    def search(self, text: str) -> re.Match | None:
        if next(self.automaton.iter(text.lower()), None) is None and (text.isascii() or not self.odd.search(text)):
            return None
        return self.pattern.search(text)


_DECLINES = Anchored("|".join(DECLINE.values()))
#: Requests for a translation.
TRANSLATE = re.compile(r"translat|übersetz|tradui|traduc|traduz|перевед|перевод|перевести|翻译|翻譯|译成|译为|in die sprache|dans la langue|al idioma|на язык", re.I)
_NAMED = {k: re.compile("|".join(rf"\b{re.escape(n)}" if n.isascii() or n[0] < "㐀" else re.escape(n) for n in names if len(n) > 3 or n[0] >= "㐀"), re.I) for k, names in NAMES.items()}
#: What may follow a sentence without taking its end away: closing quotes and brackets, marks of feeling.
_TAIL = re.compile(r"[\s\"'”’»›」』）)\]*_~`\U0001f000-\U0001faff☀-➿️🙏]+$|\s[:;]-?[()DPp]\s*$")
_ENDS = re.compile(r"[.!?。！？…]$")
_FACE = re.compile(r"[:;]-?[()DPp]")
_LIST = re.compile(r"^\s*(?:[-*•·–+>|]|\(?\d{1,3}[.)、:]|[a-zA-Z][.)])\s*\S")
_CODE = re.compile(r"```|^\s{4,}\S|[{};]\s*$|^\s*(?:\$|>>>|def |class |import |return |for |if |SELECT |select |<\w+)|^\W*[\w./-]+\(.*\)\W*$|=>|==|\w=\w", re.M)
_SPACE = re.compile(r"[\W_]+")
#: Sentences in which an answer declines, if it does; words behind them that make an answer of their own.
OPENING, OWN_ANSWER = 3, 40


def flat(text: str) -> bytes:
    return _SPACE.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def novelty(text: bytes, known: bytes) -> int:
    """Bytes that ``text`` adds to ``known``: its compressed size with that as dictionary, less that of saying nothing new."""
    d = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters.from_level(3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False, window_log=max(10, (len(text) + len(known)).bit_length() + 1))
    c = zstandard.ZstdCompressor(dict_data=d, compression_params=p)
    return max(0, len(c.compress(text)) - len(c.compress(known)))


def is_copy(question: str, answer: str) -> bool:
    """Only the question again: no more than a few words are new, and hardly any of the question is missing."""
    q, a = flat(question), flat(answer)
    if not q or not a:
        return False
    if q == a:
        return True
    if not 0.7 * len(q) <= len(a):
        return False
    if len(q) < 8:  # zstandard finds no match in so short a dictionary: said again word for word, any number of times
        return a.replace(q, b"").strip() == b""
    return novelty(a, q) <= 14 + 0.04 * len(a) and novelty(q, a) <= 4 + 0.12 * len(q)


def is_refusal(answer: str) -> bool:
    """Declining in the first person, in one of the first sentences, to do what was asked, and not doing it afterwards.

    Sentences behind the opening that speak of declining or of what was asked belong to the refusal, however many there
    are; it is none if those that don't are the greater part of what follows and make up an answer of their own.
    """
    if not _DECLINES.search(answer) or not _DECLINED.search(answer):
        return False
    parts = [answer[a:b] for a, b in sentences(answer)]
    opening = " ".join(parts[:OPENING])
    if not _DECLINE.search(opening):
        return False
    rest = parts[OPENING:]
    other = [p for p in rest if not _DECLINE.search(p) and not _DECLINED.search(p)]
    said = sum(len(WORD.findall(p)) for p in other)
    return said < OWN_ANSWER or 2 * len(other) <= len(rest)


class EndingModel:
    """Log-odds that words end and begin sentences, from texts whose sentences are marked (``ending_odds``); scores endings without a mark."""

    def __init__(self, ends: dict[str, float], begins: dict[str, float], unknown: float):
        self.ends, self.begins, self.unknown = ends, begins, unknown

    #: Log-odds of breaking off that a long line, or one behind marked sentences, has for lack of a mark at its end.
    UNMARKED = 6.0
    #: Log-odds that a word without any begins and ends a sentence; what the sum must exceed.
    NO_BEGIN, NO_END, LIMIT = -1.0, -0.2, 1.0

    def breaks_off(self, line: str, bare: bool) -> bool:
        """Whether an unmarked line looks like the beginning of a sentence rather than a whole one or a bare term.

        ``bare``: it is short and all there is, so that the missing mark says nothing.
        """
        w = WORD.findall(line.lower())
        if not w:
            return False
        return self.begins.get(w[0], self.NO_BEGIN) - self.ends.get(w[-1], self.unknown) + (0.0 if bare else self.UNMARKED) > self.LIMIT


def ending_odds(texts: DataFrame, least: int = 5) -> DataFrame:
    """(word, begins, ends): the log-odds of ``EndingModel`` of every word that stands ``least`` times in sentences of over four words.

    All ``texts`` (text) are counted where they lie; the table stays distributed, however many words there are.
    """

    def count(batches):
        last, first, all_ = Counter(), Counter(), Counter()

        def counted():
            return pd.DataFrame({"word": list(all_), "last": [last[w] for w in all_], "first": [first[w] for w in all_], "n": list(all_.values())})

        for b in batches:
            for t in b.text:
                for s in re.split(r"[.!?。！？\n]+", t):
                    w = words(s.lower())
                    if len(w) > 4:
                        last[w[-1]] += 1
                        first[w[0]] += 1
                        all_.update(w)
            if len(all_) > 200_000:
                yield counted()
                for c in (last, first, all_):
                    c.clear()
        if all_:
            yield counted()

    got = texts.select("text").mapInPandas(count, "word string, last long, first long, n long").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("last", "first", "n")])
    got = stage(got, "words")
    sums = got.agg(F.sum("last").alias("last"), F.sum("n").alias("n")).first()
    chance = F.col("n") * (max(1, sums["last"] or 0) / max(1, sums["n"] or 0)) + 1
    return got.where(F.col("n") >= least).select("word", *[F.log((F.col(c) + 1) / chance).alias(name) for c, name in (("first", "begins"), ("last", "ends"))])


def is_truncated(answer: str, model: EndingModel) -> bool:
    """It ends inside a sentence. Lists, bare terms, numbers and code may end without a stop."""
    open_ = unmarked(answer)
    return open_ is not None and model.breaks_off(*open_)


def unmarked(answer: str) -> tuple[str, bool] | None:
    """The last line of an answer that may end inside a sentence, and whether it is bare (see ``EndingModel.breaks_off``); None if it can't."""
    t = answer.rstrip()
    while (m := _TAIL.search(t)) and m.start() < len(t):
        inner = t[: m.start()].rstrip()
        if not inner:
            break
        closed = t[m.start() :].strip()
        t = inner
        if _FACE.fullmatch(closed):
            continue
        if closed and not _ENDS.search(t) and any(c in "\"”’»」』）)]" for c in closed):
            return None  # a closed quotation or bracket ends the text
    if _ENDS.search(t) or not re.search(r"[^\W_]", t):
        return None
    lines = t.split("\n")
    last = lines[-1].strip()
    if _LIST.match(last) or t.count("```") % 2 or _CODE.search(t[t.rfind("\n\n") + 1 :]):
        return None  # a list, or code in the last paragraph or an open block of it
    if re.fullmatch(r"[\d\s.,:%€$£+/*=()-]+\w{0,3}", last):
        return None
    words = WORD.findall(last)
    han = sum(1 for w in words if w >= "㐀" and len(w) == 1)
    alone = len([x for x in lines if x.strip()]) == 1 and not re.search(r"[.!?。！？，,;；]", last)
    bare = alone and last[-1:] not in ",，、;-" and len(words) - han <= 5 and han <= 8
    if bare and han and han == len(words) and han <= 6:
        return None  # a Chinese term
    return last, bare


def judge_answers(questions: list[str], answers: list[str], languages: LanguageModel) -> list[tuple[str | None, str | None, str | None, bool]]:
    """The defect of each answer that has content, or None; of one without that may be truncated, the first and the last word
    of its last line, and whether that is bare."""
    each = list(dict.fromkeys([*questions, *answers]))
    langs = dict(zip(each, judge_whole(languages, each)))
    out: list[tuple[str | None, str | None, str | None, bool]] = []
    for q, a in zip(questions, answers):
        if is_copy(q, a):
            out.append(("copy", None, None, False))
        elif is_refusal(a):
            out.append(("refusal", None, None, False))
        elif _other_language(q, a, langs[q], langs[a]):
            out.append(("other_language", None, None, False))
        elif (open_ := unmarked(a)) and (w := WORD.findall(open_[0].lower())):
            out.append((None, w[0], w[-1], open_[1]))
        else:
            out.append((None, None, None, False))
    return out


def _other_language(question: str, answer: str, of_q: tuple | None, of_a: tuple | None) -> bool:
    if not of_q or not of_a or of_q[0] == of_a[0] or "```" in answer:
        return False
    if TRANSLATE.search(question) or _NAMED[of_a[0]].search(question):
        return False
    words = WORD.findall(answer)
    han = sum(1 for w in words if len(w) == 1 and w >= "㐀")
    scripts = {of_q[0], of_a[0]} & {"zh", "ru"}
    least = 2 if scripts else 4
    return of_a[1] >= 0.6 and of_q[1] >= 0.6 and len(words) - han / 2 >= least


def defects_udf(languages: LanguageModel):
    """Column function: (defect, first, last, bare) of an answer with content, as ``judge_answers`` says, from (question, answer)."""
    @F.pandas_udf("defect string, first string, last string, bare boolean")
    def run(questions: pd.Series, answers: pd.Series) -> pd.DataFrame:
        qs, out, at = questions.tolist(), [], 0
        for part in portions(answers.tolist(), 100_000):
            out += judge_answers(qs[at : at + len(part)], part, languages)
            at += len(part)
        return pd.DataFrame(out, columns=["defect", "first", "last", "bare"])

    return run


def answer_pairs(messages: DataFrame) -> DataFrame:
    """(line_id, question, answer, answered): every assistant row whose parent row is a user message with content.

    Of repeated rows of a line the latest counts. Answers to one question may be any number: where that hot
    question's rows would gather in one task, the question travels to them instead.
    """
    key = F.struct("added_date", F.coalesce("content", F.lit("")))
    rows = messages.select(clean_id(F.col("line_id")).alias("line_id"), clean_parent(F.col("frontID")).alias("front"), speaker(F.col("role")).alias("who"), "content", "added_date").where("line_id is not null")
    rows = stage(rows.groupBy("line_id").agg(F.max_by(F.struct("front", "who", "content"), key).alias("r")).select("line_id", "r.*"), "messages")
    asked = rows.where((F.col("who") == "user") & has_content(F.col("content"))).select(F.col("line_id").alias("asked"), F.col("content").alias("question"))
    answers = rows.where("who = 'assistant' and front is not null")
    hot = hot_keys(answers.groupBy("front").agg(F.count("*").alias("n")), "front", "n", answers.count())
    pairs = lookup_join(answers, asked, F.col("front") == F.col("asked"), "front", "asked", hot, "inner")
    return pairs.select("line_id", "question", F.col("content").alias("answer"), has_content(F.col("content")).alias("answered"))


def defective_answers(messages: DataFrame, languages: LanguageModel) -> DataFrame:
    """(line_id, defect) of every defective answer of ``messages`` (line_id, role, content, frontID, added_date).

    defect: empty, copy, refusal, other_language or truncated, the first that holds. The odds of endings are
    counted over all answers; those that may be truncated look up their words in them. Empty input gives no rows.
    """
    pairs = stage(answer_pairs(messages), "pairs")
    empty = pairs.where("not answered").select("line_id", F.lit("empty").alias("defect"))
    told = pairs.where("answered").select("line_id", defects_udf(languages)("question", "answer").alias("r")).select("line_id", "r.*")
    told = stage(told.where("defect is not null or first is not null"), "told")
    odds = ending_odds(pairs.where("answered").select(F.col("answer").alias("text")))
    open_ = told.where("defect is null").join(odds.select(F.col("word").alias("first"), "begins"), "first", "left").join(odds.select(F.col("word").alias("last"), "ends"), "last", "left")
    sum_ = F.coalesce("begins", F.lit(EndingModel.NO_BEGIN)) - F.coalesce("ends", F.lit(EndingModel.NO_END)) + F.when(F.col("bare"), 0.0).otherwise(EndingModel.UNMARKED)
    cut = open_.where(sum_ > EndingModel.LIMIT).select("line_id", F.lit("truncated").alias("defect"))
    return empty.unionByName(told.where("defect is not null").select("line_id", "defect")).unionByName(cut)

"""Texts decoded with the wrong character encoding: found and restored.

A smoothed bigram model of characters is counted over the clean records. In a suspect place every chain
"encode as it was wrongly read, decode as it was written" is tried; the likeliest result is taken if it
beats the text as it stands by more than a margin validated on clean records.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cached_property, lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.textunits import portions
from tarnlake.session import stage

DIM, SINGLES = 1 << 20, 1 << 16
LOST = "�"
#: Log-probability of a bigram: the least it counts, and that of one with a lost character.
FLOOR, LOSS = -18.0, -12.0
#: By how much in all the bigrams of a stretch must be below the marks of their scripts.
SUSPECT = 3.0
#: By how much the margin is above what clean records gain.
ABOVE = 0.25
#: How a text may have been read wrongly, and how it may have been written.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp866", "koi8-r", "iso8859-5", "mac_cyrillic", "cp1250", "iso8859-15", "gb18030", "big5", "cp932", "euc_kr")
WRITTEN_AS = ("utf-8", "cp1252", "gbk", "big5", "cp1251", "koi8-r", "cp866", "iso8859-5", "mac_roman", "mac_cyrillic", "cp437", "cp850", "cp932")
#: Readings of two bytes a character, and writings that are credible behind them.
WIDE, BEHIND_WIDE = ("gb18030", "big5", "cp932", "euc_kr"), ("utf-8", "gbk", "big5", "cp932", "cp1251", "koi8-r")
#: Writings whose validity is evidence.
MULTI = ("utf-8", "gbk", "big5", "cp932")
#: Signs of damage that no clean record holds: the replacement character, C1 controls, private use.
DAMAGE = re.compile("[�\x80-\x84\x86-\x9f-]")
_NEVER = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f-\x84\x86-\x9f-]")
#: Stretches of wide characters, or of others; lost ones belong to either.
_WIDE_CHARS = "\u3000-\u9fff\ue000-\uf8ff\ufe30-\ufe6f\uff00-\uffef"
_KIND = re.compile(f"[{_WIDE_CHARS}{LOST}]+[ -~]?|[^{_WIDE_CHARS}]+")

#: Characters lost for good: the replacement character, the same read as a two-byte set, private use among Han characters.
_GONE = re.compile(f"{LOST}|{(LOST * 2).encode().decode('gb18030')}|[一-鿿][\ue000-\uf8ff][一-鿿]")
_RUN = re.compile("[ -~]?[^\x00-\x7f]+[ -~]?")
#: What a reading other than of UTF-8 needs as support: three characters beyond ASCII, or one beside a letter.
_SUPPORTED = re.compile("(?:[^\x00-\x7f].*?){3}|[a-zA-Z][^\x00-\x7f]|[^\x00-\x7f][a-zA-Z]", re.S)


def _utf8_as(two: tuple[str, ...], three: tuple[str, ...]) -> re.Pattern:
    """What UTF-8 sequences of two (three) bytes look like when read as one of ``two`` (``three``)."""

    def cls(enc: str, a: int, b: int) -> str:
        return "[" + re.escape("".join(bytes([x]).decode(enc, "ignore") or chr(x) for x in range(a, b))) + "]"

    pairs_ = [cls(e, 0xC2, 0xE0) + cls(e, 0x80, 0xC0) for e in two]
    triples = [cls(e, 0xE0, 0xF0) + cls(e, 0x80, 0xC0) * 2 for e in three]
    return re.compile("(?:(?:" + "|".join(pairs_ + triples) + ")[ ]?)+")


_TWO, _THREE = ("cp1252", "latin-1", "mac_roman", "cp437", "cp1251", "cp866"), ("cp1252", "latin-1", "mac_roman", "cp437")
UTF8_LOOK = _utf8_as(_TWO, _THREE)
_HAN = re.compile("[一-鿿]{6,}")

#: ASCII characters count by class only: small and capital letter, digit, white space, other.
_CLASS = np.array([97 if chr(i).islower() else 65 if chr(i).isupper() else 48 if chr(i).isdigit() else 32 if chr(i).isspace() else 46 for i in range(128)], np.uint32)
#: Script of a character: 0 ASCII, 1 punctuation and signs, 2 Latin, 3 Greek and Cyrillic, 4 Han, 5 other.
_SCRIPT = np.full(1 << 16, 5, np.uint8)
for _a, _b, _s in ((0, 0x80, 0), (0xA0, 0xC0, 1), (0xC0, 0x250, 2), (0x370, 0x530, 3), (0x2010, 0x2070, 1), (0x20A0, 0x2200, 1), (0x2200, 0x2300, 1), (0x3000, 0x3020, 1), (0x4E00, 0xA000, 4), (0xFF00, 0xFF65, 1)):
    _SCRIPT[_a:_b] = _s


def _utf8_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each character: the encodings (as bits) under which it is the first, or a later, byte of a UTF-8 sequence of two (three)."""
    out = [np.zeros(1 << 16, np.uint16) for _ in range(4)]
    for (lead, later), encs, a, b in ((out[:2], _TWO, 0xC2, 0xE0), (out[2:], _THREE, 0xE0, 0xF0)):
        for bit, e in enumerate(encs):
            for x in range(0x80, 0x100):
                c = ord(bytes([x]).decode(e, "ignore") or chr(x))
                if a <= x < b:
                    lead[c] |= 1 << bit
                if x < 0xC0:
                    later[c] |= 1 << bit
    return tuple(out)


_LEAD2, _LATER2, _LEAD3, _LATER3 = _utf8_tables()
_DAMAGED = np.array([bool(DAMAGE.match(chr(c))) for c in range(1 << 16)])
#: Characters without which ``_GONE`` can't match.
_MAYBE_GONE = np.zeros(1 << 16, bool)
_MAYBE_GONE[[0xFFFD, ord((LOST * 2).encode().decode("gb18030")[0])]] = True
_MAYBE_GONE[0xE000:0xF900] = True
#: The two bytes of each Han character in the GB sets, 0 for those with four.
_GB = np.zeros((0xA000 - 0x4E00, 2), np.uint8)
for _c in range(0x4E00, 0xA000):
    _b = chr(_c).encode("gb18030")
    if len(_b) == 2:
        _GB[_c - 0x4E00] = list(_b)


class Laid:
    """Texts side by side as code points, a line end before, between and behind them, and their bigrams beyond ASCII."""

    def __init__(self, texts: list[str]):
        self._lay(np.frombuffer("\n".join(["", *texts, "", ""]).encode("utf-32-le", "surrogatepass"), np.uint32), np.fromiter(map(len, texts), np.int64, len(texts)))

    @classmethod
    def of(cls, lines: str) -> Laid:
        """The lines of a text, at least one."""
        c = np.frombuffer(f"\n{lines}\n\n".encode("utf-32-le", "surrogatepass"), np.uint32)
        out = cls.__new__(cls)
        out._lay(c, np.diff(np.flatnonzero(c == 10))[:-1] - 1)
        return out

    def only(self, some: np.ndarray) -> Laid:
        """Those of the texts that ``some`` is true for."""
        out = Laid.__new__(Laid)
        out._lay(self.c[np.concatenate([[True], np.repeat(some, self.sizes + 1), [True]])], self.sizes[some])
        return out

    def _lay(self, c: np.ndarray, sizes: np.ndarray) -> None:
        self.c, self.sizes = c, sizes
        self.first = np.cumsum(self.sizes + 1) - self.sizes  # place of each text's first character
        high = self.c > 127
        #: Places of the bigrams that touch a character beyond ASCII; only these are counted and scored.
        self.at = np.flatnonzero(high[:-1] | high[1:])

    @cached_property
    def high(self) -> np.ndarray:
        """Places of the characters beyond ASCII."""
        return np.flatnonzero(self.c > 127)

    @cached_property
    def low16(self) -> np.ndarray:
        return np.minimum(self.c[self.high], 0xFFFF)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The text that each place lies in; the line end before a text belongs to it."""
        return np.searchsorted(self.first - 1, places, "right") - 1

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each place in ``at``: hash of the bigram, hash of its second character, whether a character is lost."""
        x, y = self.c[self.at], self.c[self.at + 1]
        lost = (x == 0xFFFD) | (y == 0xFFFD)
        for c in (x, y):
            low = np.flatnonzero(c < 128)
            c[low] = _CLASS[c[low]]
        two = ((x * np.uint32(0x9E3779B1) + y * np.uint32(0x85EBCA77)) >> np.uint32(7)) & np.uint32(DIM - 1)  # of 32 bits, as DIM takes the lower 27
        return two.astype(np.int64), second_hash(y), lost

    def scripts(self) -> np.ndarray:
        """Script of the bigram at each place in ``at``."""
        x, y = self.c[self.at], self.c[self.at + 1]
        return np.maximum(_SCRIPT[np.minimum(x, 0xFFFF)], _SCRIPT[np.minimum(y, 0xFFFF)])

    def runs(self, text: str) -> tuple[list[str], np.ndarray]:
        """What ``_RUN`` finds in the texts, and the place of each; ``text``: the texts with a line end before and between."""
        if not len(self.high):
            return [], self.high
        new = np.flatnonzero(np.diff(self.high) != 1)
        a, b = self.high[np.append(0, new + 1)], self.high[np.append(new, len(self.high) - 1)] + 1
        shown = lambda c: (c >= 32) & (c < 127)
        free = np.append(True, b[:-1] != a[1:] - 1)  # else the character before belongs to the run before
        a, b = a - (shown(self.c[a - 1]) & free), b + shown(self.c[b])
        return [text[i:j] for i, j in zip(a.tolist(), b.tolist())], a

    def looks(self) -> np.ndarray:
        """Numbers of the texts that hold what ``UTF8_LOOK`` finds."""
        a, b, c = self.low16, np.minimum(self.c[self.high + 1], 0xFFFF), np.minimum(self.c[self.high + 2], 0xFFFF)
        hit = (_LEAD2[a] & _LATER2[b]) | (_LEAD3[a] & _LATER3[b] & _LATER3[c])
        return np.unique(self.owner(self.high[hit > 0]))

    def clean(self) -> np.ndarray:
        """Which texts show no sign of damage, nor a run of characters that is valid UTF-8 read as another encoding."""
        out = np.ones(len(self.sizes), bool)
        out[self.looks()] = False
        out[self.owner(self.high[_DAMAGED[self.low16]])] = False
        han = (self.low16 >= 0x4E00) & (self.low16 < 0xA000)
        at = self.high[han]
        if len(at):
            gb = _GB[self.low16[han] - 0x4E00]
            run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])  # number of the run of Han characters
            n = np.bincount(run)
            b, r = gb.ravel(), np.repeat(run, 2)
            later = (b >= 0x80) & (b < 0xC0)
            two, three = np.zeros(len(b), bool), np.zeros(len(b), bool)
            two[:-1] = (b[:-1] >= 0xC2) & (b[:-1] < 0xE0) & later[1:] & (r[:-1] == r[1:])
            three[:-2] = (b[:-2] >= 0xE0) & (b[:-2] < 0xF0) & later[1:-1] & later[2:] & (r[:-2] == r[2:])
            valid = 2 * np.bincount(r[two], minlength=len(n)) + 3 * np.bincount(r[three], minlength=len(n))
            bad = (n >= 6) & (valid > 1.7 * n)  # of 2 * n bytes
            out[self.owner(at[bad[run]])] = False
        return out


def second_hash(c: np.ndarray) -> np.ndarray:
    return (((c.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(5)) & np.uint32(SINGLES - 1)).astype(np.int64)


class Counts:
    """Bigrams beyond ASCII and their second characters, counted by hash over the clean ones of the texts given."""

    def __init__(self):
        self.two, self.one = np.zeros(DIM, np.int64), np.zeros(SINGLES, np.int64)
        self.kind = np.zeros(DIM, np.int32)  # the greatest of script * SINGLES + hash of the second character

    def add(self, texts: list[str]) -> Counts:
        laid = Laid(texts)
        (k, g, _), script = laid.bigrams(), laid.scripts()
        on = laid.clean()[laid.owner(laid.at)] if len(texts) else np.zeros(0, bool)
        k, g, script = k[on], g[on], script[on]
        np.add.at(self.two, k, 1)  # few of DIM
        self.one += np.bincount(g, minlength=SINGLES)
        np.maximum.at(self.kind, k, script.astype(np.int32) * SINGLES + g.astype(np.int32))
        return self


class Restored(NamedTuple):
    """A restored text, the chains used, the greatest gain, and of each round the (start, end, new length) of what it replaced."""

    text: str
    chains: list[str]
    gain: float
    edits: list[list[tuple[int, int, int]]]

    def place(self, at: int) -> int:
        """The place in the stored text of a place in the restored one; inside a replaced stretch, in proportion."""
        for edits in reversed(self.edits):
            grown = 0  # of the round's result over its input, before the stretch
            for a, b, n in edits:
                if at < a + grown:
                    break
                if at < a + grown + n:
                    at, grown = a + (at - a - grown) * (b - a) // max(n, 1), 0
                    break
                grown += n - (b - a)
            at -= grown
        return at


class CharModel:
    """Smoothed log-probabilities of character bigrams beyond ASCII, and the margin a restoration must win by.

    What a bigram of each script stays above in all but ``share`` of the clean text that was counted is the mark below
    which a place is suspect; scripts with less than 500 bigrams keep a mark that suspects nearly nothing.
    """

    def __init__(self, counts: Counts, margin: float = 1.5, least: float = 8.0, much: float = 28.0, share: float = 0.02):
        n = max(float(counts.two.sum()), 1.0)
        self.logs = np.log((counts.two + 0.02) / (n + 1000.0)).astype(np.float32)
        self.alone = np.log((counts.one + 0.02) / (n + 1000.0)).astype(np.float32)
        self.margin, self.least, self.much = margin, least, much
        self._forget()
        self.weak = np.full(6, -13.0, np.float32)
        self.weak[5] = 0.0
        seen = np.flatnonzero(counts.two)
        s = self._of(seen, counts.kind[seen] % SINGLES)
        script, often = counts.kind[seen] // SINGLES, counts.two[seen]
        order = np.argsort(s, kind="stable")
        for k in (1, 2, 3, 4):
            own = order[script[order] == k]
            upto = np.cumsum(often[own])
            if len(own) and upto[-1] > 500:
                self.weak[k] = s[own[np.searchsorted(upto, share * upto[-1])]]

    def _forget(self) -> None:
        self._usual: set[str] = set()
        self._unusual: set[str] = set()
        self._known: dict[str, tuple[str, tuple | None, float]] = {}
        self._least = np.maximum(self.alone - np.float32(8.0), np.float32(FLOOR))  # of a bigram, by its second character

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _of(self, k: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.maximum(self.logs[k], self._least[g])

    def scores(self, laid: Laid) -> np.ndarray:
        """Log-probability of the bigrams at ``laid.at``."""
        k, g, lost = laid.bigrams()
        s = self._of(k, g)
        s[lost] = LOSS
        return s

    def record_gains(self, texts: list[str], known: dict[str, float] | None = None) -> np.ndarray:
        """Of each clean one of ``texts``: what any chain gains anywhere in it, 0 where that can't raise the margin.

        ``known`` keeps what short stretches gain from one call to the next.
        """
        known = {} if known is None else known
        if len(known) > 200_000:
            known.clear()
        floor = self.margin - ABOVE
        laid = Laid(texts)
        clean = laid.clean() if texts else np.zeros(0, bool)
        runs, places = laid.runs("\n".join(["", *texts]))
        owner = laid.owner(places)
        if not clean.all():
            runs, owner = [r for r, ok in zip(runs, clean[owner].tolist()) if ok], owner[clean[owner]]
        new = [r for r in dict.fromkeys(runs) if r not in known]
        gain = dict.fromkeys(new, 0.0)
        for r in self._may_gain(new, floor):
            g = self.best(r)[2]
            gain[r] = g if g > floor else 0.0
        out = np.zeros(len(texts))
        np.maximum.at(out, owner, [gain[r] if r in gain else known[r] for r in runs])
        known.update((r, g) for r, g in gain.items() if len(r) <= 64)  # longer ones hardly come again
        return out[clean]

    def _may_gain(self, runs: list[str], floor: float) -> list[str]:
        """Those of ``runs`` that a chain may gain more than ``floor`` in: all results of a chain are read and scored together."""
        if not runs:
            return []
        whole = Laid(runs)
        own, out, size = self._sums(whole), np.zeros(len(runs), bool), whole.sizes
        held = np.bitwise_and.reduceat(_HELD[np.minimum(whole.c[1:-1], 0xFFFF)], whole.first - 1)
        for r in READ_AS:
            if r in WIDE:
                raw = [to_bytes(x, r) for x in runs]
                numbers, joined = np.flatnonzero([b is not None for b in raw]), b"\n".join([b for b in raw if b is not None])
            else:
                numbers = np.flatnonzero(held & (1 << READ_AS.index(r)))
                joined = to_bytes("\n".join([runs[k] for k in numbers.tolist()]), r)
            if not len(numbers):
                continue
            if LOST.encode() in joined:
                out[numbers[[LOST.encode() in b for b in joined.split(b"\n")]]] = True
            for w in BEHIND_WIDE if r in WIDE else WRITTEN_AS:
                laid = Laid.of(joined.decode(w, "replace"))
                lost = np.add.reduceat(laid.c == 0xFFFD, laid.first, dtype=np.int64)
                if w == "utf-8":
                    out[numbers[lost == 0]] = True  # valid UTF-8
                few = lost <= 0.3 * laid.sizes + 1
                if not few.any():
                    continue
                at, lost = numbers[few], lost[few]
                g = self.gains((own[0][at], own[1][at]), self._sums(laid if few.all() else laid.only(few)))
                bonus = np.where(lost > 0, -0.5, 0.0) if r in WIDE else 0.0
                may = (g > 0) & (g + (-3.0 if r in WIDE and w not in MULTI else bonus) > floor)
                if w not in MULTI:
                    may &= g * np.minimum(size[at], own[1][at]) >= self.much
                out[at[may]] = True
        return [runs[k] for k in np.flatnonzero(out)]

    def suspects(self, texts: list[str], laid: Laid | None = None) -> dict[int, list[tuple[int, int]]]:
        """By number of text: stretches whose bigrams are together too unlikely for their script, or that look like UTF-8 read wrongly."""
        laid = laid or Laid(texts)
        if not len(laid.at):
            return {}
        spots = self._weak_spots(laid, texts)
        for k in laid.looks().tolist():
            like_utf8 = [_widen(texts[k], *m.span()) for m in UTF8_LOOK.finditer(texts[k])]
            merged: list[list[int]] = []
            for a, b in sorted([*spots.get(k, ()), *like_utf8]):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            spots[k] = [tuple(x) for x in merged]
        # a stretch of two kinds of script is two stretches: no reading mixes them
        parts = {k: [m.span() for a, b in ss for m in _KIND.finditer(texts[k], a, b) if not m.group().isascii()] for k, ss in spots.items()}
        return {k: ss for k, ss in parts.items() if ss}

    def _weak_spots(self, laid: Laid, texts: list[str]) -> dict[int, list[tuple[int, int]]]:
        s, script = self.scores(laid), laid.scripts()
        at, own = laid.at, laid.owner(laid.at)
        inside = at >= laid.first[own]  # not the line end before a text
        gain = np.where(inside, np.minimum(self.weak[script] - s, 6.0), -0.3).astype(np.float64)
        upto = np.cumsum(gain + 0.3) - 0.3 * (at + 1)  # all other bigrams count -0.3
        hot = np.flatnonzero(gain > 0)
        if not len(hot):
            return {}
        place, g, after, owner = at[hot], gain[hot], upto[hot], own[hot]
        # a run of weak bigrams joins others over up to 12 bigrams in between whose sum they outweigh
        new = np.concatenate([[True], (place[1:] - place[:-1] > 13) | (owner[1:] != owner[:-1])])
        begin = np.flatnonzero(new)
        heavy = np.add.reduceat(g, begin) >= SUSPECT
        end = np.append(begin[1:], len(hot))
        spots: dict[int, list[tuple[int, int]]] = {}
        for lo, hi in zip(begin[heavy].tolist(), end[heavy].tolist()):
            runs: list[list] = []
            for i, x, u in zip(place[lo:hi].tolist(), g[lo:hi].tolist(), after[lo:hi].tolist()):
                if runs and u - x - runs[-1][3] > -runs[-1][2]:
                    last = runs[-1]
                    last[1], last[2], last[3] = i + 1, last[2] + u - last[3], u
                else:
                    runs.append([i, i + 1, x, u])
            k, first = int(owner[lo]), int(laid.first[owner[lo]])
            found = [_widen(texts[k], a - first, min(b + 1 - first, len(texts[k]))) for a, b, x, _ in runs if x >= SUSPECT]
            if found:
                spots.setdefault(k, []).extend(found)
        return spots

    def strange(self, got: str, share: float = 0.2) -> bool:
        """Over ``share`` of the distinct characters are (nearly) unknown to clean text: no reading to score."""
        kinds = set(got)
        new = kinds.difference(self._usual, self._unusual)
        if new:
            rare = self.alone[second_hash(np.array([ord(x) for x in new], np.uint64))] < FLOOR
            for x, r in zip(new, rare):
                (self._unusual if r and ord(x) > 127 and x != LOST else self._usual).add(x)
        return len(kinds & self._unusual) > share * len(kinds)

    def readings(self, text: str) -> list[tuple[str, tuple, float]]:
        """Every chain's result for ``text``, the chain, and a bonus for valid UTF-8, which chance hardly makes."""
        seen, tried, out = {text}, set(), []
        kinds = set(text)
        for r in READ_AS:
            if r not in WIDE and not kinds <= _held(r):
                continue
            b = to_bytes(text, r)
            if b is None or (b, r in WIDE) in tried:
                continue  # the same bytes have the same readings
            tried.add((b, r in WIDE))
            for w in BEHIND_WIDE if r in WIDE else WRITTEN_AS:
                got, whole = from_bytes(b, w, LOST in text)
                if got in seen or (not whole and got.count(LOST) > 0.3 * len(got) + 1):
                    continue
                seen.add(got)
                bonus = 1.5 if whole and w == "utf-8" else -3.0 if r in WIDE and w in ("cp1251", "koi8-r") else -0.5 if r in WIDE and not whole else 0.0
                if bonus > 0:
                    again = to_bytes(got, r)
                    if again and again != b:
                        try:
                            twice = again.decode("utf-8")
                            if twice not in seen and not _NEVER.search(twice):
                                seen.add(twice)
                                out.append((twice, (r, w, r, w), 3.0))
                        except UnicodeDecodeError:
                            pass
                if self.strange(got):
                    continue
                if not _NEVER.search(got):
                    out.append((got, (r, w), bonus))
        return out

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: summed log-probability of its scored bigrams, those with the line ends around it included, and their number."""
        return self._sums(Laid(texts))

    def _sums(self, laid: Laid) -> tuple[np.ndarray, np.ndarray]:
        total = np.concatenate([[0.0], np.cumsum(self.scores(laid), dtype=np.float64)])
        lo, hi = np.searchsorted(laid.at, laid.first - 1), np.searchsorted(laid.at, laid.first + laid.sizes)
        return total[hi] - total[lo], hi - lo

    def gains(self, text: tuple[np.ndarray, np.ndarray], got: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """By how much texts of sums ``got`` are likelier than those of sums ``text``, per bigram, where that is evidence enough in all, else 0."""
        (s, n), (t, m) = text, got
        n1 = np.maximum(n, 1)
        each = t / np.maximum(m, 1) - s / n1
        # characters put together again must be likely each; those kept apart are compared one by one
        each = np.minimum(np.maximum(each, (t - s) / n1), each + 2.0)
        return np.where((n > 0) & (m > 0) & (each * n >= self.least), each, 0.0)

    def best(self, text: str) -> tuple[str, tuple | None, float]:
        """The likeliest reading of ``text``, its chain (None: as it stands) and its gain per bigram.

        A chain whose writing takes any bytes needs ``much`` evidence in all: a rare but correct character or two has less.
        """
        if text in self._known:
            return self._known[text]
        top: tuple[str, tuple | None, float] = (text, None, 0.0)
        if options := self.readings(text):
            s, n = self.sums([text, *(o[0] for o in options)])
            won = self.gains((s[:1], n[:1]), (s[1:], n[1:]))
            supported = bool(_SUPPORTED.search(text))
            for (got, chain, bonus), g in zip(options, won.tolist()):
                if not g or (chain[-1] not in MULTI and g * min(len(text), n[0]) < self.much) or (bonus < 1.5 and not supported):
                    continue
                if g + bonus > top[2]:
                    top = (got, chain, g + bonus)
        if len(text) <= 64:  # short stretches come again and again
            if len(self._known) > 50_000:
                self._known.clear()
            self._known[text] = top
        return top

    def restore(self, texts: list[str]) -> list[Restored]:
        """Each text restored as far as possible; one without chains isn't garbled.

        Rounds go on while they change something; each makes the text likelier, so they end. Where characters are lost
        and nothing can be restored, the chain is "lost".
        """
        out = [Restored(t, [], 0.0, []) for t in texts]
        laid = Laid(texts)
        gone = set(laid.owner(laid.high[_MAYBE_GONE[laid.low16]]).tolist())
        left = {k: texts[k] for k in range(len(texts))}
        past: dict[int, set[str]] = {}
        while left:
            numbers = list(left)
            found = self.suspects([left[k] for k in numbers], laid)
            laid = None  # of the texts as given, in the first round
            changed = {}
            for j, spots in found.items():
                k = numbers[j]
                text, used, most, edits = self._once(left[k], spots)
                if used and text not in past.setdefault(k, {left[k]}):
                    past[k].add(text)
                    changed[k] = text
                    out[k] = Restored(text, list(dict.fromkeys([*out[k].chains, *used])), max(out[k].gain, most), [*out[k].edits, edits])
            left = changed
        for k in gone:
            if not out[k].chains and _GONE.search(texts[k]):
                out[k] = Restored(texts[k], ["lost"], self.margin, [])
        return out

    def _once(self, text: str, spots: list[tuple[int, int]]) -> tuple[str, list[str], float, list[tuple[int, int, int]]]:
        """``text`` with its ``spots`` read by the chain that suits them all, or else by the best one of each."""
        # each distinct stretch counts once as evidence for a chain
        _, chain, won = self.best("\n".join(dict.fromkeys(text[a:b] for a, b in spots)))
        if not chain and len(narrow := [m.span() for m in UTF8_LOOK.finditer(text)]) > 3:
            spots = narrow  # sound text lies between: only what looks like UTF-8
            _, chain, won = self.best("\n".join(dict.fromkeys(text[a:b] for a, b in spots)))
        parts = [text[a:b] for a, b in spots]
        read, fit = parts, [False] * len(parts)
        if chain and won > self.margin:
            read = [_read(p, chain) for p in parts]
            if chain[-1] != "utf-8" or any(LOST in r for r in read):
                fit = [g > 0 for g in self.gains(self.sums(parts), self.sums(read))]
        out, at, used, most, edits = [], 0, [], 0.0, []
        for (a, b), part, got, good in zip(spots, parts, read, fit):
            if a < at:
                continue
            how = chain if got != part and not _NEVER.search(got) else None
            # valid UTF-8 needs no second look; any other reading must gain here too
            g = won if how and ((chain[-1] == "utf-8" and LOST not in got) or good) else 0.0
            if g <= self.margin and len(spots) > 1:
                got, how, g = self.best(part)
            if how and g > self.margin:
                out += [text[at:a], got]
                at, most = b, max(most, g)
                used.append(">".join(how))
                edits.append((a, b, len(got)))
        return "".join([*out, text[at:]]), used, most, edits


def _read(text: str, chain: tuple) -> str:
    """``text`` read by ``chain``; unchanged where it can't have been read so."""
    got = text
    for r, w in zip(chain[::2], chain[1::2]):
        raw = to_bytes(got, r)
        if raw is None:
            return text
        got = from_bytes(raw, w, LOST in got)[0]
    return got



@lru_cache(maxsize=None)
def _sloppy(enc: str) -> dict[int, int]:
    """Encoding table of a one-byte set; bytes it leaves undefined stand for themselves, as in lenient decoders."""
    table = {c: 0x10FFFF for c in range(128, 256)} | {b: b for b in range(128, 160)}
    for b in range(256):
        try:
            table[ord(bytes([b]).decode(enc))] = b
        except UnicodeDecodeError:
            pass
    return table | {0xFFFD: 255}


@lru_cache(maxsize=None)
def _held(enc: str) -> frozenset[str]:
    """The characters that a one-byte set holds, as ``to_bytes`` takes them."""
    return frozenset(chr(c) for c, b in _sloppy(enc).items() if b < 256)


def to_bytes(text: str, enc: str) -> bytes | None:
    """``text`` as the bytes it was read from under ``enc``; None where it can't have been. Lost characters become a byte valid nowhere."""
    try:
        if enc in WIDE:
            b = b"\xff".join(part.encode(enc) for part in text.split(LOST)) if LOST in text else text.encode(enc)
            return b if len(b) <= 2 * len(text) else None  # four-byte codes are no reading of anything
        return text.translate(_sloppy(enc)).encode("latin-1")
    except UnicodeEncodeError:
        return None


def _held_by() -> np.ndarray:
    """Of each character: the one-byte sets of ``READ_AS`` that hold it, as bits by place there; a line end is in all."""
    out = np.zeros(1 << 16, np.uint16)
    for k, r in enumerate(READ_AS):
        if r not in WIDE:
            out[[ord(c) for c in _held(r) if c < "\uffff"]] |= np.uint16(1 << k)
    return out


_HELD = _held_by()


def from_bytes(b: bytes, enc: str, lost: bool = False) -> tuple[str, bool]:
    """``b`` decoded, and whether nothing was lost. ``lost``: the byte 255 stands for lost characters, which stay lost."""
    if lost and enc not in MULTI:
        return LOST.join(part.decode(enc, "replace") for part in b.split(b"\xff")), False
    try:
        return b.decode(enc), True
    except UnicodeDecodeError:
        return b.decode(enc, "replace"), False


#: A character beyond ASCII that is no Han character, nor of the signs between and of full width.
_OTHER = re.compile("[^\x00-\x7f　-鿿＀-\uffef]*").match


def _widen(text: str, a: int, b: int) -> tuple[int, int]:
    """A stretch grown over the characters beyond ASCII that adjoin it and are not Han, and cut of ASCII at its ends."""
    while a < b and text[a] < "\x80":
        a += 1
    while b > a and text[b - 1] < "\x80":
        b -= 1
    if a < b and _OTHER(text[a]).end():
        while a > 0 and (n := _OTHER(text[max(a - 32, 0) : a][::-1]).end()):
            a -= n
    if a < b and _OTHER(text[b - 1]).end():
        b = _OTHER(text, b).end()
    # one ASCII character on either side is context that no chain changes
    return a - (0 < a < b and text[a - 1].isascii()), b + (a < b < len(text) and text[b].isascii())


def train_char_model(documents: DataFrame) -> CharModel:
    """The model of all clean records among ``documents`` (text), counted where they lie, and its margin (see ``validated``).

    Each task sends its non-zero counts; after summing there are at most DIM + SINGLES of them, whatever the
    input. The marks of suspicion come from these counts.
    """

    def count(batches):
        counts = Counts()
        for b in batches:
            for i in range(0, len(b), 500):
                counts.add(b.text[i : i + 500].tolist())
        for part, n, kind in ((0, counts.two, counts.kind), (1, counts.one, np.zeros(SINGLES, np.int32))):
            k = np.flatnonzero(n)
            yield pd.DataFrame({"part": np.full(len(k), part, np.int32), "k": k.astype(np.int32), "n": n[k], "kind": kind[k]})

    marked = documents.where(F.col("text").rlike(r"[^\x00-\x7f]")).select("text")
    got = marked.mapInPandas(count, "part int, k int, n long, kind int").groupBy("part", "k").agg(F.sum("n").alias("n"), F.max("kind").alias("kind")).toPandas()
    counts = Counts()
    for part, table in ((0, counts.two), (1, counts.one)):
        own = got[got.part == part]
        table[own.k.to_numpy()] = own.n.to_numpy()
        if not part:
            counts.kind[own.k.to_numpy()] = own.kind.to_numpy()
    return validated(marked, CharModel(counts))


def validated(documents: DataFrame, model: CharModel, share: float = 0.03) -> CharModel:
    """``model`` with its margin ABOVE what any chain gains anywhere in a record, in all but ``share`` of the clean records: those that only seem clean.

    All clean ``documents`` (text) are read. A task sends how many gain how much, as whole numbers that order as the gains
    do (the bits of a 32-bit float), staged; the gain looked for is found by their upper and then their lower 16 bits, so at most 2^16 sums
    reach the driver.
    """

    def gains(batches):
        known: dict[str, float] = {}
        n, over = 0, Counter()
        for b in batches:
            for part in portions(b.text.tolist(), 1_000_000):
                g = model.record_gains(part, known)
                n += len(g)
                over.update(g[g > 0].astype(np.float32).view(np.int32).tolist())
                if len(over) > 100_000:
                    yield pd.DataFrame({"bits": list(over.keys()), "n": list(over.values())})
                    over.clear()
        yield pd.DataFrame({"bits": [0, *over.keys()], "n": [n - sum(over.values()), *over.values()]})

    got = stage(documents.mapInPandas(gains, "bits int, n long"), "gains")
    upper, lower = F.shiftright("bits", 16), F.col("bits").bitwiseAND(0xFFFF)
    sums = sorted(((r.k, r.n) for r in got.groupBy(upper.alias("k")).agg(F.sum("n").alias("n")).collect()), reverse=True)
    total = sum(n for _, n in sums)
    left = int(share * total)  # so many records may gain more
    if total <= 50:
        return model
    for part, n in sums:
        if n > left:
            break
        left -= n
    if part:  # else the share gains nothing that could raise the margin
        for low, n in sorted(((r.k, r.n) for r in got.where((upper == part) & (F.col("n") > 0)).groupBy(lower.alias("k")).agg(F.sum("n").alias("n")).collect()), reverse=True):
            if n > left:
                break
            left -= n
        model.margin = max(model.margin, float(np.array([part << 16 | low], np.int32).view(np.float32)[0]) + ABOVE)
    return model


def full_repair(documents: DataFrame):
    """A function that restores wrongly decoded texts as ``restore_garbled`` does: all chains, the model counted over all ``documents``."""
    return train_char_model(documents).restore


def restore_udf(model: CharModel):
    """Column function: (text, chains, gain) of a text; chains is empty where it isn't garbled, null texts are never."""
    @F.pandas_udf("text string, chains array<string>, gain double")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [r for part in portions(texts.fillna("").tolist(), 400_000) for r in model.restore(part)]
        return pd.DataFrame([(r.text if r.chains else None, r.chains, r.gain) for r in rows], columns=["text", "chains", "gain"])

    return run


def restore_garbled(documents: DataFrame, model: CharModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, restored text, chains and gain of the garbled ones among ``documents`` (text).

    Texts that are null, blank or pure ASCII can't be garbled in this way and never reach Python.
    """
    read = documents.where(F.col("text").rlike(r"[^\x00-\x7f]")).select(*keep, restore_udf(model)("text").alias("r"))
    return read.select(*keep, F.col("r.text").alias("restored"), F.col("r.chains").alias("chains"), F.col("r.gain").alias("gain")).where(F.size("chains") > 0)

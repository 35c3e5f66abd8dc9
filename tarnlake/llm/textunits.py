"""Sentences and words of a text, for the Python side of the operators."""

from __future__ import annotations

import re

import numpy as np

#: A sentence runs to its closing mark and the quotes and brackets that follow, or to the line's end.
#: A full stop inside a number or a lower-case abbreviation doesn't close one; before a capital or a Han
#: character it does even without white space, as in texts pasted into Chinese ones.
SENTENCE = re.compile(r"[^\n]+?(?:[。！？]+[”’」』）\"]*|[.!?…]+[”’»\"')\]]*(?=\s|[A-ZÀ-ÖØ-ÞА-ЯЁ㐀-鿿¿¡«“„])|(?=\n)|\Z)")
#: Words of alphabetic scripts, Han characters singly.
WORD = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+")

#: The same for texts in ASCII, and, with letters as ranges, for those of the lowest plane: found faster.
_ASCII_WORD = re.compile("[A-Za-z]+")
_LOW_WORD = re.compile("[㐀-鿿]|[" + "".join(f"{m.group()[0]}-{m.group()[-1]}" for m in re.finditer(r"[^\W\d_㐀-鿿]+", "".join(map(chr, range(1 << 16))))) + "]+")


def words(text: str) -> list[str]:
    """What ``WORD`` finds in ``text``."""
    if text.isascii():
        return _ASCII_WORD.findall(text)
    return (_LOW_WORD if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else WORD).findall(text)


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence of ``text``."""
    return [m.span() for m in SENTENCE.finditer(text) if not m.group().isspace()]


def portions(texts: list[str], most: int = 200_000):
    """``texts`` in lists of some ``most`` characters, so that the matrices over their words stay small."""
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t) + 20
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


class WordRows:
    """Grows a matrix with one row per distinct word, computed once; forgets all when ``most`` is reached."""

    def __init__(self, width: int, make, most: int = 200_000, dtype=np.float32):
        self.width, self.make, self.most, self.dtype = width, make, most, dtype
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, self.width), self.dtype)

    def ids(self, words: list[str]) -> np.ndarray:
        at = self.at
        if len(at) > self.most:
            self.clear()
            at = self.at
        for w in set(words).difference(at):
            n = len(at)
            if n == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[n] = self.make(w)
            at[w] = n
        return np.fromiter(map(at.__getitem__, words), np.int64, len(words))


def sums(rows: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of ``rows[ids]`` over consecutive groups of ``counts`` ids; empty groups give zeros."""
    out = np.zeros((len(counts), rows.shape[1]), np.float32)
    full = counts > 0
    if full.any():
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        out[full] = np.add.reduceat(rows[ids], starts, axis=0)
    return out

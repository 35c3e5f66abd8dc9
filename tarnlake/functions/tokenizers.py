"""Tokenizers behind one surface, chosen by name, loaded once per Python worker."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.fixed import SPLIT_PATTERN


class TokenizerLike(Protocol):
    """What every tokenizer offers. Special tokens it doesn't have raise ``NotImplementedError``, as does a vocabulary it can't list."""

    vocab_size: int
    eod: int

    def tokenize(self, text: str) -> list[int]: ...

    def detokenize(self, ids: list[int]) -> str: ...

    @property
    def vocab(self) -> dict[str, int]: ...

    @property
    def inv_vocab(self) -> dict[int, str]: ...


class Surface:
    """The common surface: the vocabulary both ways and the special tokens cls, sep, pad, bos, eos and mask by name."""

    special: dict[str, int] = {}

    @property
    def vocab(self) -> dict[str, int]:
        raise NotImplementedError(f"{type(self).__name__} lists no vocabulary")

    @property
    def inv_vocab(self) -> dict[int, str]:
        return {i: t for t, i in self.vocab.items()}

    def __getattr__(self, name: str):
        if name in ("cls", "sep", "pad", "bos", "eos", "mask"):
            if name in self.special:
                return self.special[name]
            raise NotImplementedError(f"{type(self).__name__} has no token {name}")
        raise AttributeError(name)


class NullTokenizer(Surface):
    """Texts that are numbers between single spaces; the end-of-document id follows the last one."""

    def __init__(self, vocab_size: int = 0):
        self.vocab_size, self.eod = vocab_size + 1, vocab_size

    def tokenize(self, text):
        return [int(x) for x in text.split(" ")] if text else []

    def detokenize(self, ids):
        return " ".join(map(str, ids))

    @property
    def vocab(self):
        return {str(i): i for i in range(self.eod)}


class JsonTokenizer(Surface):
    """A tokenizer file of the tokenizers library; end of document is its text-end token, or -1 if it has none."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True
        self.vocab_size = self.t.get_vocab_size()
        self.eod = next((i for i in map(self.t.token_to_id, ("<|end_of_text|>", "<|endoftext|>")) if i is not None), -1)

    def tokenize(self, text):
        return self.t.encode(text, add_special_tokens=False).ids

    def detokenize(self, ids):
        return self.t.decode(ids)

    @property
    def vocab(self):
        return self.t.get_vocab()


class PieceTokenizer(Surface):
    """A piece model with special tokens.

    ``style``: "plain" adds the special tokens <CLS> <SEP> <EOD> <MASK> <PAD> <BOS> <EOS> and ``extra_ids`` more behind the
    pieces, those that the model lacks, and finds them in texts; its end of document is <EOD>. "gpt" has no others than the
    model's own and ends documents with its end token; "llama" does the same and puts the beginning token before every text.
    """

    NAMES = {"cls": "<CLS>", "sep": "<SEP>", "eod": "<EOD>", "mask": "<MASK>", "pad": "<PAD>", "bos": "<BOS>", "eos": "<EOS>"}

    def __init__(self, path: str, style: str = "gpt", extra_ids: int = 0):
        import sentencepiece

        if style not in ("plain", "gpt", "llama"):
            raise NotImplementedError(f"no piece style {style}")
        self.p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.style, n = style, self.p.get_piece_size()
        self.added: dict[str, int] = {}
        own = {"bos": self.p.bos_id(), "eos": self.p.eos_id(), "pad": self.p.pad_id()}
        self.special = {k: i for k, i in own.items() if i >= 0}
        if style == "plain":
            for name, text in self.NAMES.items():
                if name in self.special:
                    continue
                i = self.p.piece_to_id(text)
                if i == self.p.unk_id():
                    i = n + len(self.added)
                    self.added[text] = i
                self.special[name] = i
            for k in range(extra_ids):
                self.added[f"<extra_id_{k}>"] = n + len(self.added)
            self.scan = re.compile("(" + "|".join(map(re.escape, {**self.added, **{self.p.id_to_piece(i): i for i in self.special.values() if i < n}})) + ")")
        self.eod = self.special["eod"] if style == "plain" else self.p.eos_id()
        self.vocab_size = n + len(self.added)

    def _of(self, text: str) -> int:
        return self.added[text] if text in self.added else self.p.piece_to_id(text)

    def tokenize(self, text):
        if self.style == "plain":
            parts = self.scan.split(text)
            return [i for k, part in enumerate(parts) if part for i in ([self._of(part)] if k % 2 else self.p.encode(part, num_threads=1))]
        ids = self.p.encode(text, num_threads=1)
        return [self.p.bos_id(), *ids] if self.style == "llama" else ids

    def detokenize(self, ids):
        back = {i: t for t, i in self.added.items()}
        out, run = [], []
        for i in [*ids, None]:
            if i is None or i in back:
                out += ([self.p.decode(run)] if run else []) + ([back[i]] if i in back else [])
                run = []
            elif not (self.style == "llama" and i == self.p.bos_id()):
                run.append(i)
        return "".join(out)

    @property
    def vocab(self):
        return {self.p.id_to_piece(i): i for i in range(self.p.get_piece_size())} | self.added


class RankTokenizer(Surface):
    """Byte-level merges by rank; the id after the last rank ends a document."""

    def __init__(self, path: str, pattern: str | None = None):
        import base64

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._load(path, ranks, pattern)
        self.eod = max(ranks.values()) + 1
        self.vocab_size = self.eod + 1

    def _load(self, name: str, ranks: dict[bytes, int], pattern: str | None) -> None:
        import tiktoken

        self.ranks = ranks
        self.e = tiktoken.Encoding(name, pat_str=pattern or SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def tokenize(self, text):
        return self.e.encode_ordinary(text)

    def detokenize(self, ids):
        return self.e.decode([i for i in ids if i != self.eod])

    @property
    def vocab(self):
        return {k.decode("utf-8", "backslashreplace"): v for k, v in self.ranks.items()}


class MergeTokenizer(Surface):
    """Byte-level merges given as a vocabulary (JSON, token to id) and a list of merges, the earlier the stronger.

    Tokens are written with a printable character for each byte. End of document: <|endoftext|> where the vocabulary has it.
    """

    def __init__(self, vocabulary: str, merges: str, pattern: str | None = None):
        import json

        from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

        with open(vocabulary, encoding="utf-8") as f:
            self.words = json.load(f)
        with open(merges, encoding="utf-8") as f:
            pairs = [tuple(x.split()) for x in f.read().split("\n") if x and not x.startswith("#version")]
        self.t = Tokenizer(models.BPE(self.words, [p for p in pairs if len(p) == 2]))
        split = pre_tokenizers.Split(Regex(pattern or SPLIT_PATTERN), "isolated")
        self.t.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.t.decoder = decoders.ByteLevel()
        self.vocab_size, self.eod = len(self.words), self.words.get("<|endoftext|>", -1)

    def tokenize(self, text):
        return self.t.encode(text, add_special_tokens=False).ids

    def detokenize(self, ids):
        return self.t.decode([i for i in ids if i != self.eod], skip_special_tokens=False)

    @property
    def vocab(self):
        return dict(self.words)


class WordPieceTokenizer(Surface):
    """Words cut greedily into the longest pieces of a vocabulary file; later pieces bear ##. End of document: [SEP]."""

    def __init__(self, path: str, lower: bool = True, longest: int = 200):
        with open(path, encoding="utf-8") as f:
            self.words = [w.rstrip("\n") for w in f]
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.lower, self.longest = lower, longest
        self.special = {k: self.ids[t] for k, t in (("cls", "[CLS]"), ("sep", "[SEP]"), ("pad", "[PAD]"), ("mask", "[MASK]")) if t in self.ids}
        self.vocab_size, self.eod = len(self.words), self.ids["[SEP]"]

    def split(self, text: str) -> list[str]:
        """Words, signs and Han characters singly; control characters dropped, accents stripped where letters are lowered."""
        out: list[str] = []
        word = ""
        if self.lower:
            text = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")
        for c in text:
            kind = unicodedata.category(c)
            if c.isspace() or kind == "Zs":
                out, word = ([*out, word] if word else out), ""
            elif c in "\0�" or kind in ("Cc", "Cf"):
                continue
            elif kind.startswith("P") or (c.isascii() and not c.isalnum()) or "一" <= c <= "鿿" or "㐀" <= c <= "䶿":
                out, word = [*out, word, c] if word else [*out, c], ""
            else:
                word += c
        return [*out, word] if word else out

    def pieces(self, word: str) -> list[str]:
        if len(word) > self.longest:
            return ["[UNK]"]
        found, at = [], 0
        while at < len(word):
            for end in range(len(word), at, -1):
                p = ("##" if at else "") + word[at:end]
                if p in self.ids:
                    found.append(p)
                    at = end
                    break
            else:
                return ["[UNK]"]
        return found

    def tokenize(self, text):
        return [self.ids[p] for w in self.split(text) for p in self.pieces(w)]

    def detokenize(self, ids):
        return " ".join(self.words[i] for i in ids).replace(" ##", "")

    @property
    def vocab(self):
        return dict(self.ids)


class TrieTokenizer(Surface):
    """The longest token of a vocabulary file at each place; lines: id, Python literal of the token, its bytes. End of document: ``eod``."""

    def __init__(self, path: str, eod: int = 0):
        import ast

        self.tokens: dict[bytes, int] = {}
        with open(path, encoding="utf-8") as f:
            for line in f:
                n, _, rest = line.partition(" ")
                value = ast.literal_eval(rest[: rest.rindex(" ")])
                self.tokens[value.encode() if isinstance(value, str) else value] = int(n)
        self.bytes_of = {v: k for k, v in self.tokens.items()}
        self.longest = max(map(len, self.tokens))
        self.eod, self.vocab_size = eod, max(self.bytes_of) + 1

    def tokenize(self, text):
        data, at, out = text.encode(), 0, []
        while at < len(data):
            n = next((n for n in range(min(self.longest, len(data) - at), 0, -1) if data[at : at + n] in self.tokens), 0)
            if not n:
                raise ValueError(f"byte {data[at]} is in no token")
            out.append(self.tokens[data[at : at + n]])
            at += n
        return out

    def detokenize(self, ids):
        return b"".join(self.bytes_of[i] for i in ids if i != self.eod).decode("utf-8", "replace")

    @property
    def vocab(self):
        return {k.decode("utf-8", "backslashreplace"): v for k, v in self.tokens.items()}


KINDS = {"trie": TrieTokenizer, "null": NullTokenizer, "json": JsonTokenizer, "pieces": PieceTokenizer, "ranks": RankTokenizer, "merges": MergeTokenizer, "wordpiece": WordPieceTokenizer}
#: Names under which callers may ask for a tokenizer, and the arguments that follow the files.
NAMED = {
    "BertWordPieceLowerCase": ("wordpiece", (True,)), "BertWordPieceCase": ("wordpiece", (False,)), "GPT2BPETokenizer": ("merges", ()), "SentencePieceTokenizer": ("pieces", ("plain",)), "GPTSentencePieceTokenizer": ("pieces", ("gpt",)),
    "Llama2Tokenizer": ("pieces", ("llama",)), "NullTokenizer": ("null", ()), "RWKVTokenizer": ("trie", ()), "HFTokenizer": ("json", ()),
}


def tokenizer_arguments(name: str, *files) -> tuple:
    """(kind, *arguments) of ``build_tokenizer`` for a kind or one of the names in ``NAMED``; an unknown one raises."""
    if name in KINDS:
        return name, *files
    if name not in NAMED:
        raise NotImplementedError(f"no tokenizer {name}; there are {', '.join([*KINDS, *NAMED])}")
    kind, more = NAMED[name]
    return kind, *files, *more


@lru_cache(maxsize=8)
def build_tokenizer(kind: str, *args) -> TokenizerLike:
    """A tokenizer by kind and its arguments; an unknown kind raises."""
    if kind not in KINDS:
        raise NotImplementedError(f"no tokenizer {kind}; there are {', '.join(KINDS)}")
    return KINDS[kind](*args)


def padded_vocabulary(size: int, multiple: int = 128, parallel: int = 1) -> int:
    """``size`` up to the next multiple of ``multiple`` times ``parallel``."""
    m = multiple * parallel
    return -(-size // m) * m


#: A sentence end for encoding, the white space behind it apart.
_SENTENCE_END = re.compile(r"(?<=[.!?。！？])(\s+)")


def text_sentences(text: str, keep_space: bool = False, piece: int = 1_000_000) -> list[str]:
    """Sentences of a text, cut ``piece`` characters at a time so that none is longer; ``keep_space``: with the white space behind them."""
    out = []
    for a in range(0, len(text), piece):
        parts = _SENTENCE_END.split(text[a : a + piece])
        out += [p + (s if keep_space else "") for p, s in zip(parts[::2], [*parts[1::2], ""])]
    return [x for x in out if x]


def encode_udf(kind: str, *args, end_of_document: bool = True, by_sentence: bool = False, keep_space: bool = False):
    """Column function: (ids, lens) of a text's tokens, the end-of-document id added to the last sentence if there are any.

    ``by_sentence``: lengths by sentence, with ``keep_space`` the white space behind each, else of the whole text. Null and
    empty texts give none.
    """

    @F.pandas_udf("ids array<int>, lens array<int>")
    def run(texts: pd.Series) -> pd.DataFrame:
        t = build_tokenizer(kind, *args)
        rows = []
        for x in texts:
            parts = (text_sentences(x, keep_space) if by_sentence else [x]) if x else []
            parts = [p for p in (list(t.tokenize(p)) for p in parts) if p]
            if parts and end_of_document:
                parts[-1].append(t.eod)
            rows.append(([i for p in parts for i in p], [len(p) for p in parts]))
        return pd.DataFrame(rows, columns=["ids", "lens"])

    return run


def encoding_totals(df: DataFrame, kind: str, *args) -> DataFrame:
    """One row: documents, sequences, tokens and bytes of text that an encoding of ``df`` (text) makes."""
    r = df.select(F.octet_length("text").cast("long").alias("n"), encode_udf(kind, *args)("text").alias("r"))
    sums = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return r.agg(F.count("*").alias("n_docs"), sums(F.size("r.lens")).alias("n_sequences"), sums(F.size("r.ids")).alias("n_tokens"), sums("n").alias("n_bytes"))

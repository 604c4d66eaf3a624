"""Tokenizers as an extension point: lengths, ids and character offsets of texts.

A :class:`Tokenizer` is shipped to the tasks without its model and opens it there, once
for each Python worker; texts reach it in Arrow batches. What is built from lengths
(supervision masks, padding) stays in native expressions, see ``estuary.operators.text``.

``Words`` counts white-space words without any model file and is the default there;
``Pieces`` reads a sentencepiece model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Tokenizer:
    """``tokens(text)`` gives (id, begin, end) of each token, begin and end in characters of
    the text; tokens that stand for no characters (a begin token) have begin = end."""

    def open(self) -> None:
        """Load what the tokenizer needs; called once in each Python worker before its first text."""

    def tokens(self, text: str) -> list[tuple[int, int, int]]:
        raise NotImplementedError

    def ids(self, text: str) -> list[int]:
        return [t[0] for t in self.tokens(text)]


class Pieces(Tokenizer):
    """A sentencepiece model, with a begin token and with ``specials`` (strings in the text that
    are one token each, as ``</s>``). The text between specials is encoded by itself, so a
    part of a text that ends at a special string has the tokens that it has in the whole text."""

    def __init__(self, path: str, specials: tuple[str, ...] = ("</s>",), begin: bool = True):
        self.path, self.specials, self.begin = path, specials, begin
        self._model = None

    def __getstate__(self):
        return self.__dict__ | {"_model": None}

    def open(self) -> None:
        import sentencepiece

        if self._model is None:
            self._model = sentencepiece.SentencePieceProcessor(model_file=self.path)
            self._special = {s: self._model.piece_to_id(s) for s in self.specials}
            self._cut = re.compile("|".join(f"({re.escape(s)})" for s in self.specials) or "(?!)")

    def _parts(self, text: str) -> Iterator[tuple[int, int, bool]]:
        at = 0
        for m in self._cut.finditer(text):
            if m.start() > at:
                yield at, m.start(), False
            yield m.start(), m.end(), True
            at = m.end()
        if at < len(text):
            yield at, len(text), False

    def _first(self) -> list[int]:
        return [self._model.bos_id()] if self.begin else []

    def tokens(self, text: str) -> list[tuple[int, int, int]]:
        out = [(i, 0, 0) for i in self._first()]
        for a, b, special in self._parts(text):
            if special:
                out.append((self._special[text[a:b]], a, b))
            else:
                raw = text[a:b].encode()
                at = [*accumulate((c & 0xC0 != 0x80 for c in raw), initial=0)]  # characters that begin before each byte
                out += [(p.id, a + at[p.begin], a + at[p.end]) for p in self._model.encode(raw, return_type="proto").pieces]
        return out

    def ids(self, text: str) -> list[int]:
        out = self._first()
        for a, b, special in self._parts(text):
            out += [self._special[text[a:b]]] if special else self._model.encode(text[a:b])
        return out


def _over(tokenizer: Tokenizer, of: Callable):
    """Iterator pandas UDF body: the tokenizer is opened before the first batch."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer.open()
        for b in batches:
            yield pd.Series([of(tokenizer, x) for x in b], dtype=object)

    return run


def lengths(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    """Column function array<string> → array<int>: tokens of each text; NULL counts as ''."""
    return F.pandas_udf(_over(tokenizer, lambda t, texts: [] if texts is None else [len(t.ids(x or "")) for x in texts]), "array<int>")


def encode(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    """Column function string → array<int>: ids of the text; NULL counts as ''."""
    return F.pandas_udf(_over(tokenizer, lambda t, x: t.ids(x or "")), "array<int>")


def offsets(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    """Column function string → array<struct<id, s, e>>: ids and the characters they stand for."""
    def of(t: Tokenizer, x: str | None):
        return [{"id": i, "s": s, "e": e} for i, s, e in t.tokens(x or "")]

    return F.pandas_udf(_over(tokenizer, of), "array<struct<id:int,s:int,e:int>>")


def token_span(tokens: Column, start: Column, end: Column) -> Column:
    """Half-open range (s, e) of the tokens of :func:`offsets` whose last character is one of ``start`` to
    ``end`` (half-open; a space belongs to the token of the word after it); NULL if there is none."""
    inside = F.filter(F.sequence(F.lit(1), F.size(tokens)), lambda k: (F.element_at(tokens, k)["e"] > start)
                      & (F.element_at(tokens, k)["e"] <= end))
    return F.when(F.size(inside) > 0, F.struct((F.element_at(inside, 1) - 1).alias("s"), F.element_at(inside, -1).alias("e")))

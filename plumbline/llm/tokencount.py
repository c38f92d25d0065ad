"""Token counts of a unigram vocabulary without building tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character; one
pass of dynamic programming carries the best score and its number of pieces per place.
Tie rules are those of the exact tokenizer (`tokenizers`' Unigram with byte fallback
behind a Metaspace pre-tokenizer): a later candidate replaces an earlier one only if it
is strictly better, and candidates for one end come in order of their starts, so the
longest piece wins a tie; a character that is no piece itself may also be unknown, ten
below the least score, and counts as its UTF-8 bytes.

Words (runs without spaces, each behind a mark) are independent, so counts are kept per
word for a bounded number of words.

Edge cases: null and empty texts have 0 tokens; repeated rows and extra columns change
nothing; a word of any length is counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import inf

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.catalogue import query

MARK = "▁"
PENALTY = 10.0
CACHE_WORDS = 500_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Number of tokens by marked word."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - PENALTY
        names = {piece for piece, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))

    def count(self, word: str) -> int:
        """Best segmentation of one word: score and count per end, ends in order."""
        n = len(word)
        if self.single.issuperset(word):  # nothing is unknown; matches come by end, longest first
            best, pieces = [0.0] + [-inf] * n, [0] * (n + 1)
            for end, (length, score) in self.automaton.iter(word):
                value = score + best[end + 1 - length]
                if value > best[end + 1]:
                    best[end + 1], pieces[end + 1] = value, pieces[end + 1 - length] + 1
            return pieces[n]
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        open_run = [False] * (n + 1)  # the best path ends with an unknown (only without byte fallback)
        by_end: list[list] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            by_end[end].append(match)
        for end in range(1, n + 1):
            top, number, run = None, 0, False
            for length, score in sorted(by_end[end - 1], reverse=True):
                value = score + best[end - length]
                if top is None or value > top:
                    top, number, run = value, pieces[end - length] + 1, False
            char = word[end - 1]
            if char not in self.single:
                value = self.unknown + best[end - 1]
                if top is None or value > top:
                    extra = len(char.encode("utf-8", "surrogatepass")) if self.bytes else int(not open_run[end - 1])
                    top, number, run = value, pieces[end - 1] + extra, True
            best[end], pieces[end], open_run[end] = top, number, run
        return pieces[n]

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = self.count(MARK + word)
        if len(word) <= 64:
            self[word] = found
        return found

    def tokens(self, text: str) -> int:
        """Words between spaces, each with a mark before it; a space more is a mark alone."""
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if text[0] == " ":
            text = text[1:]
        return sum(map(self.__getitem__, text.split(" ")))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def with_token_count(docs: DataFrame, model: str, *, text: str = "text", column: str = "n_tokens") -> DataFrame:
    """The documents with their number of tokens under the model file's vocabulary."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(model)
        for texts in batches:
            yield pd.Series([own.tokens(t or "") for t in texts], dtype="int64")

    return docs.withColumn(column, count(F.col(text)))


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op7_token_counts")
def op7_token_counts(t) -> DataFrame:
    return with_token_count(t("documents").select("doc_id", "text"), vocabulary_path()).select("doc_id", "n_tokens")

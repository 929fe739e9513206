"""Greedy longest-match token counts in one pass over each word, without building pieces.

The vocabulary is a trie over bytes. The end mark of a token stays with its last byte: the last byte of a word and that of
a word-final token are symbols of their own (256 more), so such a token matches only at the end of a word and another
one only before it. A node that is a token fails to the root and pops one token; another node fails to where the rest of its text leads after
its greedy tokens are taken off, and pops as many. Reading a word follows the trie, and adds
up the counts of the failure links taken: linear in the word, whatever the tokens are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

#: What is added to the last byte of a word, and the bits of a symbol.
LAST, BITS = 256, 9
#: Words whose counts a Python worker remembers; beyond it the memory starts anew.
CACHE_WORDS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one beyond 255."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str, end: str = "</w>") -> list[tuple[int, ...]]:
    """Tokens of a byte-level vocabulary file as symbols; special tokens are left out.

    A file without end marks has no word-final tokens: then every token matches anywhere.
    """
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    special = {t["content"] for t in told.get("added_tokens", [])}
    letter = byte_letters()
    tokens = [t for t in told["model"]["vocab"] if t not in special and t != end]
    marked = any(t.endswith(end) for t in tokens)
    out = set()
    for token in tokens:
        body = tuple(letter[c] for c in token.removesuffix(end))
        if token.endswith(end) or not marked:
            out.add(final(body))
        if not token.endswith(end):
            out.add(body)
    return sorted(out)


def final(symbols: Sequence[int]) -> tuple[int, ...]:
    """Symbols with the last one marked as the end of a word."""
    return (*symbols[:-1], symbols[-1] + LAST)


class LongestMatch:
    """The automaton of a vocabulary."""

    _loaded: dict[str, LongestMatch] = {}

    def __init__(self, tokens: Iterable[Sequence[int]]):
        go: dict[int, int] = {}
        children: list[list[tuple[int, int]]] = [[]]
        whole = [False]
        for token in tokens:
            at = 0
            for symbol in token:
                to = go.get(at << BITS | symbol)
                if to is None:
                    to = go[at << BITS | symbol] = len(children)
                    children[at].append((symbol, to))
                    children.append([])
                    whole.append(False)
                at = to
            whole[at] |= at > 0
        self.go, self.fail, self.pops = go, [-1] * len(children), [0] * len(children)
        level = [0]
        while level:
            below = []
            for node in level:
                for symbol, child in children[node]:
                    if whole[child]:
                        self.fail[child], self.pops[child] = 0, 1
                    else:
                        back, popped = self.fail[node], self.pops[node]
                        while back >= 0 and back << BITS | symbol not in go:
                            popped += self.pops[back]
                            back = self.fail[back]
                        self.fail[child], self.pops[child] = (go[back << BITS | symbol], popped) if back >= 0 else (-1, 0)
                    below.append(child)
            level = below
        self.counts: dict[bytes, int] = {}

    @classmethod
    def load(cls, path: str) -> LongestMatch:
        if path not in cls._loaded:
            cls._loaded[path] = cls(read_vocabulary(path))
        return cls._loaded[path]

    def count(self, word: bytes) -> int:
        """Tokens of one word; 0 if greedy matching cannot finish it."""
        go, fail, pops, at, n = self.go, self.fail, self.pops, 0, 0
        for symbol in final(word):
            to = go.get(at << BITS | symbol)
            while to is None:
                n += pops[at]
                at = fail[at]
                if at < 0:
                    return 0
                to = go.get(at << BITS | symbol)
            at = to
        while at:
            n += pops[at]
            at = fail[at]
            if at < 0:
                return 0
        return n

    def text(self, text: str) -> tuple[int, int, int]:
        """Words, tokens, unknown words (one token each) of a whole text."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if len(self.counts) > CACHE_WORDS:
            self.counts = {}
        known = list(map(self.counts.get, words))
        for i, n in enumerate(known) if None in known else ():
            if n is None:
                known[i] = self.counts[words[i]] = self.count(words[i])
        unknown = known.count(0)
        return len(words), sum(known) + unknown, unknown


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens``, ``n_unknown`` of each row.

    Words are cut at ASCII white space after lower-casing A-Z. A null or empty text has
    none. Rows are counted one by one; repeats stay, other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = LongestMatch.load(vocabulary)
        for pdf in batches:
            found = pd.DataFrame([known.text(t or "") for t in pdf.pop("text")], columns=["n_words", "n_tokens", "n_unknown"], index=pdf.index)
            yield pd.concat([pdf, found], axis=1)

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, n_words long, n_tokens long, n_unknown long")

"""Greedy word-piece token counts (operator 9) by the linear longest-match
automaton (Song et al., EMNLP 2021).

The vocabulary is a trie over bytes with two roots: pieces that begin a word
and pieces that continue one. A node's failure link leads to the state in
which matching goes on once its string's longest pieces are popped; the
number of pieces popped on that link is precomputed, so a word's length in
pieces falls out of one walk over its bytes and no piece is ever built.

Vocabulary: a byte-level BPE file of the public tokenizers (a parameter);
its word-start mark tells beginning pieces from continuing ones.

Defined results: words are runs of characters other than ASCII white space; a
word that greedy matching cannot cover counts one unknown token; a null,
empty or blank text has no words and no tokens. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections import deque
from functools import lru_cache

from pyspark.sql import DataFrame

from colloquy.llm.common import append_columns

VOCABULARY = "byte_bpe_50k.json"
MEMO = 500_000


def _byte_of_symbol() -> dict[str, int]:
    """Inverse of the byte alphabet of byte-level BPE: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """(pieces that begin a word, pieces that continue one)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    alphabet, special = _byte_of_symbol(), {t["content"] for t in model.get("added_tokens", [])}
    begin, inner = [], []
    for token in model["model"]["vocab"]:
        if token in special:
            continue
        raw = bytes(alphabet[c] for c in token)
        if b" " not in raw.strip(b" ") and raw.startswith(b" "):
            begin.append(raw.lstrip(b" "))
        elif not any(b in raw for b in b" \t\n\r\x0b\x0c"):
            inner.append(raw)
    return [p for p in begin if p], inner


class Automaton:
    """go[state][byte], fail[state] (-1: none), popped[state]; state 0 begins a
    word, state 1 continues one."""

    def __init__(self, begin: list[bytes], inner: list[bytes]):
        self.go: list[dict[int, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in ((0, begin), (1, inner)):
            for piece in pieces:
                s = root
                for byte in piece:
                    nxt = self.go[s].get(byte)
                    if nxt is None:
                        nxt = self.go[s][byte] = len(self.go)
                        self.go.append({})
                        final.append(False)
                    s = nxt
                final[s] = True
        self.fail, self.popped = [-1] * len(self.go), [0] * len(self.go)
        queue = deque([0, 1])
        while queue:
            s = queue.popleft()
            for byte, child in self.go[s].items():
                if final[child]:
                    self.fail[child], self.popped[child] = 1, 1
                else:
                    at, n = self.fail[s], self.popped[s]
                    while at >= 0 and byte not in self.go[at]:
                        n += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.popped[child] = self.go[at][byte], n
                queue.append(child)

    def pieces(self, word: bytes) -> int:
        """Number of pieces of a word; 0 when it cannot be covered."""
        go, fail, popped = self.go, self.fail, self.popped
        s, n = 0, 0
        for byte in word:
            nxt = go[s].get(byte)
            while nxt is None:
                if fail[s] < 0:
                    return 0
                n += popped[s]
                s = fail[s]
                nxt = go[s].get(byte)
            s = nxt
        while s != 1:
            if s < 0 or fail[s] < 0:
                return 0
            n += popped[s]
            s = fail[s]
        return n


class _Memo(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.pieces(word)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = n
        return n


@lru_cache(maxsize=2)
def _counter(path: str) -> _Memo:
    """Built once per worker process."""
    return _Memo(Automaton(*read_vocabulary(path)))


def count_texts(path: str, texts: list[str | None]):
    memo = _counter(path)
    out = ([], [], [])
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split() if text else []
        counts = list(map(memo.__getitem__, words))
        unknown = counts.count(0)
        for column, value in zip(out, (len(words), sum(counts) + unknown, unknown)):
            column.append(value)
    return out


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def token_counts(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` (with a column text) and n_words, n_tokens, n_unknown."""
    at = path or default_vocabulary()
    return append_columns(df, lambda texts: count_texts(at, texts), "n_words long, n_tokens long, n_unknown long")


def op9_query(docs: DataFrame) -> DataFrame:
    return token_counts(docs.select("doc_id", "text")).drop("text")

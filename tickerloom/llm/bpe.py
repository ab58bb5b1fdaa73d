"""Byte-pair encoding and decoding with a public vocabulary.

A word's symbols form a doubly linked list. A priority queue holds the ranks of adjacent pairs; the pair of the lowest
rank, leftmost first, is merged and its new neighbours are queued. An entry whose symbols have changed since it was
queued is stale and is skipped. Decoding concatenates vocabulary strings.

The vocabulary file has the public JSON format of byte-level BPE with word ends. Its path is an argument, read on the
driver once; the merge and vocabulary tables (of the file's size, about 2 MB) are broadcast.

Defined cases: a missing text is empty and has no ids; an unknown id decodes to nothing; a text with lone surrogates
can't occur in a string column; repeated rows are encoded alike; an empty table gives an empty result; other columns
are returned unchanged, and a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import text_udf

#: Stretches of text without white space whose ids a Python worker keeps; longer ones are not kept.
CACHE, KEPT = 250_000, 40
#: Rows whose ids and decoded texts a worker makes at a time: together they take several times the bytes of the texts.
ROWS = 100
#: Bits of a symbol's number.
BITS = 20
#: White space as the vocabulary's normaliser takes it (the Unicode property, without the separators 1C to 1F).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, more = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], more = chr(more), more + 1
    return [letters[b] for b in range(256)]


def merge(symbols: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """Merge adjacent symbols. ``ranks`` maps a pair (``left << BITS | right``) to its rank, ``made`` a rank to its symbol.

    A queue entry is ``rank << 32 | place``. It is stale unless the pair that now begins at its place has its rank.
    """
    n, get, push = len(symbols), ranks.get, heapq.heappush
    if n == 1:
        return symbols
    symbols, before, after = symbols.copy(), list(range(-1, n - 1)), list(range(1, n + 1))
    after[-1] = -1
    queue, left = [], symbols[0]
    for i in range(1, n):
        right = symbols[i]
        if (rank := get(left << BITS | right)) is not None:
            queue.append(rank << 32 | i - 1)
        left = right
    heapq.heapify(queue)
    pop = heapq.heappop
    while queue:
        entry = pop(queue)
        i, rank = entry & 0xFFFFFFFF, entry >> 32
        left, j = symbols[i], after[i]
        if j < 0 or left < 0 or get(left << BITS | symbols[j]) != rank:
            continue  # stale: one of the two has been merged since
        symbols[i] = new = made[rank]
        symbols[j] = -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (rank := get(new << BITS | symbols[k])) is not None:
                push(queue, rank << 32 | i)
        h = before[i]
        if h >= 0 and (rank := get(symbols[h] << BITS | new)) is not None:
            push(queue, rank << 32 | h)
    return [s for s in symbols if s >= 0]


class Kept(dict):
    """The results of a function for short strings: at ``CACHE`` of them the younger half stays for those that come again."""

    def __init__(self, function):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, text: str) -> bytes:
        if (found := self.older.get(text)) is None:
            found = self.function(text)
        if len(text) <= KEPT:
            if len(self) >= CACHE // 2:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


class Vocabulary:
    """Tables of one vocabulary file: encodes words and names ids."""

    def __init__(self, source: str):
        made = json.loads(source)
        model, self.end = made["model"], made["model"]["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.names = {i: name for name, i in ids.items()} | {t["id"]: t["content"] for t in made["added_tokens"]}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.made = [ids[left + right] for left, right in pairs]
        self.ranks: dict[int, int] = {}
        for rank, (left, right) in enumerate(pairs):
            self.ranks.setdefault(ids[left] << BITS | ids[right], rank)
        letters = byte_letters()
        self.inner = [ids[x] for x in letters]
        self.last = [ids[x + self.end] for x in letters]
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        pattern = made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", SPACE)
        self.words = regex.compile(pattern)
        self.ids_of = Kept(self._ids)

    def _ids(self, stretch: str) -> bytes:
        """The ids of a stretch without white space: a word, or several words and marks."""
        words = self.words.findall(stretch)
        if words != [stretch]:
            return b"".join([self.ids_of[word] for word in words])
        data = stretch.encode("utf-8")
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        return array("i", merge(symbols, self.ranks, self.made)).tobytes()

    def _plain(self, text: str, found: bytearray) -> None:
        """No word spans white space, so which white space there is doesn't matter."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Each character by itself, so a capital sigma never becomes a final one.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        if SEPARATORS.search(text):  # white space for str.split only
            for word in self.words.findall(text):
                found += self.ids_of[word]
            return
        for stretch in text.split():
            found += self.ids_of[stretch]

    def encode(self, text: str, found: bytearray) -> None:
        """Append the ids of a whole text to ``found``, four bytes each."""
        at = 0
        if "<" in text:
            for hit in self.split_special.finditer(text):
                self._plain(text[at:hit.start()], found)
                found += array("i", [self.special[hit[0]]]).tobytes()
                at = hit.end()
        self._plain(text[at:] if at else text, found)

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of ``ids``; this file names no decoder, so a blank stands between two of them."""
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except KeyError:
            return " ".join([self.names[i] for i in ids if i in self.names])


_MADE: dict[str, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """The tables of a broadcast file, made once in each Python worker."""
    source = shared.value
    if source not in _MADE:
        _MADE.clear()
        _MADE[source] = Vocabulary(source)
    return _MADE[source]


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Path(path).read_text("utf-8"))


def _lists(vocabulary: Vocabulary, texts: pa.Array) -> pa.ListArray:
    found, ends = bytearray(), [0]
    for text in texts:
        vocabulary.encode(text.as_py() or "", found)
        ends.append(len(found) // 4)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(found, np.int32)))


def _strings(vocabulary: Vocabulary, lists: pa.ListArray) -> pa.Array:
    return pa.array([vocabulary.decode(x.values.to_numpy().tolist() if x.is_valid else []) for x in lists], pa.string())


def _few(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The rows of the batches, at most ``ROWS`` at a time."""
    for batch in batches:
        for first in range(0, len(batch), ROWS):
            yield batch.slice(first, ROWS)


def _both(vocabulary: Vocabulary, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in _few(batches):
        lists = _lists(vocabulary, texts)
        yield pa.StructArray.from_arrays([lists, _strings(vocabulary, lists)], ["ids", "decoded"])


def encoded(spark: SparkSession, path: str, text: Column) -> Column:
    """The ids (array of int) of a text column."""
    shared = _shared(spark, path)

    @text_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(shared)
        for texts in _few(batches):
            yield _lists(vocabulary, texts)

    return encode(text)


def decoded(spark: SparkSession, path: str, ids: Column) -> Column:
    """The text of a column of ids."""
    shared = _shared(spark, path)

    @text_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(shared)
        for lists in _few(batches):
            yield _strings(vocabulary, lists)

    return decode(ids)


def round_trip(spark: SparkSession, path: str, text: Column) -> Column:
    """``ids`` of a text column and ``decoded``, the text of those ids, from one Python worker instead of two."""
    shared = _shared(spark, path)

    @text_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _both(_vocabulary(shared), batches)

    return both(text)

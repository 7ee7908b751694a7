"""Byte-level BPE: encoding and decoding in batched numpy merge rounds.

A text is cut at the strings of the added tokens, which have ids of their own, and
then into words.  The words that a task hasn't met before are encoded together: the
symbols of all of them stand in one flat array, and each round looks up the pairs
that are new in the sorted pair keys (binary search), takes the lowest rank of each
word and merges every pair of that rank, from the left where pairs overlap, until no
pair of any word is in the table.  A later merge's pair always has a higher rank than
the merges it is made of, so this gives what merging one pair at a time gives.  Words
are first cut between bytes that no token holds side by side; no merge spans such a
place.

Decoding gathers the bytes of all ids of a batch at once; bytes that are no UTF-8
become U+FFFD, and ids that the vocabulary doesn't have are left out.

Each text is worked on alone: nothing is shuffled.  Texts are taken in pieces of about
a megabyte that end where a word ends, so memory follows a text's ids and not what the
rounds need beside them.  Null and empty texts have no ids; repeated rows give a row
each, an empty table an empty result; extra columns are ignored.  The vocabulary is
read by each task from a file that the executors have.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Characters of a text that are taken at a time, and ids that are decoded at a time.
PIECE = 1 << 20
#: Words whose ids a task remembers; beyond it starts anew.
MEMORY = 200_000

# What a byte-level vocabulary keeps apart from the word before it, after an apostrophe.
SHORT = ("s", "t", "m", "d", "re", "ve", "ll")
# Letters and numbers of Unicode 16, which the vocabulary's own library follows, that are not in
# version 15.1 (first, last).
LETTERS_16 = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
              (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
              (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
              (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
#: A place where a word ends whatever is around it: one space between others.
PLAIN_END = re.compile(r"[^\s\x1c-\x1f](?= [^\s\x1c-\x1f])")

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
_NONE = np.iinfo(np.int32).max


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary: itself if it is visible, else the next
    one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """The tables of a byte-level BPE file in the format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        odd = [x for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
               if model.get(x)]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or odd:
            raise ValueError(f"{path} is no plain byte-level BPE {odd}")
        byte_of = _byte_characters()
        vocab = model["vocab"]
        added = {a["content"]: a for a in spec["added_tokens"]}
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added.values()):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.added = {c: a["id"] for c, a in added.items()}
        self.added_at = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

        tokens = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        tokens |= {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in self.added.items()}
        #: bytes of all tokens, one after the other, and where each id's begin and end
        size = np.zeros(max(tokens) + 1, np.int64)
        for i, b in tokens.items():
            size[i] = len(b)
        self.end = np.cumsum(size)
        self.begin = self.end - size
        self.bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, into = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges)))
        key = left << 32 | right
        key, first = np.unique(key, return_index=True)  # sorted; the first of equal ones ranks
        self.key, self.rank, self.into = key, first.astype(np.int32), into[first]
        self.symbol = np.array([vocab[c] for c in sorted(byte_of, key=byte_of.get)], np.int64)
        self.meet = np.zeros((256, 256), bool)
        for t in vocab:
            b = tokens[vocab[t]]
            for x, y in zip(b, b[1:]):
                self.meet[x, y] = True

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs in the sorted keys, and which of them are there."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        return at, self.key[at] == pair

    def merge(self, raw: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words whose bytes follow each other in ``raw``, beginning at ``start``, and the place of
        each id's first byte."""
        out = np.full(len(raw), -1, np.int64)
        new = np.zeros(len(raw), bool)
        new[start] = True
        new[1:] |= ~self.meet[raw[:-1], raw[1:]]
        part, at, symbol = np.cumsum(new), np.arange(len(raw)), self.symbol[raw]
        rank = np.full(len(raw), _NONE, np.int32)  # of the pair that a symbol makes with the next one
        look = np.flatnonzero(~new[1:])
        while True:
            place, found = self._found(symbol[look], symbol[look + 1])
            rank[look] = np.where(found, self.rank[place], _NONE)
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else look
            if not len(first):
                break
            size = np.diff(np.r_[first, len(part)])
            lowest = np.minimum.reduceat(rank, first)
            keep = np.repeat(lowest != _NONE, size)
            out[at[~keep]] = symbol[~keep]
            here = np.flatnonzero(keep & (rank == np.repeat(lowest, size)))
            if len(here) > 1:  # x x x: pairs that overlap, every other one
                run = np.r_[True, np.diff(here) > 1]
                begin = here[np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))]
                here = here[(here - begin) % 2 == 0]
            symbol[here] = self.into[self._found(symbol[here], symbol[here + 1])[0]]
            rank[here] = _NONE
            keep[here + 1] = False
            there = np.cumsum(keep)[here] - 1
            symbol, at, part, rank = symbol[keep], at[keep], part[keep], rank[keep]
            anew = np.zeros(len(part), bool)  # pairs that a new symbol is part of
            anew[there] = True
            anew[there[there > 0] - 1] = True
            look = np.flatnonzero(anew[:-1] & (part[1:] == part[:-1]))
        place = np.flatnonzero(out >= 0)
        return out[place], place

    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``, one after the other."""
        known = ids[(ids >= 0) & (ids < len(self.end))]
        begin, size = self.begin[known], self.end[known] - self.begin[known]
        stop = np.cumsum(size)
        if not len(stop):
            return b""
        return self.bytes[np.arange(stop[-1]) + np.repeat(begin - stop + size, size)].tobytes()


@functools.lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, and BREAK for one more that is none."""
    out = np.zeros(0x110001, np.uint8)
    major = {"L": LETTER, "N": NUMBER, "Z": SPACE}
    for c in range(0x110000):
        out[c] = major.get(unicodedata.category(chr(c))[0], OTHER)
    for c in (*range(9, 14), 0x85):
        out[c] = SPACE
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            out[first:last + 1] = kind
    out[0x110000] = BREAK
    return out


def words_of(text: str) -> list[str]:
    """``text`` cut into words: runs of letters, of numbers, of spaces or of other characters, each with the
    one plain space before it; the last of several spaces goes with, or stands before, what follows; after an
    apostrophe that begins a word, the endings ``SHORT`` make a word with it."""
    if not text:
        return []
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[np.r_[code, 0x110000]]
    begins = np.r_[True, kind[1:] != kind[:-1]]  # the end of the text begins a word that is left out
    after = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != BREAK)) + 1
    begins[after - 1] = True
    begins[after[code[after - 1] == 0x20]] = False
    quote = np.flatnonzero(code == 0x27)
    quote = quote[begins[quote]]
    if len(quote):
        code = np.r_[code, 0, 0]
        one, two = code[quote + 1], code[quote + 2]
        for ending in SHORT:
            x = list(map(ord, ending))
            at = quote[(one == x[0]) & (two == x[-1] if len(x) > 1 else True)]
            begins[at + 1] = False
            begins[at + 1 + len(x)] = True
    edge = np.flatnonzero(begins).tolist()
    return [text[a:b] for a, b in zip(edge, edge[1:])]


@functools.lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pieces(text: str, most: int) -> Iterator[str]:
    """``text`` cut where words end, in parts of about ``most`` characters (longer ones where it has no
    single space between other characters)."""
    at = 0
    while len(text) - at > most:
        m = PLAIN_END.search(text, at + most - 1)
        if not m:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:] if at else text


class Encoder:
    """Ids of texts; remembers the words it has met."""

    def __init__(self, vocab: Vocabulary, piece: int = PIECE, memory: int = MEMORY):
        self.vocab, self.piece, self.memory = vocab, piece, memory
        self._forget()

    def _forget(self) -> None:
        self.number = {c: i for i, c in enumerate(self.vocab.added)}
        self.ids = np.array(list(self.vocab.added.values()), np.uint32)
        self.end = np.arange(1, len(self.ids) + 1)

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        start = np.cumsum(size) - size
        ids, place = self.vocab.merge(np.frombuffer(b"".join(raw), np.uint8), start)
        ends = np.searchsorted(place, start + size)  # ids up to each word's end
        known = len(self.number)
        self.number.update(zip(words, range(known, known + len(words))))
        self.end = np.concatenate([self.end, len(self.ids) + ends])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def _words(self, text: str) -> Iterator[list[str]]:
        """Words and added tokens of a text, by piece.  A word never equals an added token: those hold
        letters beside other characters."""
        at = 0
        for m in self.vocab.added_at.finditer(text) if self.vocab.added_at else ():
            yield from map(words_of, pieces(text[at:m.start()], self.piece))
            yield [m[0]]
            at = m.end()
        yield from map(words_of, pieces(text[at:] if at else text, self.piece))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.  What stands in the
        batch's texts is encoded in one go, up to about ``piece`` characters."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        n = 0
        for row, text in enumerate(texts):
            for words in self._words(text or ""):
                held.append((row, words))
                n += len(words)
                if n >= self.piece // 4:
                    self._flush(held, out)
                    held, n = [], 0
        self._flush(held, out)
        return [b"".join(x) for x in out]

    def _flush(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if len(self.number) > self.memory:
            self._forget()
        fresh = set().union(*(words for _, words in held)).difference(self.number)
        if fresh:
            self._learn(list(fresh))
        for row, words in held:
            number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
            if not len(number):
                continue
            stop = self.end[number]
            size = stop - np.where(number > 0, self.end[number - 1], 0)
            total = np.cumsum(size)
            out[row].append(self.ids[np.arange(total[-1]) + np.repeat(stop - total, size)].astype("<u4").tobytes())


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (binary: little-endian unsigned 32-bit integers) of every row."""
    where = path or tokenizer_path()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(where))
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(encoder(b.column("text").to_pylist()), pa.binary())],
                                             names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (as ``encode`` returns it) with the ``text`` of the ids; null ids give an empty text."""
    where = path or tokenizer_path()
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def text_of(ids: bytes | None) -> str:
        vocab, n = vocabulary(where), 4 * PIECE
        parts = (vocab.decoded(np.frombuffer(ids[at:at + n], "<u4").astype(np.int64)) for at in range(0, len(ids or b""), n))
        return b"".join(parts).decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ids"):
            ids = b.column("ids")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.array(map(text_of, ids.to_pylist()), pa.string(), size=len(ids))],
                                             names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")

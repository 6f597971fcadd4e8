"""Token ids of documents in Re-Pair compressed shards, and random access to them.

Every text is tokenized whole, an end id is appended, and the ids of all documents in ascending ``doc_id`` order
(nulls first) are cut into shards of whole documents. Per shard, Re-Pair replaces frequent adjacent id pairs by
new symbols, round after round, until no pair occurs ``min_count`` times: each round takes every pair that does, and
where chosen pairs overlap, the leftmost wins. A shard stores its rules, the length each rule expands to, and the remaining
sequence, so a range of ids is decoded from the symbols that cover it.

Work per task is one range of documents; a shard ends once it holds ``shard_tokens`` ids, so what a task holds is
bounded by that and the longest document. Only one number per range of documents reaches the driver.

Defined results: a null or empty text is its end id alone; rows with equal ids keep separate entries, in the order
of their first 64 characters and then of a hash of the text; an empty table gives no shards; other columns are not read.

A shard file, little endian: ``RPG1``; uint64 documents, rules, symbols, ids, base (ids below it are tokens);
uint8 bytes per symbol; per document int64 doc_id, uint8 null flag, uint64 end of its ids; per rule uint32 left,
uint32 right, uint64 expansion length; the symbols.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import map_batches, stage

_MAGIC = b"RPG1"
_HEADER = "<4s5QB"
_SPLIT = "<|startoftext|>"
#: Words that are encoded as one string.
_PIECE = 500
#: Letters that stay one letter in lower case; words of them become the same ids wherever they stand.
_PLAIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
#: A word of such letters, and signs behind it that are one piece of their own; quotes and what special tokens are made
#: of are left to the library.
_PARTS = re.compile(rf"([{_PLAIN}]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{{}}~]+)?").fullmatch
_PLAIN_WORDS = re.compile(f"[{_PLAIN} ]+").fullmatch


@dataclass(frozen=True)
class Settings:
    """``tokenizer`` is the path of a file of the tokenizers library."""

    tokenizer: str
    end_id: int = 2
    shard_tokens: int = 1 << 19
    min_count: int = 16
    cached_words: int = 1_000_000


class WordTokenizer:
    """Ids of texts, encoded once per word.

    For tokenizers like ``word_bpe_49k.json``: lower case, no token crosses white space or joins letters to a mark.
    """

    def __init__(self, path: str, cached_words: int):
        from tokenizers import Tokenizer

        # Tasks are parallel already; threads of its own cost each worker a heap per thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._split_id = self._tokenizer.token_to_id(_SPLIT)
        self._limit = cached_words
        self.base = self._tokenizer.get_vocab_size()
        self._ends_word = np.zeros(self.base, bool)
        self._ends_word[[i for token, i in self._tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self._codes = _Codes()
        self._lengths = np.zeros(0, np.int64)
        self._starts = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of ASCII letters, which no rule splits or rewrites: merges are all there is to do."""
        tokenize = self._tokenizer.model.tokenize
        ids, lengths = [], []
        for at in range(0, len(words), 10 * _PIECE):
            found = [[token.id for token in tokenize(word)] for word in map(str.lower, words[at : at + 10 * _PIECE])]
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int32, int(lengths[-1].sum())))
        return np.concatenate(ids), np.concatenate(lengths)

    def _encode_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        if _PLAIN_WORDS(" ".join(words)) and "" not in words:
            ids = self._joined(" ", words)
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            if len(ends) == len(words):
                return ids, np.diff(ends, prepend=0)
        if any(_SPLIT in word for word in words):
            each = [np.array(self._joined("", [word])) for word in words]
            return np.concatenate(each), np.array([len(ids) for ids in each])
        ids = self._joined(_SPLIT, words)
        is_split = ids == self._split_id
        return ids[~is_split], np.diff(np.flatnonzero(np.append(is_split, True)), prepend=-1) - 1

    def _joined(self, by: str, words: list[str]) -> np.ndarray:
        # One long string costs more than the same in pieces. A piece ends with what joins it to the next.
        pieces = [words[at : at + _PIECE] for at in range(0, len(words), _PIECE)]
        texts = [by.join(piece) + by for piece in pieces[:-1]] + [by.join(piece) for piece in pieces[-1:]]
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.concatenate([np.array(e.ids, np.int32) for e in found])

    def _learn(self) -> None:
        """Find the ids of new words. A word of plain letters with signs behind it is made of its two parts."""
        new, first = self._codes.new, len(self._lengths)
        letters: list[int] = []
        more_letters: list[int] = []
        others: list[int] = []
        composed: list[tuple[int, int, int]] = []
        at = 0
        while at < len(new):
            word = new[at]
            parts = _PARTS(word)
            if parts is None:
                others.append(at)
            elif parts[2]:
                composed.append((first + at, self._codes[parts[1]], self._codes[parts[2]]))
            else:
                (letters if word.isascii() else more_letters).append(at)
            at += 1
        self._starts = np.append(self._starts, np.zeros(len(new), np.int64))
        self._lengths = np.append(self._lengths, np.zeros(len(new), np.int64))
        encoders = (self._encode_letters, self._encode_all, self._encode_all)
        for group, encode in zip((letters, more_letters, others), encoders, strict=True):
            if group:
                ids, lengths = encode([new[i] for i in group])
                self._add(np.array(group) + first, ids, lengths)
        if composed:
            codes, *parts = np.array(composed).T
            parts = np.stack(parts, axis=1)
            lengths = self._lengths[parts]
            self._add(codes, self._ids[_spans(self._starts[parts].ravel(), lengths.ravel())], lengths.sum(axis=1))
        self._codes.new = []

    def _add(self, codes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._starts[codes] = len(self._ids) + np.cumsum(lengths) - lengths
        self._lengths[codes] = lengths
        self._ids = np.concatenate([self._ids, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each text has; null is empty."""
        if len(self._codes) > self._limit:
            self._reset()
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # may hold special tokens, which are in lower case
            texts = pc.ascii_lower(texts)
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        numbered = words.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        codes = np.fromiter(map(self._codes.__getitem__, distinct), np.int64, len(distinct))
        if self._codes.new:
            self._learn()
        codes = codes[numbered.indices.to_numpy()]
        lengths = self._lengths[codes]
        before = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(sizes))]
        return self._ids[_spans(self._starts[codes], lengths)], np.diff(before)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start`` to ``start + length`` of every span, in a row."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    return at


class _Codes(dict):
    """Numbers words as they come; ``new`` lists those that nothing is known of yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


def compress(ids: np.ndarray, base: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(rules, symbols)``: rule ``i`` is the pair of symbols that ``base + i`` stands for.

    A round replaces every pair that occurs ``min_count`` times, until none does. Where chosen pairs overlap the
    leftmost wins, and what loses is torn apart, so only pairs with a symbol of the last round can be frequent next.
    """
    symbols = ids.astype(np.int64)
    rules: list[np.ndarray] = []
    top = base
    places = np.arange(len(symbols) - 1)
    while len(places) >= min_count:
        pairs, number = _frequent((symbols[places] << 32) | symbols[places + 1], min_count)
        if not len(pairs):
            break
        chosen = number >= 0
        hits, number = places[chosen], number[chosen]
        breaks = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
        run_start = np.repeat(hits[breaks], np.diff(np.append(breaks, len(hits))))
        first = ((hits - run_start) & 1) == 0
        hits, number = hits[first], number[first]
        symbols[hits] = top + number
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        symbols = symbols[keep]
        rules.append(np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1))
        new = hits - np.arange(len(hits))  # where the new symbols are now
        top += len(pairs)
        around = np.zeros(len(symbols) + 1, bool)
        around[new] = around[new - 1] = True  # the place before the first one is the spare last one
        places = np.flatnonzero(around[: len(symbols) - 1])
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)), symbols


_SLOT_BITS = 18


def _frequent(keys: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur often enough, and for each place the number of its key among them, or -1."""
    number = np.full(len(keys), -1, np.int64)
    found: list[np.ndarray] = []
    total, turn = 0, 0
    left = np.arange(len(keys))
    own = keys
    while len(left) >= min_count:
        if len(left) < 1 << 12:
            values, at, counts = np.unique(own, return_inverse=True, return_counts=True)
            often = counts >= min_count
            number[left] = np.where(often, total + np.cumsum(often) - 1, -1)[at]
            found.append(values[often])
            break
        # Counts by slot; of the keys that share a slot one is counted, and the others go on to the next turn.
        slots = ((own ^ (own >> np.int64(29 + turn))) * np.int64(-7046029254386353131 + 2 * turn)) >> (64 - _SLOT_BITS)
        slots &= (1 << _SLOT_BITS) - 1
        counts = np.bincount(slots, minlength=1 << _SLOT_BITS)
        maybe = np.flatnonzero(counts[slots] >= min_count)
        left, own, slots = left[maybe], own[maybe], slots[maybe]
        owner = np.zeros(1 << _SLOT_BITS, np.int64)
        owner[slots] = own
        is_owner = owner[slots] == own
        counts = np.bincount(slots[is_owner], minlength=1 << _SLOT_BITS)
        often = np.flatnonzero(counts >= min_count)
        name = np.full(1 << _SLOT_BITS, -1, np.int64)
        name[often] = total + np.arange(len(often))
        number[left[is_owner]] = name[slots[is_owner]]
        found.append(owner[often])
        total += len(often)
        left, own = left[~is_owner], own[~is_owner]
        turn += 1
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), number


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Length that each rule expands to; the parts of a rule are tokens or earlier rules."""
    lengths = np.ones(len(rules), np.int64)
    done = 0
    while done < len(rules):
        ready = int(np.argmax(np.append(rules[done:].max(axis=1) >= base + done, True)))
        part = rules[done : done + ready]
        if not ready:
            raise ValueError("a rule refers to a later one")
        lengths[done : done + ready] = np.where(part >= base, lengths[np.maximum(part - base, 0)], 1).sum(axis=1)
        done += ready
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    while True:
        is_rule = symbols >= base
        if not is_rule.any():
            return symbols
        at = np.cumsum(np.where(is_rule, 2, 1))
        out = np.empty(int(at[-1]), symbols.dtype)
        start = at - np.where(is_rule, 2, 1)
        pairs = rules[symbols[is_rule] - base]
        out[start[~is_rule]] = symbols[~is_rule]
        out[start[is_rule]] = pairs[:, 0]
        out[start[is_rule] + 1] = pairs[:, 1]
        symbols = out


def pack(doc_ids: Sequence[int | None], sizes: np.ndarray, ids: np.ndarray, base: int, settings: Settings) -> bytes:
    rules, symbols = compress(ids, base, settings.min_count)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    head = struct.pack(_HEADER, _MAGIC, len(doc_ids), len(rules), len(symbols), len(ids), base, width)
    return b"".join(
        (
            head,
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "<u1").tobytes(),
            np.cumsum(sizes).astype("<u8").tobytes(),
            rules.astype("<u4").T.tobytes(),
            expansion_lengths(rules, base).astype("<u8").tobytes(),
            symbols.astype(f"<u{width}").tobytes(),
        )
    )


class Shard:
    """Random access to one shard file."""

    def __init__(self, data: bytes):
        magic, n_docs, n_rules, n_symbols, self.n_ids, self.base, width = struct.unpack_from(_HEADER, data)
        if magic != _MAGIC:
            raise ValueError("not a shard")
        at = struct.calcsize(_HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes
            return part

        ids, nulls = take("<i8", n_docs), take("<u1", n_docs)
        self.doc_ids = [None if gone else int(d) for d, gone in zip(ids, nulls, strict=True)]
        self.ends = take("<u8", n_docs).astype(np.int64)
        self.rules = take("<u4", 2 * n_rules).reshape(2, n_rules).T.astype(np.int64)
        lengths = take("<u8", n_rules).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols)
        # What every symbol stands for, all in a row: tokens themselves, then the rules written out.
        self._sizes = np.append(np.ones(self.base, np.int64), lengths)
        self._places = np.cumsum(self._sizes) - self._sizes
        written_out = expand(np.arange(self.base, self.base + n_rules), self.rules, self.base)
        self._ids = np.append(np.arange(self.base), written_out).astype(np.uint32)
        self._symbol_ends = np.cumsum(self._sizes[self.symbols])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard, from the symbols that cover them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self._symbol_ends, start, "right"))
        last = int(np.searchsorted(self._symbol_ends, end, "left"))
        before = int(self._symbol_ends[first - 1]) if first else 0
        covering = self.symbols[first : last + 1]
        whole = self._ids[_spans(self._places[covering], self._sizes[covering])]
        return whole[start - before : end - before]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


_SHARDS = pa.schema(
    [
        ("range", pa.int32()), ("shard", pa.int32()), ("start_in_range", pa.int64()),
        ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary()),
    ]
)


def write_shards(docs: DataFrame, settings: Settings) -> DataFrame:
    """One row per shard file, in a table of the shared folder; ``range`` and ``shard`` number them in order."""

    def run(parts: Iterator[dict[str, pa.Array]]) -> Iterator[dict]:
        tokenizer = WordTokenizer(settings.tokenizer, settings.cached_words)
        part_id = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = start = shard = 0

        def close() -> dict:
            data = pack(doc_ids, np.concatenate(sizes), np.concatenate(ids), tokenizer.base, settings)
            return {
                "range": [part_id], "shard": [shard], "start_in_range": [start],
                "n_docs": [len(doc_ids)], "n_ids": [held], "data": [data],
            }

        for part in parts:
            tokens, counts = tokenizer.encode(part["text"])
            ends = np.cumsum(counts)
            tokens = np.insert(tokens, ends, settings.end_id)
            doc_ids += part["doc_id"].to_pylist()
            sizes.append(counts + 1)
            ids.append(tokens)
            held += len(tokens)
            if held >= settings.shard_tokens:
                yield close()
                start, shard = start + held, shard + 1
                doc_ids, sizes, ids, held = [], [], [], 0
        if doc_ids:
            yield close()

    # Rows of one id, or without one, may be many: their texts, and for equal rows their places, part them too.
    keys = [F.col("doc_id"), F.substring("text", 1, 64), F.xxhash64("text"), F.xxhash64(F.monotonically_increasing_id())]
    names = ["doc_id", "__head", "__hash", "__place"]
    keyed = docs.select("doc_id", "text").select("text", *[key.alias(name) for key, name in zip(keys, names, strict=True)])
    ordered = keyed.repartitionByRange(*names).sortWithinPartitions(*names)
    return stage(map_batches(ordered, ["doc_id", "text"], run, _SHARDS, rows=512, arrow=True), "token-shards")


_DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def range_starts(shards: DataFrame) -> dict[int, int]:
    """How many ids come before each range; one number per shuffle partition."""
    totals = shards.groupBy("range").agg(F.sum("n_ids").alias("n")).orderBy("range").collect()
    starts, total = {}, 0
    for row in totals:
        starts[row["range"]] = total
        total += row["n"]
    return starts


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shards."""
    starts = range_starts(shards)

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            for of_range, start, data in zip(part["range"], part["start_in_range"], part["data"], strict=True):
                shard = Shard(data)
                ids = shard.ids(0, shard.n_ids).astype("<u4").tobytes()
                begins = np.append(0, shard.ends[:-1])
                yield {
                    "doc_id": shard.doc_ids,
                    "start": begins + starts[of_range] + start,
                    "n_tokens": shard.ends - begins,
                    "ids_crc32": [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins, shard.ends, strict=True)],
                }

    return map_batches(shards, ["range", "start_in_range", "data"], run, _DOCUMENTS, rows=1)

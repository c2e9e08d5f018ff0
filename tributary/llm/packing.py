"""Packing of tokenised examples into sequences as vector bins.

An example needs tokens, a segment and loss-bearing tokens; a sequence has a limit on each of the three. pack() keeps a
window of open examples and fills one sequence at a time: of the examples that fit, it takes the one with the largest dot
product of its needs and what is still free, both as shares of the limits. Examples longer than a sequence are cut into
whole sequences first. When nothing fits and cutting is allowed, the best example is cut so that it fills the sequence.
A sequence that stays short when a window is used up goes on in the next window; that of an input partition's last window
is cut into lengths that are powers of two, which need no padding, and so is one that is short as it has reached another
limit.

Packing is local to an input partition, so nothing is shuffled and no task holds more than one window of examples. Null
and empty texts are examples of one token, the end token. Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MAX_TOKENS, MAX_SEGMENTS, END = 4096, 256, 2
#: Open examples of a window; a window is packed when it is full.
OPEN = 4096
#: Words whose tokens a worker keeps, and half as many as the pieces of words that it keeps.
CACHE = 150_000


class Packer:
    """Places examples; finished sequences are lists of (key, start, length)."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, cut: bool = True) -> None:
        self.limits = np.array([max_tokens, max_segments, max_loss or max_tokens], float)
        self.cut = cut
        #: The unfinished sequence of the last call: key, start, tokens and loss-bearing tokens of each example's end.
        self.rest: list[tuple[int, int, int, int]] = []

    def pack(self, examples: list[tuple[int, int, int]], final: bool = True) -> Iterator[list[tuple[int, int, int]]]:
        """examples: key, tokens, and how many of the last tokens bear loss. A call that is not final may leave a rest."""
        limit, segments, most = (int(x) for x in self.limits)
        whole = min(limit, most)
        keys, at, left, loss = [], [], [], []
        self.rest = []
        for key, tokens, bearing in examples:
            start = 0
            if tokens > limit or bearing > most:
                if not self.cut:
                    raise ValueError(f"example {key} exceeds a limit")
                while tokens - start > whole:
                    yield [(key, start, whole)]
                    start += whole
            keys.append(key)
            at.append(start)
            left.append(tokens - start)
            loss.append(min(bearing, tokens - start))
        # Equal needs are interchangeable: one list of examples for each pair of needs.
        kinds: dict[tuple[int, int], list[int]] = {}
        for k in range(len(keys) - 1, -1, -1):
            if left[k]:
                kinds.setdefault((left[k], loss[k]), []).append(k)
        needs = np.array(sorted(kinds), float).reshape(-1, 2)
        members = [kinds[t, b] for t, b in sorted(kinds)]
        stock = np.array([len(m) for m in members])
        while stock.any():
            free = self.limits.copy()
            sequence: list[tuple[int, int, int]] = []
            borne: list[int] = []
            while free.min() > 0 and stock.any():
                fits = (stock > 0) & (needs[:, 0] <= free[0]) & (needs[:, 1] <= free[2])
                share = free / self.limits
                worth = needs[:, 0] / self.limits[0] * share[0] + needs[:, 1] / self.limits[2] * share[2] + share[1] / self.limits[1]
                if fits.any():
                    kind = int(np.argmax(np.where(fits, worth, -1)))
                    # As many of the kind as fit while it stays the best: large examples go in one by one.
                    k = members[kind].pop()
                    stock[kind] -= 1
                    sequence.append((keys[k], at[k], left[k]))
                    borne.append(loss[k])
                    free -= [needs[kind, 0], 1, needs[kind, 1]]
                    continue
                if not self.cut:
                    break
                kind = int(np.argmax(np.where(stock > 0, worth, -1)))
                k = members[kind].pop()
                stock[kind] -= 1
                # The loss-bearing tokens come last, so a piece from the front has what the rest does not.
                piece = int(min(free[0], left[k]))
                bearing = max(0, loss[k] - (left[k] - piece))
                if bearing > free[2]:
                    piece -= int(bearing - free[2])
                    bearing = int(free[2])
                sequence.append((keys[k], at[k], piece))
                borne.append(bearing)
                free -= [piece, 1, bearing]
                at[k], left[k], loss[k] = at[k] + piece, left[k] - piece, min(loss[k] - bearing, left[k] - piece)
                if left[k]:
                    row = np.array([left[k], loss[k]], float)
                    same = np.flatnonzero((needs == row).all(axis=1))
                    if len(same):
                        members[same[0]].append(k)
                        stock[same[0]] += 1
                    else:
                        needs, stock = np.vstack([needs, row]), np.append(stock, 1)
                        members.append([k])
            total = sum(n for _, _, n in sequence)
            if total == limit:
                yield sequence
            elif not final and free.min() > 0 and not stock.any():
                self.rest = [(*piece, b) for piece, b in zip(sequence, borne)]
            elif not self.cut:
                yield sequence
            else:
                yield from powers_of_two(sequence, total)


def powers_of_two(sequence: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """The same pieces cut into sequences whose lengths are the powers of two that make up the total, largest first."""
    pieces = iter(sequence)
    key, start, length = next(pieces)
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        room, part = 1 << bit, []
        while room:
            take = min(room, length)
            part.append((key, start, take))
            start, length, room = start + take, length - take, room - take
            if not length:
                key, start, length = next(pieces, (None, 0, 0))
        yield part


#: What a worker keeps from one task to the next, by tokenizer.
_KEPT: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {}


class WordTokens:
    """Token ids of a text as little-endian 32-bit bytes, equal to the tokenizer's own.

    A tokenizer of the form NORMALIZER, PRE_TOKENIZER and BPE with word ends never joins what white space separates, so
    each white-space delimited word is tokenised once and kept. A word of letters with marks at its end is two pieces for
    the tokenizer's model; other words take the tokenizer's whole way, and so do texts with white space other than the
    plain kinds or with a special token's string. A tokenizer of any other form is given whole texts.
    """

    # The form of the tokenizer whose words are kept: fixed values.
    NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
    SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
    PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [SPLIT, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

    WHOLE = re.compile(r"<\||[^\S \t\n\r]")
    #: Marks that split off a word as one piece; an apostrophe may start a contraction.
    MARKS = ".,;:!?|*#%&$\"()+-=/"

    def __init__(self, path: str, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.kept, self.pieces = _KEPT.setdefault(path, ({}, {}))
        self.model = self.tokenizer.model
        form = json.loads(self.tokenizer.to_str())
        self.by_word = (
            (form["normalizer"], form["pre_tokenizer"], form["model"]["type"], form["model"]["end_of_word_suffix"]) == (self.NORMALIZER, self.PRE_TOKENIZER, "BPE", "</w>")
            and not form["model"]["dropout"]
            and all(t["content"].startswith("<|") for t in form["added_tokens"])
        )
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from code point 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        self.alphabet = [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        """Ids of letters in lower case, or of marks: what the model sees as one piece."""
        shown = piece if piece.isascii() else "".join([self.alphabet[b] for b in piece.encode()])
        ids = array("I", [t.id for t in self.model.tokenize(shown)])
        if sys.byteorder == "big":
            ids.byteswap()
        found = ids.tobytes()
        if len(self.pieces) < 2 * self.cache:
            self.pieces[piece] = found
        return found

    def _word(self, word: str) -> bytes:
        core = word.rstrip(self.MARKS)
        low = core.lower()
        found = self.pieces.get(low) if core.isascii() else None
        if found is None:
            if not (low.isalpha() and (core.isascii() or core.isalpha() and "\u03a3" not in core and unicodedata.is_normalized("NFC", core))):
                return self._encode([word])[0]
            found = self.pieces.get(low) or self._piece(low)
        if len(core) == len(word):
            return found
        marks = word[len(core) :]
        return found + (self.pieces.get(marks) or self._piece(marks))

    def _new(self, word: str) -> bytes:
        """Kept while there is room: words that come early and often stay, rare ones are tokenised where they stand."""
        ids = self._word(word)
        if len(self.kept) < self.cache:
            self.kept[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if not self.by_word or self.WHOLE.search(text):
            return self._encode([text])[0]
        found = text.split()
        parts = list(map(self.kept.get, found))
        if None in parts:
            for k, part in enumerate(parts):
                if part is None:
                    parts[k] = self._new(found[k])
        return b"".join(parts)


PIECES = "id bigint, start bigint, length bigint, ids binary, tokens bigint, sequence_id bigint, offset bigint"


def _pack_batches(batches: Iterator[pa.RecordBatch], ids_of: Callable[[], Callable], end: int, make: Callable[[], Packer], window: int, prompts: bool) -> Iterator[pa.RecordBatch]:
    encode, packer, end_bytes = ids_of(), make(), struct.pack("<I", end)
    sequence = TaskContext.get().partitionId() << 40
    names = ["id", "start", "length", "ids", "tokens", "sequence_id", "offset"]
    #: Open examples: id, ids that are left, how many went before, tokens in all, tokens that bear loss.
    held: list[tuple[int | None, bytes, int, int, int]] = []

    def flush(final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal sequence
        rows: list[list] = [[] for _ in names]
        size = 0
        for pieces in packer.pack([(k, len(ids) // 4, bearing) for k, (_, ids, _, _, bearing) in enumerate(held)], final):
            offset = 0
            for k, start, length in pieces:
                doc, ids, before, tokens, _ = held[k]
                for column, value in zip(rows, (doc, before + start, length, ids[4 * start : 4 * (start + length)], tokens, sequence, offset)):
                    column.append(value)
                offset += length
                size += 4 * length
            sequence += 1
            if size > 8 << 20:
                yield record(rows)
                rows, size = [[] for _ in names], 0
        if rows[0]:
            yield record(rows)
        # Nothing in an unfinished sequence is cut at its end: an example that is cut fills its sequence.
        held[:] = [(held[k][0], held[k][1][4 * start :], held[k][2] + start, held[k][3], bearing) for k, start, _, bearing in packer.rest]

    def record(rows: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)

    size = 0
    for batch in batches:
        texts = batch.column(1)
        for k, doc in enumerate(batch.column(0).to_pylist()):
            ids = encode(texts[k].as_py() or "") + end_bytes
            prompt = len(encode(batch.column(2)[k].as_py() or "")) // 4 if prompts else 0
            tokens = len(ids) // 4
            held.append((doc, ids, 0, tokens, max(1, tokens - prompt)))
            size += len(ids)
            if len(held) >= window or size > 64 << 20:
                yield from flush(False)
                size = 0
    if held:
        yield from flush(True)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    end: int = END,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    window: int = OPEN,
    cache: int = CACHE,
) -> DataFrame:
    """A row per piece: id, start, length, ids (32-bit, little-endian), tokens of the example, sequence_id, offset.

    The text is the whole example and, with prompt_col, starts with the prompt, whose tokens bear no loss. tokenizer is a
    path that every executor can read, or a file name of the public_tokenizers package.
    """
    columns = [F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")]
    columns += [F.col(prompt_col).cast("string").alias("prompt")] if prompt_col else []

    def ids_of() -> WordTokens:
        path = tokenizer
        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        return WordTokens(path, cache)

    def make() -> Packer:
        return Packer(max_tokens, max_segments, max_loss)

    return docs.select(*columns).mapInArrow(lambda batches: _pack_batches(batches, ids_of, end, make, window, bool(prompt_col)), PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces as doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"), "sequence_id", "offset")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return digests(pack(common.table(spark, sf_dir, "documents"), "word_bpe_49k.json"))

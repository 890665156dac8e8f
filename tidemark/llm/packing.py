"""Packing token sequences by minimum bin slack.

Documents are tokenised and followed by one end token. Whole windows of ``capacity`` tokens are cut off a
document as they are; the tails that remain (shorter than a window) are packed in groups of at most
``group`` tails: for each window a subset-sum programme over a bitset finds the multiset of
remaining lengths that, with the longest remaining tail, comes closest to the capacity. Backtracking gives how often
each length is used, and the multiset is used for as many windows as the stock allows. Slack that no
multiset can fill is filled with a cut of the next tail. What is left at the end of a group is shorter than
a window; it is cut into sequences whose lengths are powers of two. So nothing is padded.

One pass, no shuffle: a group is made of consecutive rows of one scan task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import Memo, map_rows, per_process

CAPACITY = 2048
END_ID = 1
GROUP = 4096
#: Bytes of a text that are tokenised at a time, and of texts that are tokenised together.
SLICE, TOGETHER = 1 << 20, 1 << 18

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Between a letter and punctuation that neither composes with other characters nor occurs in special strings or contractions.
_POINT = re.compile(rb"(?<=[a-z])(?=[!-&(-/:;?@])")


def word_ids(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """A function for the ids of words as little-endian 32-bit numbers, by the library, for a tokenizer that drops white space.

    Cutting at ASCII white space cannot change the ids: the tokenizer's normalizer works per character (blanks are
    starters that compose with nothing), its pre-tokenizer never matches across white space, and its
    special strings hold none.
    """

    def make() -> Callable[[list[bytes]], list[bytes]]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def ids(words: list[bytes]) -> list[bytes]:
            """Many words cost one call: they are one text, cut where the words begin."""
            text = b" ".join(words).decode()
            found = tokenizer.encode(text, add_special_tokens=False)
            data = np.array(found.ids, "<u4").tobytes()
            starts = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(data) // 4)
            sizes = np.fromiter(map(len, words if text.isascii() else text.split(" ")), np.int64, len(words))
            cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes + 1)])).tolist()
            return [data[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]

        memo = Memo(lambda word: ids([word])[0])

        def ids_of(words: list[bytes]) -> list[bytes]:
            found = list(map(memo.get, words))
            if None in found:
                places = [i for i, x in enumerate(found) if x is None]
                fresh = memo.recalled(words[i] for i in places)
                new = list({words[i] for i in places} - fresh.keys())
                for i in range(0, len(new), 1024):
                    fresh |= zip(new[i : i + 1024], ids(new[i : i + 1024]), strict=True)
                memo.fill(fresh)
                for i in places:
                    found[i] = fresh[words[i]]
            return found

        return ids_of

    return per_process(("word_ids", path), make)


def folded(part: bytes) -> bytes:
    """A-Z in lower case, where that cannot change the ids: the tokenizer does the same after composing characters.

    Left alone if a special string or a combining mark (U+0300 to U+036F) might be in the part.
    """
    return part if b"<|" in part or b"\xcc" in part or b"\xcd" in part else part.lower()


def words_of(part: bytes) -> list[bytes]:
    """The words of a part, without punctuation behind a letter, which is a word of its own: fewer words are to be remembered.

    No piece that the tokenizer's pre-tokenizer matches has a letter before such a character, so there is a boundary, and it reads from left to right.
    """
    return _POINT.sub(b" ", folded(part)).split()


def slices(data: bytes, size: int = SLICE) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end before a blank, so that huge texts are worked on piece by piece."""
    start = 0
    while start < len(data):
        found = _BLANK.search(data, start + size)
        end = found.start() if found else len(data)
        yield data[start:end]
        start = end


def choose(stock: dict[int, int], target: int) -> dict[int, int]:
    """How often to take each length so that the sum is as near to ``target`` as can be without passing it.

    ``stock`` holds the remaining lengths and how many there are of each. The set of reachable sums is one
    integer used as a bitset; a length with n pieces is added as blocks of 1, 2, 4, ... pieces.
    """
    mask = (1 << (target + 1)) - 1
    sums, layers = 1, []
    for length in sorted((x for x in stock if x <= target), reverse=True):
        left, block = min(stock[length], target // length), 1
        while left:
            block = min(block, left)
            layers.append((length, block, sums))
            sums |= (sums << (length * block)) & mask
            left -= block
            block *= 2
        if sums >> target & 1:
            break
    at, taken = sums.bit_length() - 1, {}
    for length, block, before in reversed(layers):
        if not before >> at & 1:
            at -= length * block
            taken[length] = taken.get(length, 0) + block
    return taken


def windows(lengths: list[int], capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start within the item, length); every one is full or a power of two long."""
    stock: dict[int, list[tuple[int, int]]] = {}
    for item, length in enumerate(lengths):
        stock.setdefault(length, []).append((item, 0))

    left = {length: len(pieces) for length, pieces in stock.items()}

    def draw(length: int) -> tuple[int, int, int]:
        item, start = stock[length].pop()
        left[length] -= 1
        if not left[length]:
            del stock[length], left[length]
        return item, start, length

    total = sum(lengths)
    while total >= capacity:
        longest = max(left)
        left[longest] -= 1
        taken = choose(left, capacity - longest)
        left[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        slack = capacity - sum(x * n for x, n in taken.items())
        for _ in range(min(left[x] // n for x, n in taken.items()) if not slack else 1):
            out = [draw(x) for x, n in taken.items() for _ in range(n)]
            if slack:  # every remaining tail is longer than the slack: cut one
                item, start, length = draw(max(stock))
                out.append((item, start, slack))
                stock.setdefault(length - slack, []).append((item, start + slack))
                left[length - slack] = left.get(length - slack, 0) + 1
            total -= capacity
            yield out
    rest = [draw(length) for length in sorted(stock, reverse=True) for _ in range(len(stock[length]))]
    for power in range(capacity.bit_length(), -1, -1):
        need = 1 << power
        if total & need:
            out = []
            while need:
                item, start, length = rest.pop()
                part = min(length, need)
                out.append((item, start, part))
                if part < length:
                    rest.append((item, start + part, length - part))
                need -= part
            yield out


def pack(
    df: DataFrame,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group: int = GROUP,
) -> DataFrame:
    """Pieces of all documents with the sequence and offset where each one lies.

    Columns: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset and ``sequence_length``. A null or
    empty text is one end token. Rows are packed one by one: repeated ids or texts are packed as often as they occur, a
    null id is kept. Other columns are ignored. An empty table gives no rows. ``sequence_id`` is
    unique, not gapless; it depends on how the table is cut into tasks.
    """
    schema = T.StructType(
        [T.StructField(id_column, df.schema[id_column].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + [T.StructField("sequence_length", T.LongType())]
    )
    end = np.array([end_id], "<u4").tobytes()

    def start():
        from pyspark import TaskContext

        ids_of = word_ids(tokenizer)
        given: list[tuple] = []  # (id, text) of rows that are tokenised together
        held = 0
        waiting: list[tuple] = []  # (id, tokens before the tail, tokens, ids of the tail)
        number = TaskContext.get().partitionId() << 40

        def next_sequence() -> int:
            nonlocal number
            number += 1
            return number - 1

        def pack_group() -> Iterator[tuple]:
            for pieces in windows([len(w[3]) // 4 for w in waiting], capacity):
                sequence, offset, size = next_sequence(), 0, sum(p[2] for p in pieces)
                for item, at, length in pieces:
                    key, before, tokens, ids = waiting[item]
                    crc = zlib.crc32(ids[4 * at : 4 * (at + length)])
                    yield key, before + at, length, crc, tokens, sequence, offset, size
                    offset += length
            waiting.clear()

        def place(key, parts: Iterable[bytes]) -> Iterator[tuple]:
            buffer, crcs, size = bytearray(), [], 4 * capacity
            for part in parts:
                buffer += part
                whole = len(buffer) // size * size
                crcs += [zlib.crc32(buffer[i : i + size]) for i in range(0, whole, size)]
                del buffer[:whole]
            buffer += end
            if len(buffer) == size:
                crcs.append(zlib.crc32(buffer))
                buffer.clear()
            tokens = len(crcs) * capacity + len(buffer) // 4
            for i, crc in enumerate(crcs):
                yield key, i * capacity, capacity, crc, tokens, next_sequence(), 0, capacity
            if buffer:
                waiting.append((key, len(crcs) * capacity, tokens, bytes(buffer)))
                if len(waiting) >= group:
                    yield from pack_group()

        def place_given() -> Iterator[tuple]:
            nonlocal held
            words = [words_of(data) if len(data) <= TOGETHER else None for _, data in given]
            found = iter(ids_of([w for some in words if some for w in some]))
            for (key, data), some in zip(given, words, strict=True):
                if some is None:
                    yield from place(key, (b"".join(ids_of(words_of(part))) for part in slices(data)))
                else:
                    yield from place(key, [b"".join(islice(found, len(some)))])
            given.clear()
            held = 0

        def call(key, text: str | None) -> Iterator[tuple]:
            nonlocal held
            given.append((key, (text or "").encode()))
            held += len(given[-1][1]) + 1
            if held >= TOGETHER:
                yield from place_given()

        def close() -> Iterator[tuple]:
            yield from place_given()
            yield from pack_group()

        call.close = close
        return call

    return map_rows(df.select(id_column, text_column), schema, start)

"""Token counts, with huge documents encoded in overlapping chunks.

Byte-level BPE never joins characters of different pre-tokens, and its pre-tokenizer reads from left to right: what it
does from a boundary on depends on the text to the right only. No pre-token holds a white space that
follows another character, hence *between a character that is no white space and a white space there is always a
boundary*, in the whole text and in any chunk that holds both. Such places are called stable below.

* A text of more than ``chunk`` characters is encoded in overlapping chunks with offsets. Two neighbours are spliced at
  a stable place where both have a token boundary: the left one counts up to it, the right one from it. If the
  overlap has no such place, it is widened, at last over the whole left chunk.
* A shorter text is cut at its stable places, and between a letter and a comma or full stop (no pre-token holds both).
  The count of a part is taken from the library and remembered.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import Memo, map_rows, per_process

CHUNK = 65_536
OVERLAP = 512

#: Python's white space holds all of Unicode's, so these places are stable for the tokenizer's own rule too.
_CUTS = re.compile(r"(?<=\S)(?=[ \n])|(?<=[a-zA-Z])(?=[.,])")


def stable(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at] in " \n" and not text[at - 1].isspace()


def count_in_chunks(
    starts_of: Callable[[str], list[int]], text: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> int:
    """Tokens of ``text``; ``starts_of`` gives the start offsets of the tokens of a chunk, in order."""
    left, end = 0, min(chunk, len(text))
    starts = starts_of(text[left:end])
    counted, since = 0, 0  # tokens before the place ``since`` are counted
    while end < len(text):
        wide = overlap
        # a left chunk that had to grow is followed by one as long, so that the work stays in proportion to the text
        stop = min(end + max(chunk, end - left), len(text))
        while True:
            begin = max(end - wide, left)
            following = [begin + s for s in starts_of(text[begin:stop])]
            common = {left + s for s in starts}.intersection(following)
            # a boundary is proven only if the left chunk also holds the character after it
            places = [p for p in common if max(begin, since) < p < end and stable(text, p)]
            if places or begin == left:
                break
            wide *= 2
        if places:
            splice = max(places)
            counted += sum(since <= left + s < splice for s in starts)
            since = splice
        # else the new chunk covers the whole left one and takes its place
        left, end, starts = begin, stop, [s - begin for s in following]
    return counted + len(starts) - bisect_left(starts, since - left)


def counter(path: str, chunk: int, overlap: int) -> Callable[[str], int]:
    """A function that counts the tokens of a text with the tokenizer stored at ``path``."""

    def make() -> Callable[[str], int]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        memo = Memo(lambda part: len(tokenizer.encode(part, add_special_tokens=False).ids))

        def starts_of(part: str) -> list[int]:
            return [o[0] for o in tokenizer.encode(part, add_special_tokens=False).offsets]

        def count(text: str) -> int:
            if len(text) > chunk:
                return count_in_chunks(starts_of, text, chunk, overlap)
            return sum(map(memo.__getitem__, _CUTS.split(text)))

        return count

    return per_process(("token_counter", path, chunk, overlap), make)


def token_counts(
    df: DataFrame,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 1024,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every row.

    ``tokenizer`` is the path of a byte-level BPE file, the same on all machines. Null and empty texts have no
    bytes and no tokens. Rows are counted one by one: repeated and null ids stay; other columns are ignored.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, df.schema[id_column].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def start():
        count = counter(tokenizer, chunk, overlap)

        def call(key, text: str | None):
            tokens = count(text) if text else 0
            yield key, len((text or "").encode()), tokens, tokens > limit

        return call

    return map_rows(df.select(id_column, text_column), schema, start)

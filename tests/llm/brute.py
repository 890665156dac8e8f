"""Plain versions of the contracts, one text at a time."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# texts that every operator must take: nulls, empty and long texts, blanks, ties, repeats, odd characters
ODD = [
    None,
    "",
    " ",
    "\n\n \t",
    "a",
    "a b c d e f g h",
    "x " * 4000,
    "é" * 5000,
    "long" * 20000,
    "the same line\nthe same line\n\nthe same line",
    "\U0001f600 smile  nbsp em\x1cfs\x85nel",
    "tab\tnew\nline\r\nend\x0b\x0c.",
    "<|endoftext|> in <|startoftext|>text <|ENDOFTEXT|>",
    "don't we'll  two  spaces   three \n\n  x",
    "É́ é combining ́alone",
]


def odd_table(spark, extra=True):
    """Odd texts with repeated and null ids, and extra columns whose names operators like to use."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again " * 30), (3, "again " * 30), (None, "no id " * 30)]
    names = "doc_id long, text string, source string, lang string, n_chars long"
    more = ", kept boolean, n_words string, spans string, _row int, start string, shard string, score string"
    table = [
        (i, t, None if (i or 0) % 2 else "s", "en", len(t or ""), *((None, "w", "s", 1, "x", "y", "z") if extra else ()))
        for i, t in rows
    ]
    return spark.createDataFrame(table, names + (more if extra else ""))


def base_facts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    failed = n < 20 or 100 * len(again) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), failed


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(spans):
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def crc(data):
    return zlib.crc32(data)

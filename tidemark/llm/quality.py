"""Operator 2: quality rules, line first.

Method: each line with a word is held against punctuation, navigation and
boilerplate rules; lines that fail go; a document that loses more than
``max_lost`` percent of its words that way is rejected.  Before that a document
fails on its own counts: fewer than 50 words, or more than half of its words
in repeated three-word windows.

No rule looks at a line's length: page furniture is a fault where the sentences that
hold it make up a quarter of the line's words or more, be that a short notice or a
long one; a phrase in passing is none.  In scripts without spaces two characters
count as a word.  Lines of one or two words without a closing mark are a fault in
runs of ``RUN`` and more (menus); alone they are headings.

Everything happens where the document lies: no shuffle, one task per split.

Defined cases: NULL text counts as empty, has no words and is rejected; lines
without words pass unchanged; rows that repeat are judged alike and
separately; other columns pass through ``clean_documents`` untouched.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix, split_words, text_chunks

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

# Phrases of page furniture, matched in lower case.
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "back to top", "click here to", "cookie policy", "cookie settings",
    "enable javascript", "javascript is disabled", "lorem ipsum", "powered by wordpress", "privacy policy",
    "sign up for our newsletter", "skip to main content", "skip to content", "subscribe to our newsletter",
    "terms and conditions apply", "terms of service", "terms of use", "this site uses cookies", "we use cookies",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_END = re.compile(r"""[.!?:;…。！？]["'”’»)\]]*$""")
_SYMBOL = re.compile(r"[#*$%&|<>~^\\]")
_SEPARATOR = re.compile(r"(?:^|\s)(?:[|>»•·/]|::|->)(?=\s|$)")
_SENTENCE = re.compile(r"[.!?](?=\s)|[。！？]")
#: Scripts written without spaces.
_UNSPACED = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff]")
#: Short lines in a row that make a menu.
RUN = 3


def _n_words(text: str) -> int:
    return max(len(text.split()), len(_UNSPACED.findall(text)) // 2)


def _furniture(line: str, n: int) -> bool:
    """Do sentences with a phrase of page furniture make up a quarter of the words?"""
    low = line.lower()
    if not _BOILERPLATE.search(low):
        return False
    return 4 * sum(_n_words(x) for x in _SENTENCE.split(low) if _BOILERPLATE.search(x)) >= n


def _is_crumb(line: str) -> bool:
    return _n_words(line) < 3 and not _END.search(line.rstrip(SPACES))


def _fault(line: str) -> str | None:
    words, n = line.split(), _n_words(line)
    if _furniture(line, n):
        return "boilerplate"
    if len(_SEPARATOR.findall(line)) * 5 >= n and "".join(words).strip("|>»•·/:-") and _SEPARATOR.search(line):
        return "navigation"
    if len(_SYMBOL.findall(line)) * 5 > n * 2:
        return "punctuation"
    if line.count("!!") * 3 > n or (n >= 5 and line.upper() == line and line.lower() != line
                                    and sum(w.isalpha() for w in words) * 2 > n):
        return "punctuation"
    return None


def line_fault(line: str) -> str | None:
    """The rule a line with words breaks, taken by itself: 'boilerplate',
    'navigation' or 'punctuation'; None if it passes."""
    return _fault(line) or ("punctuation" if _is_crumb(line) else None)


def faulty_lines(lines: list[str]) -> list[bool]:
    """Which lines of a document break a rule; lines without words break none, and
    short ones only in runs of ``RUN`` lines with words."""
    out, run = [False] * len(lines), []
    for k, line in enumerate([*lines, "."]):  # the last closes a run
        if k < len(lines) and not line.strip(SPACES):
            continue
        if k < len(lines) and _fault(line):
            out[k] = True
        if k < len(lines) and _is_crumb(line):
            run.append(k)
            continue
        if len(run) >= RUN:
            for i in run:
                out[i] = True
        run = []
    return out


def _repeated(grams: np.ndarray) -> int:
    """Words covered by three-word windows found twice or more."""
    s = np.sort(grams)
    if not (s[1:] == s[:-1]).any():
        return 0
    _, back, count = np.unique(grams, return_inverse=True, return_counts=True)
    hit = np.zeros(len(grams) + 2, bool)
    again = count[back] > 1
    for k in range(3):
        hit[k:k + len(grams)] |= again
    return int(hit.sum())


def _judged(docs: DataFrame, max_lost: int, with_text: bool) -> DataFrame:
    columns = ["row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words",
               "base_failed", "kept", "clean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            offsets, codes, uniq = split_words(chunk.column("text"))
            h = uniq[codes]
            grams = mix(mix(h[:-2]) + mix(h[1:-1] + np.uint64(1)) * np.uint64(3) + mix(h[2:] + np.uint64(2)) * np.uint64(5)) \
                if len(h) > 2 else np.empty(0, np.uint64)
            out: list[list] = [[] for _ in columns[1:]]
            for text, a, b in zip(chunk.column("text").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                text = text or ""
                raw = text.encode()
                n = int(b - a)
                repeated = _repeated(grams[a:b - 2]) if n > 3 else 0
                seen: set[str] = set()
                dup = lost = 0
                good = []
                lines = text.split("\n")
                for line, faulty in zip(lines, faulty_lines(lines), strict=True):
                    if line.strip(SPACES):
                        if line in seen:
                            dup += 1
                        seen.add(line)
                        if faulty:
                            lost += len(line.encode().split())
                            continue
                    good.append(line)
                failed = n < 50 or 100 * repeated > 50 * n
                kept = not failed and 100 * lost <= max_lost * n
                for col, x in zip(out, (
                        n, len(text) - len(raw) + len(raw.translate(None, SPACES.encode())),
                        len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeated, lost, failed, kept,
                        "\n".join(good) if with_text and kept and lost else None), strict=True):
                    col.append(x)
            yield pa.record_batch([chunk.column("row"), *(pa.array(x, t) for x, t in zip(
                out, [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()], strict=True))], columns)

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if with_text or c == "doc_id"])
    fed = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    return fed.mapInArrow(run, f"row {fed.schema['row'].dataType.simpleString()}, n_words long, word_chars long, "
                               "n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, "
                               "base_failed boolean, kept boolean, clean string")


def quality(docs: DataFrame, max_lost: int = 40) -> DataFrame:
    """One row per document row with the counts and the verdict."""
    d = _judged(docs.select("doc_id", "text"), max_lost, False)
    return d.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_lost_words")


def clean_documents(docs: DataFrame, max_lost: int = 40) -> DataFrame:
    """The kept documents without their failing lines; n_chars, where present,
    follows the text."""
    d = _judged(docs, max_lost, True).where("kept")
    text = F.coalesce("clean", F.col("row.text").cast("string"))
    return d.select(*[text.alias("text") if c == "text" else
                      F.char_length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                      F.col(f"row.`{c}`") for c in docs.columns])

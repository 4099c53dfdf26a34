"""Sound of a text: Metaphone codes (Philips, 1990) and the indel ratio between two codes.

A token is coded by an ordered list of rewriting rules. Letters still to be coded are lower
case and finished codes are upper case, so a rule can look at its neighbours without undoing
an earlier one. No rule needs look-around or back references, so the same list can run in any
regular-expression engine.

Codes may differ from other Metaphone programs on rare words, as published versions disagree.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.functions.text import tokens
from filing_signals.functions.words import split_words

# Metaphone rewriting rules, in order, as (pattern, replacement).
RULES: list[tuple[str, str]] = [
    (r"[^a-z]", ""),
    (r"gg+", "K"),
    *[(f"{x}{x}+", x) for x in "abdefhijklmnopqrstuvwxyz"],
    (r"^ae", "e"),
    (r"^[gkp]n", "n"),
    (r"^wr", "r"),
    (r"^x", "s"),
    (r"^wh", "w"),
    (r"mb$", "m"),
    (r"sch", "SK"),
    (r"sc([iey])", r"S\1"),
    (r"cia", "Xia"),
    (r"tch", "X"),
    (r"ch", "X"),
    (r"c([iey])", r"S\1"),
    (r"ck", "K"),
    (r"c", "K"),
    (r"dg([iey])", r"J\1"),
    (r"d", "T"),
    (r"gh([^aeiou])", r"\1"),
    (r"gh", "K"),
    (r"gn$", "n"),
    (r"gneT$", "neT"),
    (r"g([iey])", r"J\1"),
    (r"g", "K"),
    (r"ph", "F"),
    (r"sh", "X"),
    (r"th", "0"),
    (r"([aeiou])h([^aeiou]|$)", r"\1\2"),
    (r"h", "H"),
    (r"ti([ao])", r"Xi\1"),
    (r"si([ao])", r"Xi\1"),
    (r"w([aeiou])", r"W\1"),
    (r"w", ""),
    (r"y([aeiou])", r"Y\1"),
    (r"y", ""),
    (r"b", "B"),
    (r"[fv]", "F"),
    (r"j", "J"),
    (r"[kq]", "K"),
    (r"l", "L"),
    (r"m", "M"),
    (r"n", "N"),
    (r"p", "P"),
    (r"r", "R"),
    (r"[sz]", "S"),
    (r"t", "T"),
    (r"x", "KS"),
    (r"^a", "A"),
    (r"^e", "E"),
    (r"^i", "I"),
    (r"^o", "O"),
    (r"^u", "U"),
    (r"[aeiou]", ""),
]


def _needed_letter(pattern: str) -> str:
    """A letter every match of a rule holds, '' if there is none; cheaper to test than the rule."""
    plain = re.sub(r"\[[^\]]*\]|\([^)]*\)", "", pattern)
    return next((ch for ch in plain if ch.isalpha()), "")


_COMPILED = [(_needed_letter(p), re.compile(p), r) for p, r in RULES]
_MEMO: dict[str, str] = {}
_MEMO_ROOM = 500_000
#: Characters of a string whose positions fit a 64-bit word.
_WORD_BITS = 64
#: Texts that are worth an array operation; the ends of fewer longer ones are read one by one.
_FEW_TEXTS = 16


def encode_token(token: str) -> str:
    """Metaphone code of one lower-case token; '' where it has no letters to code."""
    code = token
    for letter, pattern, replacement in _COMPILED:
        if letter in code:
            code = pattern.sub(replacement, code)
    return code


def _for_lines(pattern: str, replacement: str) -> Callable[[str], str]:
    """A rule for many tokens at once, a token a line. Plain letters need no regular expression: a
    replacement holds no letter that is still to be coded."""
    letters = re.fullmatch(r"\[([a-z]+)\]", pattern)
    plain = [pattern] if pattern.isalpha() else list(letters[1]) if letters else []
    if plain:
        return lambda lines: reduce(lambda done, part: done.replace(part, replacement), plain, lines)
    compiled = re.compile(pattern.replace("[^", r"[^\n"), re.MULTILINE)
    return lambda lines: compiled.sub(replacement, lines)


_BY_LINES = [_for_lines(p, r) for p, r in RULES]


def encode_tokens(tokens: list[str]) -> list[str]:
    """`encode_token` of each token; tokens hold no white space."""
    lines = "\n".join(tokens)
    for rule in _BY_LINES:
        lines = rule(lines)
    return lines.split("\n") if tokens else []


def encode_text(text: str) -> str:
    """Codes of a text's tokens joined by a space; each distinct token is coded once."""
    return " ".join(codes_of(text.lower().split())).strip()


def char_masks(text: str) -> dict[str, int]:
    """For each character the positions it holds, as bits."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def indel(masks: dict[str, int], size: int, other: str) -> float:
    """2 * LCS / total length, with the bit-parallel LCS of Hyyro (2004)."""
    total = size + len(other)
    if total == 0:
        return 1.0
    full = (1 << size) - 1
    row = full
    for ch in other:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2.0 * (size - row.bit_count()) / total


def _characters(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """All characters of all texts as numbers, the character of each number, and the texts' sizes."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held else np.zeros(0, np.uint8)
    if not len(data) or data.max() < 128:
        return data, [chr(c) for c in range(128)], np.diff(ends).astype(np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    known, which = np.unique(points, return_inverse=True)
    return which, [chr(c) for c in known], pc.utf8_length(texts).to_numpy().astype(np.int64)


def _read_on(row: int, hits: list[int], full: int) -> int:
    """The positions still free after the characters that hit those of `hits`."""
    for bits in hits:
        hit = row & bits
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return row


def indels_each(texts: list[str] | pa.Array, others: list[str]) -> list[np.ndarray]:
    """`indel` of each text with each of some strings, a character of all texts at a time.

    A string's positions are the bits of the narrowest word that has room for them; what a sum carries beyond
    them is never looked at. A string longer than a word is compared text by text. The characters at a place are
    fetched once for all strings; places that few texts reach, as one very long text has, are left to plain numbers.
    """
    if not len(texts):
        return [np.zeros(0) for _ in others]
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    which, known, sizes = _characters(texts)
    longest_first = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[longest_first]
    # how many texts have a character at each place
    holding = len(texts) - np.cumsum(np.bincount(sizes))[:-1]

    short = [other for other in dict.fromkeys(others) if len(other) <= _WORD_BITS]
    masks, rows = [], []
    for other in short:
        word = next(w for w in (np.uint8, np.uint16, np.uint32, np.uint64) if len(other) <= np.iinfo(w).bits)
        bits = char_masks(other)
        masks.append(np.array([bits.get(ch, 0) for ch in known], word))
        rows.append(np.full(len(texts), (1 << len(other)) - 1, word))
    together = int((holding >= _FEW_TEXTS).sum())
    for j, n in enumerate(holding[:together].tolist()):
        at = which[starts[:n] + j].astype(np.intp)
        for mask, row in zip(masks, rows):
            part = row[:n]
            hit = part & mask[at]
            np.bitwise_or(part + hit, part - hit, out=part)
    for i in range(int(holding[together]) if together < len(holding) else 0):
        rest = which[starts[i] + together : starts[i] + sizes[longest_first[i]]]
        for mask, row in zip(masks, rows):
            row[i] = _read_on(int(row[i]), mask[rest].tolist(), np.iinfo(row.dtype).max)

    found = {}
    for other, row in zip(short, rows):
        left = np.bitwise_count(row & row.dtype.type((1 << len(other)) - 1))
        lcs = np.zeros(len(texts), np.int64)
        lcs[longest_first] = len(other) - left.astype(np.int64)
        total = sizes + len(other)
        found[other] = np.where(total > 0, 2.0 * lcs / np.maximum(total, 1), 1.0)
    for other in set(others) - set(short):
        found[other] = np.array([indel(char_masks(t), len(t), other) for t in texts.to_pylist()], np.float64)
    return [found[other] for other in others]


def indels(texts: list[str], other: str) -> np.ndarray:
    """`indel` of each text with one string."""
    return indels_each(texts, [other])[0]


def codes_of(tokens: list[str]) -> list[str]:
    """Codes of lower-case tokens without white space; those not met before are coded together, each once."""
    memo = _MEMO
    codes = list(map(memo.get, tokens))
    fresh = list(dict.fromkeys(t for t, code in zip(tokens, codes) if code is None))
    if fresh:
        made = dict(zip(fresh, encode_tokens(fresh)))
        if len(memo) + len(made) > _MEMO_ROOM:
            memo.clear()
        memo.update(made)
        codes = [made[t] if code is None else code for t, code in zip(tokens, codes)]
    return codes


def encode_texts(texts: pa.Array) -> pa.Array:
    """`encode_text` of each text; null for a null one. A code goes by the letters a to z of a token, which
    Arrow lowers as Python does."""
    sizes, words = split_words(pc.utf8_lower(texts))
    codes = pa.array(codes_of(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.string())
    ends = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), codes.take(words.indices)), " ")
    return pc.if_else(texts.is_null(), pa.scalar(None, pa.string()), pc.utf8_trim(joined, " "))


@F.arrow_udf(T.StringType())
def phonetic_code(text: pa.Array) -> pa.Array:
    """Metaphone code string of a text."""
    return encode_texts(text)


def indels_of_pairs(left: pa.Array, right: pa.Array) -> np.ndarray:
    """`indel` of each pair of strings without nulls.

    The strings of the side with fewer distinct ones are taken one after another, each with all its
    partners at a time.
    """
    a, b = (x.dictionary_encode() for x in (left, right))
    if len(a.dictionary) < len(b.dictionary):
        a, b = b, a
    texts, others = (x.dictionary.to_pylist() for x in (a, b))
    rows, partner = (x.indices.to_numpy().astype(np.int64) for x in (a, b))
    out = np.zeros(len(rows))
    order = np.argsort(partner, kind="stable")
    ends = np.cumsum(np.bincount(partner, minlength=len(others)))
    for k, other in enumerate(others):
        places = order[ends[k - 1] if k else 0 : ends[k]]
        met, back = np.unique(rows[places], return_inverse=True)
        out[places] = indels([texts[i] for i in met], other)[back]
    return out


@F.arrow_udf(T.DoubleType())
def indel_ratio(left: pa.Array, right: pa.Array) -> pa.Array:
    """Indel ratio of two strings, in [0, 1]; null where either is."""
    known = pc.and_(left.is_valid(), right.is_valid())
    found = np.zeros(len(left))
    found[np.asarray(known)] = indels_of_pairs(left.filter(known), right.filter(known))
    return pc.if_else(known, pa.array(found, pa.float64()), pa.scalar(None, pa.float64()))


def phonetic_similarity(code: Column, keyword_code: Column) -> Column:
    """0 where either code is empty, else the indel ratio of the two codes."""
    silent = (F.coalesce(code, F.lit("")) == "") | (F.coalesce(keyword_code, F.lit("")) == "")
    return F.when(silent, F.lit(0.0)).otherwise(indel_ratio(code, keyword_code))


def phonetic_similarities(text: Column, keyword_codes: list[str]) -> Column:
    """Similarities of one text's code to each of a bounded list of keyword codes, as an array.

    One Arrow hop per sentence rather than per (sentence, theme) pair; the code itself stays in the task.
    """

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def to_all(texts: pa.Array) -> pa.Array:
        rows = pc.fill_null(encode_texts(texts), "")
        spoken = pc.binary_length(rows).to_numpy() > 0
        heard = dict(zip(said := [b for b in keyword_codes if b], indels_each(rows, said)))
        each = [np.where(spoken, heard[b], 0.0) if b else np.zeros(len(rows)) for b in keyword_codes]
        flat = np.stack(each, axis=1).ravel() if each else np.zeros(0)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * len(keyword_codes)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return to_all(text)


def vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct lower-case tokens of a text column with their codes.

    `distinct` combines on the map side, so a token that fills the corpus is one row per task.
    """
    words = df.select(F.explode(tokens(F.lower(F.col(text)))).alias("token")).distinct()
    return words.select("token", phonetic_code("token").alias("code"))

"""Statistics of whole texts, counted over numpy arrays of many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barloom.llm.arrow_text import Words, mixed_bits

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_PUNCTUATION = b"!\"'(),-./:;?[]_`{}~@\\^+="

#: Names of the statistics that the models use, in the order of their columns.
STATISTICS = ("log_words", "word_length", "upper", "digits", "punctuation", "symbols", "non_ascii",
              "distinct_words", "top_word", "duplicate_lines", "repeated_words", "words_per_line",
              "exclamations", "bars", "ended_lines", "symbol_words", "capital_words")


def _table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


_CLASSES = {
    "space": _table(b" \t\n\x0b\x0c\r"), "upper": _table(bytes(range(65, 91))),
    "digits": _table(b"0123456789"), "punctuation": _table(_PUNCTUATION),
    "symbols": _table(SYMBOLS), "non_ascii": _table(bytes(range(0xC0, 0x100))),
    "inner": _table(bytes(range(0x80, 0xC0))), "exclamations": _table(b"!"), "bars": _table(b"|")}


def class_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Characters of each class in each text, and ``points``, all of its code points."""
    texts = texts.cast(pa.large_binary())
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    joined = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    full = np.flatnonzero(np.diff(ends) > 0)
    counts = {}
    for name, table in _CLASSES.items():
        counts[name] = np.zeros(len(texts), np.int64)
        if len(full):
            counts[name][full] = np.add.reduceat(table[joined], ends[full], dtype=np.int64)
    counts["points"] = np.diff(ends).astype(np.int64) - counts["inner"]
    return counts


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """How many words of each text lie in windows that occur twice or more in it.

    A 64-bit hash finds the windows that may be repeated; those are compared word by word.
    """
    n, owners = len(words.sizes), words.owners()
    starts = len(words.ids) - window + 1
    if starts <= 0:
        return np.zeros(n, np.int64)
    inside = np.flatnonzero(owners[:starts] == owners[window - 1:])
    key = owners[inside].astype(np.uint64)
    for k in range(window):
        key = mixed_bits(key * np.uint64(0x9E3779B97F4A7C15) + words.ids[inside + k].astype(np.uint64))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    covered = np.zeros(len(words.ids) + 1, np.int64)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        maybe = inside[twice[place] == key]
        full = np.stack([owners[maybe], *(words.ids[maybe + k] for k in range(window))], axis=1)
        _, which, count = np.unique(full, axis=0, return_inverse=True, return_counts=True)
        found = maybe[count[which.reshape(-1)] > 1]
        np.add.at(covered, found, 1)
        np.add.at(covered, found + window, -1)
    within = np.cumsum(covered[:-1]) > 0
    return np.bincount(owners[within], minlength=n)


def line_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word, those equal to an earlier one, and those that end in a full stop or the
    like."""
    lines = pc.split_pattern(texts.cast(pa.large_string()), "\n")
    sizes = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
    owners = np.repeat(np.arange(len(texts)), sizes)
    flat = lines.flatten()
    bare = pc.ascii_trim_whitespace(flat)
    real = pc.greater(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)
    ended = pc.match_substring_regex(bare, "[.!?:;\"')]$").to_numpy(zero_copy_only=False) & real
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.sort(owners[real].astype(np.int64) << 32 | ids[real])
    again = (key[1:][key[1:] == key[:-1]] >> 32).astype(np.int64)
    n = len(texts)
    return (np.bincount(owners[real], minlength=n), np.bincount(again, minlength=n),
            np.bincount(owners[ended], minlength=n))


@dataclass
class Counted:
    """Exact counts of some texts and the statistics derived from them."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    statistics: np.ndarray


def count(texts: pa.Array) -> Counted:
    words, chars = Words(texts, lower=False), class_counts(texts)
    lines, again, ended = line_counts(texts)
    repeats, n_words = repeated_words(words), words.sizes
    n, owners = len(n_words), words.owners()
    solid = chars["points"] - chars["space"]
    key = np.sort((owners << 32) | words.ids)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    many = np.diff(np.concatenate([first, [len(key)]]))
    of = (key[first] >> 32).astype(np.int64) if len(key) else first
    most = np.zeros(n, np.int64)
    np.maximum.at(most, of, many)
    with_symbol = pc.match_substring_regex(words.names, "[#*$%&|<>]").to_numpy(zero_copy_only=False)
    capital = pc.match_substring_regex(words.names, "^[^a-z]*[A-Z][^a-z]+$").to_numpy(
        zero_copy_only=False)

    def words_where(flag: np.ndarray) -> np.ndarray:
        return np.bincount(owners[flag[words.ids]], minlength=n) if len(words.ids) else np.zeros(n)

    w, c, li = np.maximum(n_words, 1), np.maximum(solid, 1), np.maximum(lines, 1)
    statistics = np.stack([
        np.log1p(n_words), solid / w, chars["upper"] / c, chars["digits"] / c,
        chars["punctuation"] / c, chars["symbols"] / c, chars["non_ascii"] / c,
        np.bincount(of, minlength=n) / w, most / w, again / li, repeats / w, np.log1p(n_words / li),
        chars["exclamations"] / c, chars["bars"] / c, ended / li, words_where(with_symbol) / w,
        words_where(capital) / w], axis=1).astype(float)
    return Counted(n_words, solid, chars["symbols"], again, repeats, statistics)

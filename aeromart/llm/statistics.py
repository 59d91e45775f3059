"""Statistics of whole documents as numpy columns: what the quality models look at.

Everything is counted from the bytes of a block of texts at once: a histogram of byte values per
document, and per-document sorts of word, line and window hashes.
"""

import numpy as np

from aeromart.llm import words as W

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".!?:;,\"')")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "long_words", "short_words", "capitalised", "upper_words", "no_letter_words",
    "distinct_words", "top_word", "repeat_words", "repeat_pairs", "dup_lines", "words_per_line", "ended_lines",
    "symbols", "digits", "upper", "lower", "beyond_ascii", "newlines", "marks", "quotes", "brackets", "pipes",
    "exclaims", "entropy",
)
#: A document with more of these is never likelier to be good.
FALLING = ("symbols", "repeat_words", "dup_lines", "top_word", "pipes", "no_letter_words")


def _run_counts(owner: np.ndarray, hashes: np.ndarray, rows: int):
    """(distinct values, longest run) per row, and a flag for every value met twice or more in its row."""
    keys, shift = W.keyed(owner, hashes, rows)
    values, lengths = W.runs(np.sort(keys))
    row = (values >> shift).astype(np.int64)
    distinct = np.bincount(row, minlength=rows)
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, row[lengths > 1], lengths[lengths > 1])
    longest = np.maximum(longest, distinct > 0)
    repeated = values[lengths > 1]
    if not len(repeated):
        return distinct, longest, np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
    return distinct, longest, repeated[at] == keys


def _repeats(hashes: np.ndarray, owner: np.ndarray, first: np.ndarray, size: int, rows: int) -> np.ndarray:
    """Marks the words in windows of `size` words that their document holds twice or more."""
    total = len(hashes)
    inside = W.windows_inside(first, size, total)
    if not inside.any():
        return np.zeros(total, bool)
    at = np.flatnonzero(inside)
    _, _, twice = _run_counts(owner[at], W.window_hashes(hashes, size)[at], rows)
    marked = np.zeros(len(inside), bool)
    marked[at] = twice
    out = np.zeros(total, bool)
    for i in range(size):
        out[i : i + len(marked)] |= marked
    return out


def measure(texts: W.Texts) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(counts named in BASE, matrix with the columns FEATURES) of the documents of a block.

    Words are whole and unchanged; a window of three words is repeated if its document holds it
    twice or more; a line is a duplicate if it has a word and equals an earlier line. A text
    without words has zeros everywhere.
    """
    raw, rows = texts.raw, texts.rows
    histogram = np.bincount(texts.owners() * 256 + raw, minlength=rows * 256).reshape(rows, 256).astype(np.float64)
    starts, ends, first = W.words(texts)
    owner, count = W.owners_of(first), np.diff(first)
    hashes = W.span_hashes(raw, starts, ends)
    distinct, longest, _ = _run_counts(owner, hashes, rows)
    repeated = W.per_row(first, _repeats(hashes, owner, first, REPEAT_WINDOW, rows))
    pairs = W.per_row(first, _repeats(hashes, owner, first, 2, rows))

    # Lines between newlines; each newline also opens a line after it.
    line_starts, line_ends, line_first = W.spans(texts, raw != 10)
    line_words = np.searchsorted(starts, line_ends) - np.searchsorted(starts, line_starts)
    real = line_words > 0
    line_owner = W.owners_of(line_first)[real]
    line_hashes = W.span_hashes(raw, line_starts[real], line_ends[real])
    lines = np.bincount(line_owner, minlength=rows)
    duplicates = lines - _run_counts(line_owner, line_hashes, rows)[0]
    ended = np.bincount(line_owner, weights=_PUNCTUATION[raw[line_ends[real] - 1]], minlength=rows)

    heads, tails = raw[starts], raw[ends - 1]
    lengths = ends - starts
    letters = np.concatenate(([0], np.cumsum(_LETTER[raw])))
    uppers = np.concatenate(([0], np.cumsum((raw >= 65) & (raw <= 90))))
    lowers = np.concatenate(([0], np.cumsum((raw >= 97) & (raw <= 122))))
    word_letters, word_upper, word_lower = (x[ends] - x[starts] for x in (letters, uppers, lowers))
    head_upper = (heads >= 65) & (heads <= 90)

    chars = histogram.sum(1) - histogram[:, 128:192].sum(1)
    word_chars = chars - histogram[:, W.SPACE].sum(1)
    symbols = histogram[:, list(SYMBOLS)].sum(1)
    base = {
        "n_words": count,
        "word_chars": word_chars.astype(np.int64),
        "n_symbols": symbols.astype(np.int64),
        "n_dup_lines": duplicates.astype(np.int64),
        "n_repeat_words": repeated.astype(np.int64),
    }
    n, c, k = np.maximum(count, 1), np.maximum(word_chars, 1), np.maximum(lines, 1)
    share = histogram / np.maximum(histogram.sum(1, keepdims=True), 1)
    of_words = lambda flags: W.per_row(first, flags) / n
    columns = {
        "log_words": np.log1p(count),
        "mean_word": word_chars / n,
        "long_words": of_words(lengths > 14),
        "short_words": of_words(lengths < 4),
        "capitalised": of_words(head_upper & (word_lower > 0)),
        "upper_words": of_words((word_upper > 1) & (word_lower == 0)),
        "no_letter_words": of_words(word_letters == 0),
        "distinct_words": distinct / n,
        "top_word": longest / n,
        "repeat_words": repeated / n,
        "repeat_pairs": pairs / n,
        "dup_lines": duplicates / k,
        "words_per_line": count / k,
        "ended_lines": ended / k,
        "symbols": symbols / c,
        "digits": histogram[:, 48:58].sum(1) / c,
        "upper": histogram[:, 65:91].sum(1) / c,
        "lower": histogram[:, 97:123].sum(1) / c,
        "beyond_ascii": histogram[:, 192:].sum(1) / c,
        "newlines": histogram[:, 10] / n,
        "marks": of_words(_PUNCTUATION[tails]),
        "quotes": histogram[:, list(b"\"'`")].sum(1) / c,
        "brackets": histogram[:, list(b"()[]{}<>")].sum(1) / c,
        "pipes": histogram[:, 124] / c,
        "exclaims": histogram[:, list(b"!?")].sum(1) / c,
        "entropy": -(share * np.log2(np.where(share > 0, share, 1))).sum(1),
    }
    return base, np.column_stack([columns[name] for name in FEATURES])

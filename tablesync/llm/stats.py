"""Statistics of whole texts, for the learned quality rules and the quality classifier.

Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none. ``bytes.split`` and ``bytes.strip`` know exactly those
separators, so that UTF-8 is never decoded again.
"""

from __future__ import annotations

import numpy as np

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"

#: Counts in the order of :func:`text_counts`.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks",
    "n_ends", "n_distinct", "n_short", "longest", "n_chars", "n_wide",
)

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(set(range(33, 127)) - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123)))
_ENDS = b".!?"


def repeated_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words inside windows of ``size`` words that the text holds twice or more."""
    n = len(hashes) - size + 1
    if n < 2:
        return 0
    window = np.zeros(n, np.uint64)
    for j in range(size):
        window = (window ^ (window >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    again = np.isin(window, twice)
    covered = np.zeros(len(hashes), bool)
    for j in range(size):
        covered[j : j + n] |= again
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The :data:`COUNTS` of one whole text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    without = lambda drop: len(data) - len(data.translate(None, drop))
    words = data.split()
    n = len(words)
    chars = len(text or "")
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, n)
    return (
        n, chars - without(_SPACES), without(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(hashes), len(lines),
        without(_UPPER), without(_DIGITS), without(_MARKS), without(_ENDS), len(np.unique(hashes)),
        int((sizes <= 3).sum()), int(sizes.max(initial=0)), chars, len(data) - chars,
    )


#: Ratios that the models learn from, as SQL over the counts.
FEATURES = {
    "words": "double(n_words)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(word_chars, 1)",
    "ends_per_word": "n_ends / greatest(n_words, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "short_words": "n_short / greatest(n_words, 1)",
    "longest": "double(longest)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "wide": "n_wide / greatest(n_chars, 1)",
}


def count_batch(doc_id: list, text: list) -> dict[str, object]:
    counts = np.array([text_counts(x) for x in text], np.int64).reshape(len(text), len(COUNTS))
    return {"doc_id": doc_id} | {name: counts[:, i] for i, name in enumerate(COUNTS)}


COUNT_SCHEMA = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTS)

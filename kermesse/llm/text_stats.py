"""Plain counts of one text, computed inside Arrow tasks."""

from __future__ import annotations

from collections import Counter

from kermesse.llm.common import BLANKS

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found, inside = Counter(windows), bytearray(len(words))
    for at, window in enumerate(windows):
        if found[window] > 1:
            inside[at:at + 3] = b"\1\1\1"
    return sum(inside)


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def base_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, their code points, symbols, lines with a word, repeated lines, repeated words. Null: zeros."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()  # on bytes, the blanks are exactly the ASCII ones
    lines, again = repeated_lines(text)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), lines, again,
            repeated_words(words))

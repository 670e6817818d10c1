"""Rows that several test modules share."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that every operator must get through: null, empty, blank, short, long, odd characters, no letters.
ODD = [
    None, "", " ", "\n\n", "a", "word", "1234 5678", "\t tab\x0b\x0c\r end ", "é" * 300, "x" * 20000, "one two three " * 3000,
    "line\n" * 50, "\x00 zero \x1c sep", "<|endoftext|> İ ﬁ ́", "same text here for ties", "same text here for ties",
]


def rows(df, *columns):
    """Rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)

"""Rows and helpers that the operators' tests share."""

# Null, empty, blank, junk, very long, tied and repeated rows; with columns whose names clash
# with the operators' own.
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
SHARED = " ".join(f"shared{i}" for i in range(60))
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs through the green wood."),
    (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (5, "!!! ... 123 ###"), (6, "word"), (7, "two words"),
    (8, LONG), (9, SHARED), (10, "before " + SHARED + " after"), (11, SHARED + " tail " + SHARED),
    (12, "The quick brown fox jumps over the lazy dog and runs through the green wood."),
    (13, "É́ ß İ 中文字 😀 \x85\xa0 <|endoftext|> \x00 \x1c"), (9, SHARED), (9, "other text under a used id"),
    (None, "text without an id"), (None, None),
]


def by_row(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

"""Rows that every operator must bear."""


def odd_rows():
    """Nulls in every column, empty, blank and long texts, repeated rows, equal texts and a repeated id."""
    words = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the QUICK brown fox jumps  over the lazy dog", "en", None, None),
        (3, None, "en", "b", None), (4, "", None, "b", 0), (5, " \t\n\x0b\x0c\r ", "de", None, 6),
        (None, "an id is missing here but words are not", None, None, None), (None, None, None, None, None),
        (6, words, "fr", "c", len(words)), (7, "überall — ÉTÉ \u0085 x 🙂", "de", "c", 20), (8, "4711 ## 0815", "xx", "é", 12),
        (-9, "one", "en", "a", 3), (-9, "quite another text of the same id, as it were", "en", "a", 3),
    ]

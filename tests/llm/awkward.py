"""Texts that no operator may stumble over."""

LONG = "many words of one very long text that goes on " * 4000 + "end"
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "one two"),
    (6, "İstanbul ǅ ß ŉ Ω 日本語    \U0001f600 é \x00 end"),
    (7, LONG),
    (8, LONG),
    (9, "same text here and now\nsame text here and now\n"),
    (9, "same text here and now\nsame text here and now\n"),
    (None, "a document without an id of its own"),
    (10, "A line that three documents share\nx"),
    (11, "  a LINE that three documents share\t\ny"),
    (12, "A line that three documents share"),
    (-13, "a line that three documents share\n\n"),
]

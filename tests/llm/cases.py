"""Tables that every operator has to stand."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, `key` long, batch int, word string, n int, _id string, drops string, h64 int"


#: Nulls, blanks, repeated rows, ties, very long texts.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a text with no id at all"), (4, "same text"), (4, "same text"), (5, "same  text"), (6, "Ünïcode ☃ 日本語 \x0b\x0c end"), (7, "word " * 60_000), (8, "x" * 100_000), (9, "\n" * 5_000)]

"""Fixtures that every operator must survive."""

#: doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves.
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rid string, node string, piece string, n int, score string, kept string, key string, digest string, text_ string, row_key string, __text string, __rid string"

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box quietly near the old stone bridge and nobody minds the rain at all tonight "


def doc(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None, "r", "x", "p", 1, "s", "k", "key", "d", "t", "rk", "tt", "ri")


def hard_documents():
    """Nulls, empty and blank texts, short and very long ones, ties, repeated rows and ids, odd characters."""
    long = " ".join(f"word{i % 977} {PROSE}" for i in range(1500))
    return [
        doc(1, PROSE * 3), doc(2, PROSE * 3), doc(2, PROSE * 3), doc(3, None), doc(4, ""), doc(5, " \t\n "), doc(6, "one"), doc(7, "One"), doc(8, "a b c d"), doc(9, long), doc(10, long + "end"),
        doc(None, "a null id with some words of its own here"), doc(11, "é ü ñ — “quotes” 日本語 \x1c\x85　 x'll 's <|endoftext|> y  \n\n z"), doc(12, PROSE * 2 + "tail of another kind", None), doc(13, "!!! ### $$$", None), doc(2, "another text under a used id entirely"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def same(a, b):
    def key(row):
        return tuple((x is None, str(x)) for x in row)

    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)

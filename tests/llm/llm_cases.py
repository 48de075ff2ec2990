"""Rows and helpers for the tests of text operators."""

#: Texts that every operator must take: null, empty, blank, short, odd characters, a tie and a very long one.
ODD = [None, "", " \n\t ", "word", "two words", "naïve café \U0001F600 ﬁn", "a" * 5000, "x y " * 20000,
       "the same text twice over and over again", "the same text twice over and over again", "tab\tvt\x0bff\x0cend"]


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}

import pytest

FOLDER = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} and the rest of line {i}" + ("\n" if i % 9 == 0 else "")
                for i in range(3000))
SHARED = "this passage of more than fifty bytes stands in several of the documents here."
EDGES = [
    (1, "a short text"), (2, None), (3, ""), (4, "  \n\t "), (5, "!!! ### 123 |||"),
    (6, LONG), (7, LONG), (8, LONG.replace("word7 ", "word8 ")),
    (9, f"Before it. {SHARED}\nA line that is shared by some\nown line nine of it"),
    (10, f"{SHARED} After it.\n  a LINE that is shared by some\t\nown line ten of it"),
    (11, "A line that is shared by some\nA line that is shared by some\nÄ line THAT is É"),
    (11, "A line that is shared by some\nother text under the same id"),
    (12, "one two three four five six seven eight nine " * 12),
    (13, "one two three four five six seven eight nine " * 12),
    (None, "A line that is shared by some\nrow without an id"), (None, None),
    (14, "naïve café \U0001F600 ٣٤٥ 漢字かな ﬁ \x1c\x85  x"), (15, "can't WON'T I'll 've"),
    (16, "a" * 300 + " " * 40 + "=" * 70), (17, "a short text"), (17, "a short text"),
    (18, f"{SHARED}{SHARED} xx {SHARED}"), (19, "\n\n\r\n\x0b\n"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Texts with nulls, ties, repeated rows, a long text, and columns of clashing names."""
    rows = [(i, t, "en" if i != 5 else None, "src", len(t or ""), -1, "x", "y", 0)
            for i, t in EDGES]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "shard int, keep string, ids string, mark int")


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

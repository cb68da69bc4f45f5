"""Small documents with every awkward case, and plain versions of what operators do."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, n_words string, block int, _row string, sig string"


def texts() -> dict[int, str | None]:
    r = random.Random(5)
    vocab = ["".join(r.choice("aeiouéstnrß") for _ in range(r.randrange(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, long = prose(80), prose(3000)
    out = {1: None, 2: "", 3: " \n\t ", 4: "one", 5: "One two", 6: "one TWO", 7: prose(60), 10: long}
    out[8] = out[7]                                          # copies
    out[9] = out[7].replace(" ", "\n", 3)
    for i in range(11, 31):                                  # near copies: one word changed
        w = long.split()[:200]
        w[i * 5] = f"changed{i}"
        out[i] = " ".join(w)
    for i in range(31, 41):                                  # a shared passage in different texts
        out[i] = f"{prose(50)} {passage}\n{prose(40)}"
    for i in range(41, 61):
        out[i] = prose(r.randrange(1, 120)).capitalize()
    out[61] = "a b c " * 400                                 # one passage over and over
    out[62] = "x" * 5000
    out[63] = "line one here\nline one here\n\n | # $ | \nline one here"
    return out


def frame(spark, rows=None):
    """The documents with extra columns whose names clash; one row twice and one without an id."""
    t = texts()
    rows = [*t.items(), (7, t[7]), (None, t[31]), (None, "alone here")] if rows is None else rows
    return spark.createDataFrame([(i, x, ["de", "en", None, "xx"][k % 4], "n", k, "r", "s") for k, (i, x) in enumerate(rows)], SCHEMA).repartition(3)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


class Sets:
    """Union-find whose roots are the least members."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a

"""Small document tables with every awkward case, and brute-force helpers."""

import re

from lakeforge.llm.common import NULL_ID

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, block int, bucket string, fp string, grp string, keys string"
LOREM = "the quick brown fox jumps over a lazy dog while nine small birds sing in old green trees near cold water".split()


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    return " ".join(f"{LOREM[(seed * 7 + i * i + i // 3) % len(LOREM)]}{(seed * 31 + i * 17) % 97}" for i in range(n))


def texts():
    shared = prose(1, 60)
    long_text = prose(2, 6000)
    out = [None, "", " \n\t ", "one", "two words", shared, shared, shared + " tail", "head " + shared,
           prose(3, 40) + "\n" + shared + "\n" + prose(4, 40), long_text, long_text + " x", "a" * 3000,
           " ".join(["same"] * 400), "é ü 日本 " * 80, prose(5, 200), prose(5, 200).upper(),
           "\n".join(["line one here", "line two here", "line three", "line one here", "line two here"]), "ab\x1ccd\x85ef", "x" * 250, "x" * 199]
    return out


def rows(with_ids=True):
    """Rows in no order, with a repeated row, a repeated id and NULL ids."""
    t = texts()
    out = [(i * 3, x) for i, x in enumerate(t)]
    out += [out[5], (out[6][0], "another text under a known id " + prose(9, 30)), (None, t[5]), (None, None), (None, prose(8, 50))]
    return out[::-1]


def frame(spark, data=None, parts=3):
    """The rows as a table with extra columns that clash with internal names."""
    data = rows() if data is None else data
    return spark.createDataFrame([(d, x, 1, "b", None, "g", "k") for d, x in data], SCHEMA).repartition(parts)


def key(d):
    return NULL_ID if d is None else d


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def same(found, wanted):
    order = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    assert sorted(map(tuple, found), key=order) == sorted(map(tuple, wanted), key=order)

"""Small tables with every awkward case, and plain versions of what the operators do."""

import hashlib
import random

SMALL = "/root/testdata/sf0.001"
#: Names that operators use inside; a table may have such columns.
CLASHING = ["size", "copies", "hash", "content", "place", "n", "row", "key", "node", "target", "bin", "y", "id", "nth"]


def prose(seed, n=60, words="red blue green stone river cloud hill tree bird road sand wind rain snow fire".split()):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) + str(draw.randrange(40)) for _ in range(n))


def edge_rows():
    """doc_id, text, lang, source, n_chars: nulls, empty and long texts, ties, repeated rows, hot copies."""
    base, long = prose(1, 80), prose(2, 4000)
    texts = [base, base, base + " and more of it", None, "", "   \n\t ", "word", "a b c d", long, long + " tail",
             "x" * 3000, "ab " * 900, prose(3, 40) + " " + base, "é ß 漢字 \U0001f600 " * 30, prose(4, 25),
             "line one of it all\n" * 40]
    rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows += [(100 + k, base if k % 3 else base + f" {k}", "en", "src0", None) for k in range(30)]  # a hot group
    rows += [(3, prose(5), None, None, None), (None, base, "en", "src1", 1), (None, None, None, None, None)]
    rows += [rows[0], rows[8], rows[4]]  # repeated rows
    return rows


def edge_docs(spark):
    docs = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'other' AS `{name}`")
    return docs


def seen_earlier(sequences, length):
    """For sequences in order: a mask of the symbols inside windows that also start earlier; equal rows count once."""
    first, out = {}, []
    for order, x in sequences:
        mask = [False] * len(x)
        for k in range(len(x) - length + 1):
            at = first.setdefault(hashlib.md5(repr(x[k:k + length]).encode()).digest(), (order, k))
            if at < (order, k):
                mask[k:k + length] = [True] * length
        out.append(mask)
    return out

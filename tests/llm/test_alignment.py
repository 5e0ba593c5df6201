"""Token alignment against a plain version over byte sets."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fitmill.llm import alignment, workload
from tests.llm.data import SMALL, edge_docs, edge_rows

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(texts):
    a_tool, b_tool = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_tool.encode_special_tokens = True
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    docs = []
    for text in texts:
        a = [(i, bytes(of[c] for c in t)) for e in [a_tool.encode(f" {text}", add_special_tokens=False)] for i, t in zip(e.ids, e.tokens)] if text else []
        b = [(i, bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode())
             for i in (b_tool.encode(text) if text else []) for p in [b_tool.id_to_piece(i)]]
        if not text or {b"".join(x for _, x in a), b"".join(x for _, x in b)} != {f" {text}".encode()}:
            docs.append(([], "", 0, 0, 0))
            continue
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, begin = [], 0
        links = []
        for end in common:
            here = [[(i, s, e) for i, s, e in some if begin <= s and e <= end] for some in spans]
            groups.append("|".join(",".join(str(i) for i, _, _ in some) for some in here))
            links += [(i, j) for i, s, e in here[0] for j, p, q in here[1] if max(s, p) < min(e, q)]
            spans = [some[len(h):] for some, h in zip(spans, here)]
            begin = end
        docs.append((links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(a), len(b), len(groups)))
    n = Counter(x for links, *_ in docs for x in links)
    most = Counter()
    for (_, j), k in n.items():
        most[j] = max(most[j], k)
    return [(a, b, g, len(links), sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links), sha) for links, sha, a, b, g in docs]


def figures(rows):
    return sorted(((r.doc_id, *(r[c] for c in FIGURES)) for r in rows), key=repr)


@given(st.lists(st.integers(1, 400), min_size=1, unique=True), st.lists(st.integers(1, 400), min_size=1, unique=True))
def test_ranks_and_links(x, y):
    end = max(x + y)
    a, b = (np.array(sorted({*some, end})) for some in (x, y))
    cut_a, cut_b, of_a, of_b = alignment.aligned(a, b)
    assert a[cut_a].tolist() == b[cut_b].tolist() == sorted({*a.tolist()} & {*b.tolist()})
    starts = [[0, *some[:-1].tolist()] for some in (a, b)]
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts[0][i], starts[1][j]) < min(a[i], b[j])}
    assert len(of_a) == len(want) and set(zip(of_a.tolist(), of_b.tolist())) == want


def test_given_and_awkward_documents(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted(((k, *p) for (k, _), p in zip(rows, plain([t for _, t in rows]))), key=repr)
    assert figures(workload.op11_token_alignment(spark, SMALL).collect()) == want
    rows = [(r[0], r[1]) for r in edge_rows()]
    want = sorted(((k, *p) for (k, _), p in zip(rows, plain([t for _, t in rows]))), key=repr)
    docs = edge_docs(spark)
    assert figures(alignment.alignment(alignment.links(docs, *PATHS)).collect()) == want
    monkeypatch.setattr(alignment, "HOT", 3)  # most pairs join by key
    assert figures(alignment.alignment(alignment.links(docs, *PATHS)).collect()) == want
    assert alignment.alignment(alignment.links(docs.limit(0), *PATHS)).collect() == []


def test_special_strings_and_pieces(spark):
    rows = [(1, "a <|endoftext|> <s> b"), (2, "tab\tand\nline  two"), (3, "▁ x"), (4, "ﬁ ½"), (5, "word%d " * 5)]
    rows += [(6, " ".join(f"w{k} {k * 7}x" for k in range(40_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = sorted(((k, *p) for (k, _), p in zip(rows[:5], plain([t for _, t in rows[:5]]))), key=repr)
    assert figures(alignment.alignment(alignment.links(docs.where("doc_id < 6"), *PATHS)).collect()) == few
    out = {r.doc_id: r for r in alignment.alignment(alignment.links(docs, *PATHS)).collect()}
    assert out[6].n_links == out[6].n_a + out[6].n_b - out[6].n_groups > 0

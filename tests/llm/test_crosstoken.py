"""op11 against whole-text tokenisation and overlaps found byte by byte, on the given texts, random and odd ones."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from railtable.llm import crosstoken, queries
from railtable.llm.vocab import vocabulary_file

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "   ", "a", "  two  blanks   here ", "\tx\n \n y", "<|endoftext|> <s> </s>", "mark ▁ inside", "▁", "x" * 3000, "word " * 20_000, "é é 日本語 한국어 👩‍👩‍👧", "\x00\x1c \x1f a", "a\xa0 b　c",
    "don't we'll 'S 12345 3.14", " \n", "end\n", "a  \n  b", "UPPER lower MiXeD",
]


@pytest.fixture(scope="module")
def pair(spark):
    out = []
    for f in (crosstoken.BYTE_BPE, crosstoken.PIECES):
        with open(vocabulary_file(spark, f), "rb") as x:
            out.append(x.read())
    made = crosstoken.Pair(*out)
    made.specs = out
    return made


def brute(pair, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of each text, from byte ranges."""
    found, counts = [], Counter()
    for text in texts:
        a, b = pair.tokens(" " + text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        spans = []
        for ids, table in ((a, pair.bytes_a), (b, pair.bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        if not text or any(b"".join(t[i] for i in ids) != whole for ids, t in ((a, pair.bytes_a), (b, pair.bytes_b))):
            found.append(([], [], "", []))
            continue
        cover = {}
        for s, own in enumerate(spans):
            for k, (x, y, _) in enumerate(own):
                for at in range(x, y):
                    cover.setdefault(at, [None, None])[s] = k
        links = sorted({tuple(v) for v in cover.values()})
        both = sorted({y for _, y, _ in spans[0]} & {y for _, y, _ in spans[1]})
        groups = [([], []) for _ in both]
        for s, own in enumerate(spans):
            g = 0
            for _, y, i in own:
                groups[g][s].append(i)
                g += y == both[g]
        text_ = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        named = [(spans[0][p][2], spans[1][q][2]) for p, q in links]
        counts.update(named)
        found.append((a, b, text_, named))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (len(a), len(b), len(t.split(";")) if t else 0, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), hashlib.sha256(t.encode()).hexdigest() if a else "")
        for a, b, t, ls in found
    ]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("bound", [crosstoken.BROADCAST_PAIRS, 200, 0])
def test_odd_texts(spark, pair, bound):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("aabeinost  ▁'é́日 \x1c09\n") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += [" ".join(rng.choice(["internationalization", "the", "Straße", "naïve", "xqzt", "12345", "hello-world"]) for _ in range(50)) for _ in range(20)]
    docs = spark.createDataFrame([(k if k % 40 else None, t, "p", "g", 5) for k, t in enumerate(texts)], "doc_id long, text string, pairs string, groups string, counts int").repartition(5)
    got = crosstoken.with_scores(crosstoken.digest(crosstoken.align(docs)), bound)
    want = [(k if k % 40 else None, *r) for k, r in enumerate(brute(pair, texts))]
    assert rows(got, *COLUMNS) == sorted(want, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_query(spark, pair):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert rows(queries.op11_cross_tokenizer_alignment(spark, SF), *COLUMNS) == [(d.doc_id, *r) for d, r in zip(docs, brute(pair, [d.text for d in docs]), strict=True)]


def test_pieces_make_whole_texts(pair):
    """Tokens of the pieces are those of the whole text, and windows are remembered by their ids."""
    quick = crosstoken.Pair(*pair.specs, crosstoken.in_merge_order(pair.specs[0]))
    assert quick.quick is not None
    for own in (pair, quick):
        for t, got in zip(ODD, own.texts_of([t or "" for t in ODD]), strict=True):
            if got:
                ids = {n: [np.frombuffer(x, "<u2").tolist() for x in (k[: 2 * c], k[2 * c + 2 :])] for k, n in own.windows.items() for c in [own.counts[4 * n]]}
                assert tuple([i for n in got for i in ids[n][s]] for s in (0, 1)) == own.tokens(" " + t)
                assert "".join(own.split(t)) == " " + t
    size = len(pair.texts)
    again = next(iter(pair.windows))
    pair.align([again, again])
    assert len(pair.texts) == size == len(pair.windows)


def test_no_rows_and_groups_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert crosstoken.with_scores(crosstoken.digest(crosstoken.align(none))).count() == 0
    named = spark.createDataFrame([("a", "one two"), (None, None)], "name string, body string")
    assert rows(crosstoken.align(named, id_col="name", text_col="body"), "doc_id", "groups", "n_links") == [(None, "", 0), ("a", "530|624;734|989", 2)]

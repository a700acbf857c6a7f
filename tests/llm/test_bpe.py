"""op13 against the tokenizers library and against plain merging, on the given texts, random and odd ones."""

import hashlib
import os
import random

import numpy as np
import pytest
from conftest import rows

from railtable.llm import bpe, queries
from railtable.llm.vocab import vocabulary_file

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " \t\n\x0b\x0c\r ", "\xa0", "\x1c\x1d", "a", "a" * 1001, "ab" * 20_000, "the" * 5_000, "<|endoftext|>", "x<|startoftext|><|endoftext|>y z", "<|ENDOFTEXT|> <|endoftext", "ΑΣ ΣΑΣ İ ǅ ﬁ é é ́b",
    "각 각", "日本語テキスト", "it's WE'LL 'S 12½٣", "tab\tnew\nline", "x</w> y", "\x00\x01", "👩‍👩‍👧 🏳️", " lead", "trail ", "word " * 30_000,
]


@pytest.fixture(scope="module")
def spec(spark):
    with open(vocabulary_file(spark, bpe.VOCABULARY), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def lib(spec):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec.decode())


def test_merges(spec):
    """Backtracking gives what merging by rank, leftmost first, gives."""
    own, rng = bpe.Bpe(spec), random.Random(1)
    some = [own.spelled(t) for t in rng.sample(sorted(own.ids), 3000)]
    for n in range(3000):
        word = "".join(x for x in rng.choices(some, k=rng.randrange(1, 5)) if ord(x[-1]) < bpe.LAST) if n % 2 else "".join(rng.choice("aabeinost") for _ in range(rng.randrange(1, 40)))
        if not word:
            continue
        symbols = own.word(word)
        out = [next(i for i in (own.ids.get(c), own.ids.get(chr(max(0, ord(c) - bpe.LAST)) + own.end)) if i is not None) for c in symbols]
        while found := [(own.merged[p], k) for k, p in enumerate(zip(out, out[1:], strict=False)) if p in own.merged]:
            _, k = min(found)
            out[k : k + 2] = [made(own, out[k], out[k + 1])]
        assert own.encode_symbols(symbols) == out, word


def made(own, x, y):
    if not hasattr(own, "by_rank"):
        own.by_rank = {r: i for i, r in enumerate(own.born) if r >= 0}
    return own.by_rank[own.merged[x, y]]


def test_long_words_take_linear_work(spec):
    own = bpe.Bpe(spec)
    steps = []
    for n in (2_000, 4_000):
        asked = 0
        plain = own.compatible

        def count(x, y, plain=plain):
            nonlocal asked
            asked += 1
            return plain(x, y)

        own.compatible = count
        own.encode_symbols(own.word("etaoin" * n))
        own.compatible = plain
        steps.append(asked)
    assert steps[1] < 2.2 * steps[0]


@pytest.mark.parametrize("what", ["odd", pytest.param("given", marks=pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here"))])
def test_like_the_library(spark, lib, what):
    if what == "odd":
        rng = random.Random(2)
        texts = ODD + ["".join(rng.choice("aabeinost'<|>ΑΣé́日 \x1c ․09½\n") for _ in range(rng.randrange(80))) for _ in range(500)]
        docs = spark.createDataFrame([(k if k % 50 else None, t, 3, "x", "y") for k, t in enumerate(texts)] * 2, "doc_id long, text string, ids int, decoded string, end string")
    else:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = bpe.digest(bpe.decode(bpe.encode(docs))) if what == "odd" else queries.op13_bpe_backtracking(spark, SF)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def test_forgetting_and_small_batches(spark, lib, monkeypatch):
    """Bounds on what is remembered change nothing (the bounds are read in the task, so the encoder is called here)."""
    own = bpe.Bpe(lib.to_str().encode())
    monkeypatch.setattr(bpe, "PAIRS", 3)
    for t in ODD:
        assert np.frombuffer(b"".join(map(own.encode_piece, (t or "").encode().split())), np.int32).tolist() == lib.encode(t or "", add_special_tokens=False).ids


def test_no_rows_and_text_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digest(bpe.decode(bpe.encode(none))).count() == 0
    named = spark.createDataFrame([("a", "one two"), (None, None)], "name string, body string")
    got = bpe.decode(bpe.encode(named, id_col="name", text_col="body"))
    assert rows(got, "doc_id", "decoded") == [(None, ""), ("a", "one</w> two</w>")]


def test_a_file_the_method_cannot_take(spec):
    import json

    broken = json.loads(spec)
    broken["model"]["merges"].append(broken["model"]["merges"][0])
    with pytest.raises(ValueError, match="twice"):
        bpe.Bpe(json.dumps(broken).encode())

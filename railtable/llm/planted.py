"""Labelled findings where nobody has labelled any: values of known kinds written into copies of given documents.

The generator knows nothing of how candidates are looked for: it writes secrets as people leave them behind (assigned, in addresses, in headers, bare) and, as often, look-alikes of
the same lengths in the same places (digests, commit and trace ids, versions, counters named token, examples and references in place of a value), each with its label."""

from __future__ import annotations

import base64
import hashlib
import random
import string
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm.common import bounded_ids

#: Documents that get plants, and plants in each.
DOCUMENTS, EACH = 4000, 4
_WORD = "river harbour station signal platform morning letter garden winter silver window market bridge summer number copper meadow engine ticket corner".split()
_ALNUM, _LOWER, _HEX = string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, "0123456789abcdef"


def _some(r: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(r.choices(alphabet, k=r.randint(low, high)))


def _pass(r: random.Random) -> str:
    """A password as people make them: a word bent, or random."""
    if r.random() < 0.5:
        w = r.choice(_WORD)
        return w.capitalize() + r.choice("!@#$%&*-_") + str(r.randint(10, 9999)) + r.choice(["", "!", "x", "Q"])
    return _some(r, _ALNUM + "!#%&*+-=?", 9, 24)


def _value(r: random.Random) -> str:
    return r.choice([
        lambda: _some(r, _ALNUM, 20, 64), lambda: _some(r, _HEX, 32, 40), lambda: base64.b64encode(r.randbytes(r.randint(16, 48))).decode(), lambda: "sk_live_" + _some(r, _ALNUM, 24, 32),
        lambda: "AKIA" + _some(r, string.ascii_uppercase + string.digits, 16, 16), lambda: "ghp_" + _some(r, _ALNUM, 36, 36), lambda: "xoxb-" + _some(r, string.digits, 10, 12) + "-" + _some(r, _ALNUM, 24, 24),
        lambda: _some(r, _LOWER + "-_", 24, 40),
    ])()


def _secret(r: random.Random) -> tuple[str, str, str]:
    """(text before, value, text behind)."""
    name = r.choice(["api_key", "API_TOKEN", "clientSecret", "secret_key", "auth_token", "AWS_SECRET_ACCESS_KEY", "DB_PASS", "db.password", "password", "passwd", "passphrase", "pwd", "private_token", "access-key", "ENCRYPTION_KEY"])
    quote = r.choice(['"', "'", ""])
    if "pass" in name.lower() or name == "pwd":
        v = _pass(r)
        return f"{name}{r.choice([' = ', '=', ': '])}{quote}", v, quote
    return r.choice([
        lambda: (f"{name}{r.choice([' = ', '=', ': '])}{quote}", _value(r), quote), lambda: ("Authorization: Bearer ", _some(r, _ALNUM + "-_", 30, 80), ""),
        lambda: (f'"{name}": "', _value(r), '",'), lambda: (f"https://example.org/v1/items?{name}=", _some(r, _ALNUM, 20, 40), "&page=2"),
        lambda: ("the key is ", _value(r), " please rotate"), lambda: ("export " + name.upper().replace("-", "_").replace(".", "_") + "=", _value(r), ""), lambda: ("login with ", _value(r), ""),
    ])()


def _lookalike(r: random.Random) -> tuple[str, str, str]:
    hexes = lambda: hashlib.new(r.choice(["md5", "sha1", "sha256"]), r.randbytes(8)).hexdigest()
    words = lambda n: r.choice("-_./").join(r.choices(_WORD, k=n))
    return r.choice([
        lambda: (r.choice(["commit ", "sha256: ", "md5 = ", "checksum: ", "etag ", "digest="]), hexes(), ""), lambda: (r.choice(["trace id ", "request: ", "uuid=", "id "]), str(uuid.UUID(int=r.getrandbits(128))), ""),
        lambda: (r.choice(["token count = ", "max_tokens: ", "tokens=", "auth attempts: "]), str(r.randint(100_000, 10**13)), ""), lambda: ("password: ", r.choice(["********", "<redacted>", "changeme-please", "see-the-vault-entry", "your_password_here"]), ""),
        lambda: ("api_key = ", r.choice(["os.environ[KEY]", "${API_KEY}", "config.get_key()", "process.env.API_KEY", "<your-api-key>", "YOUR_API_KEY_HERE"]), ""), lambda: ("path ", "/" + words(4) + "/" + r.choice(["index.html", "main.py", "notes-2024.txt"]), ""),
        lambda: ("release ", f"{words(2)}-{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 99)}-build{r.randint(100, 99999)}", ""), lambda: ("on ", f"20{r.randint(10, 29)}-0{r.randint(1, 9)}-{r.randint(10, 28)}T{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}", ""),
        lambda: ("class ", "".join(w.capitalize() for w in r.choices(_WORD, k=4)), ""), lambda: ("mail ", f"{r.choice(_WORD)}.{r.choice(_WORD)}{r.randint(1, 99)}@example.org", ""), lambda: ("tokenizer: ", words(3) + str(r.randint(1, 99)), ""),
        lambda: (r.choice(["", "from ", "write to ", "user=", "login: "]), f"{r.choice(_WORD)[:r.randint(3, 8)]}{r.choice('._-')}{_some(r, _LOWER, 2, 6)}@{r.choice(_WORD)}{r.choice(['', '1', '7'])}.{r.choice(['org', 'example.net', 'co.uk'])}", ""),
        lambda: (r.choice(["", "host ", "ip=", "auth from "]), ".".join(str(r.randint(1, 255)) for _ in range(4)), ""), lambda: (r.choice(["", "card ", "call ", "account "]), _some(r, string.digits, 13, 16), ""),
        lambda: ("order no ", _some(r, string.digits, 12, 20), ""), lambda: ("const ", "_".join(r.choices(_WORD, k=4)).upper(), " = 1"), lambda: ("https://example.org/", words(3) + "?page=" + str(r.randint(1, 9999)), ""),
    ])()


def plant(text: str, seed: object, each: int = EACH) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with `each` plants between its words, and their (start, end, label); the same for the same seed."""
    r = random.Random(f"plants {seed}")
    words = text.split(" ")
    spots = sorted(r.randint(0, len(words)) for _ in range(each))
    out, at, marks = [], 0, []
    for k in range(len(words) + 1):
        for _ in range(spots.count(k)):
            label = r.randint(0, 1)
            before, value, behind = (_secret if label else _lookalike)(r)
            marks.append((at + len(before), at + len(before) + len(value), label))
            out.append(before + value + behind)
            at += len(out[-1]) + 1
        if k < len(words):
            out.append(words[k])
            at += len(words[k]) + 1
    return " ".join(out), marks


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, most: int = DOCUMENTS) -> DataFrame:
    """Copies of up to `most` documents (those of the smallest hashes) with plants: (doc_id, text, path, marks), marks being what was planted as (at, until, label).
    Ids are new, below -1, so that rows of one id are told apart. Null texts are empty; without rows there are none."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"), (F.col(path_col).cast("string") if path_col else F.lit("")).alias("path"))
    ids = bounded_ids(rows, "_id", most).select("_id").distinct()
    some = rows.join(F.broadcast(ids), "_id").select((-2 - F.monotonically_increasing_id()).alias("doc_id"), F.xxhash64("_id", "text").alias("seed"), "text", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_, seeds, texts, paths = (c.to_pylist() for c in batch.columns)
            made = [plant(t or "", s) for s, t in zip(seeds, texts, strict=True)]
            marks = pa.array([[{"at": a, "until": b, "label": y} for a, b, y in m] for _, m in made], pa.list_(pa.struct([("at", pa.int32()), ("until", pa.int32()), ("label", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array(ids_, pa.int64()), pa.array([t for t, _ in made], pa.string()), pa.array(paths, pa.string()), marks], names=["doc_id", "text", "path", "marks"])

    return some.mapInArrow(run, "doc_id long, text string, path string, marks array<struct<at int, until int, label int>>")


def labelled(found: DataFrame, marks: DataFrame) -> DataFrame:
    """Findings (doc_id, start, candidate) that lie on a planted value, with its label; others are left out."""
    m = marks.select("doc_id", F.inline("marks"))
    on = (F.col("start") < F.col("until")) & (F.col("start") + F.length("candidate") > F.col("at"))
    return found.join(m, "doc_id").where(on).drop("at", "until")

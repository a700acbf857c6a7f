"""Secret scans: pattern candidates, and a random forest that takes out the false positives."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A candidate: a run of token characters with a digit, or a long one without. '=' is taken as padding at its end only.
CANDIDATE = re.compile(r"[A-Za-z0-9_+/.\-@]{12,}+(?:={1,2}(?![\"'=]?[A-Za-z0-9_+/.\-@]))?")
LONG = 24
#: Names that stand before a credential; in an identifier they are whole parts (client_secret, apiKey), some its end (authtoken).
KEY_NAMES = (
    "token", "secret", "password", "passwd", "passphrase", "pwd", "pass", "psk", "api_key", "apikey", "access_key", "private_key", "secret_key", "signing_key",
    "encryption_key", "session_key", "account_key", "client_key", "auth", "credential",
)
KEY_PART = re.compile(r"_(?:" + "|".join(KEY_NAMES) + r"|[a-z]+(?:token|secret|password|passwd|apikey))s?\d*_")
#: A name and the assignment behind it, and the value there: a quoted string, or a run without spaces up to the next field of a query.
ASSIGNMENT = re.compile(r"(?<![\w.\-])([\w.\-]++)[\"'\])]{0,3}+\s*+[:=]++>?\s*+(?:(?i:bearer|basic)\s++)?")
QUOTED, BARE = re.compile(r"([\"'`])((?:(?!\1)[^\n\\]|\\.){6,}+)\1"), re.compile(r"[\"'`]?((?:(?![&;,][\w.\-]+=)\S){6,})")
#: A block that is a secret as a whole, in the form that OpenSSL writes; without its end as far as its lines of base64 go.
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,\-]*?-----END [A-Z ]*PRIVATE KEY-----|(?:\s*+[A-Za-z0-9+/=]{16,}+)++)")
#: Forms that issuers document for their keys; fixed values.
ISSUED_FORMS = r"^(?:A(?:KIA|SIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|glpat-[\w\-]{20,}|xox[abprs]-[\w\-]{10,}|AIza[\w\-]{35}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|eyJ[\w\-]+\.eyJ[\w\-]+\.[\w\-]+|-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*)$"
#: Kinds of values that are public by their form: numbers, dates and versions, mail addresses, web addresses, plain names and paths of words.
PUBLIC_FORMS = r"^(?:[\d.,:/+\-]+|[\w.+\-]+@[\w\-]+(?:\.[\w\-]+)+|(?i:https?:|www\.).*|/*[A-Za-z]+(?:[-_/.@+]+[A-Za-z]+)*/*[.\-]*\d{0,4}[.\-]*)$"
#: Bound of what is fitted on: findings of each label. The dictionary is the most frequent words of all texts, so many.
FINDINGS, DICTIONARY_WORDS = 5000, 20_000
TREES, LEVELS, SEED = 20, 6, 11
FEATURES = [
    "length", "entropy", "digits", "uppers", "hexes", "symbols", "distinct", "switches", "runs", "known",
    "path_depth", "path_test", "path_docs", "before_key", "before_sign", "quoted", "before_length", "after_length",
]
#: Features that say nothing about key names beside a candidate: what a forest learns from where key names made the labels.
OWN = [f for f in FEATURES if f not in ("before_key", "before_sign")]
FOUND = "doc_id long, start int, candidate string, assigned boolean, " + ", ".join(f"{f} double" for f in FEATURES)


def kind_of(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s"


def is_key(name: str) -> bool:
    """Does an identifier name a credential: GITHUB_TOKEN, clientSecret, db.password2; not tokenizer or author?"""
    parts = re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower())
    return KEY_PART.search("_" + "_".join(parts) + "_") is not None


def candidates(text: str) -> Iterator[tuple[int, str, bool]]:
    """(start, candidate, assigned): private key blocks and the values behind key names, and the other candidates beside them, in order
    of start."""
    spans: list[tuple[int, str]] = [(m.start(), m.group()) for m in PRIVATE_KEY.finditer(text)] if "PRIVATE KEY-----" in text else []
    blocks = [(at, at + len(b)) for at, b in spans]
    end = 0
    for m in ASSIGNMENT.finditer(text):
        if m.end() < end or not is_key(m.group(1)):
            continue
        if v := QUOTED.match(text, m.end()):
            at, value = v.start(2), v.group(2)
        elif v := BARE.match(text, m.end()):
            at, value = v.start(1), v.group(1).rstrip(".,;)]}>\"'`")
            if len(value) < 6 or value[0] in "{[(":
                continue
        else:
            continue
        if any(a < at + len(value) and at < b for a, b in blocks):
            continue
        spans.append((at, value))
        end = at + len(value)
    spans.sort()
    k = 0
    for m in CANDIDATE.finditer(text):
        c = m.group()
        if c[-1] == "=" and len(c) % 4:  # not the padding of base64
            c = c.rstrip("=")
        while k < len(spans) and spans[k][0] + len(spans[k][1]) <= m.start():
            yield *spans[k], True
            k += 1
        inside = k < len(spans) and spans[k][0] < m.start() + len(c)
        if not inside and (len(c) >= LONG or any(map(str.isdigit, c))):
            yield m.start(), c, False
    for at, value in spans[k:]:
        yield at, value, True


def features(candidate: str, before: str, after: str, path: str, dictionary: frozenset[str]) -> list[float]:
    """The numbers of FEATURES: of the candidate itself, its path, and the words on both sides."""
    n, kinds = len(candidate), "".join(map(kind_of, candidate))
    counts = Counter(candidate)
    words = re.findall(r"[a-z]{3,}", candidate.lower())
    known = 0
    for w in words:
        i = 0
        while i < len(w) - 2:  # the longest dictionary word at each place
            j = next((j for j in range(min(len(w), i + 12), i + 2, -1) if w[i:j] in dictionary), 0)
            known, i = (known + j - i, j) if j else (known, i + 1)
    near = before.split()[-2:]
    path = path.lower()
    return [
        float(n), -sum(c / n * math.log2(c / n) for c in counts.values()), kinds.count("d") / n, kinds.count("u") / n,
        sum(c in "0123456789abcdefABCDEF" for c in candidate) / n, kinds.count("s") / n, len(counts) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n, sum(a == b for a, b in zip(candidate, candidate[1:], strict=False)) / n, known / n,
        float(path.count("/")), float("test" in path or "example" in path), float("doc" in path or path.endswith(".md")),
        float(any(k in w.lower() for w in near for k in KEY_NAMES)), float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:] in "\"'" and before != ""),
        float(len(near[-1]) if near else 0), float(len((after.split() or [""])[0])),
    ]


def scan(docs: DataFrame, dictionary: list[str], id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """Every candidate of every whole text, with its place, its features and whether a key name is assigned to it.
    Null texts and paths are empty; repeated rows repeat their candidates. No shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(frozenset(dictionary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        shape = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("candidate", pa.string()), ("assigned", pa.bool_()), *((f, pa.float64()) for f in FEATURES)])
        for batch in batches:
            out: list[list] = []
            for doc, text, path in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py() or ""
                for start, c, assigned in candidates(text):
                    before, after = text[max(0, start - 60) : start], text[start + len(c) : start + len(c) + 40]
                    out.append([doc, start, c, assigned, *features(c, before, after, path or "", words)])
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t.type) for k, t in enumerate(shape)], schema=shape)
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t.type) for k, t in enumerate(shape)], schema=shape)

    path = F.col(path_col).cast("string") if path_col else F.lit("")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), path.alias("path")).mapInArrow(run, FOUND)


def common_words(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The dictionary: the most frequent lower-case words of 3 to 12 letters of all texts; of equally frequent ones the first by name."""
    said = docs.select(F.explode(F.split(F.lower(F.col(text_col).cast("string")), "[^a-z]+")).alias("w")).where(F.length("w").between(3, 12))
    return [r["w"] for r in said.groupBy("w").count().orderBy(F.desc("count"), "w").limit(words).collect()]


def train(findings: DataFrame, most: int = FINDINGS, inputs: list[str] | None = None) -> PipelineModel | None:
    """Fits the forest on labelled findings (what scan() returns and label 0 or 1; null labels are left out), up to `most` of each label,
    those with the smallest hashes; equal findings count each. `inputs`: the features it may look at (all). None where a label has no
    finding."""
    inputs = inputs or FEATURES
    names = ["label", *inputs]
    part = [findings.where(F.col("label") == y).select(*names, F.xxhash64(*FEATURES, "candidate", "doc_id", "start").alias("_h")).orderBy("_h").limit(most).drop("_h") for y in (0, 1)]
    rows = part[0].unionByName(part[1]).withColumn("label", F.col("label").cast("double")).repartition(8, "length")
    got = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(got) < 2:
        return None
    forest = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=TREES, maxDepth=LEVELS, seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="v"), forest]).fit(rows)


def judge(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """One row for each finding: doc_id, start, candidate, score (the forest's share for a secret), is_secret (0.5 or more). Without a model,
    the assignment of a key name decides. Findings of null ids and repeated findings are judged as they come; no findings: no rows."""
    if model is None:
        out = found.withColumn("score", F.col("assigned").cast("double"))
    else:
        out = model.transform(found).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return out.select("doc_id", "start", "candidate", "score", (F.col("score") >= 0.5).alias("is_secret"))


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings labelled by what stands around them or by their form, where nobody has labelled any: a value that a key name is assigned
    to, or that has an issuer's form, is a secret; one without either and of a public form is not. All others (random but not assigned, or
    assigned and of a public form) stay unlabelled, and the forest alone judges them. Train on these labels with inputs=OWN, which hold
    none of these rules."""
    public, issued = F.col("candidate").rlike(PUBLIC_FORMS), F.col("candidate").rlike(ISSUED_FORMS)
    label = F.when(issued | (F.col("assigned") & ~public), 1).when(~F.col("assigned") & public, 0)
    return found.withColumn("label", label).where("label IS NOT NULL")

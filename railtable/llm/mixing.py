"""Mixing to target weights by soft membership, in DataFrame functions only."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtable.llm.common import bounded_ids, cut, drop_cut, text_key

#: Bound of what the classifier is fitted on: labelled texts of each domain.
TEXTS = 400
#: Word pieces are counted in so many hash buckets, with so much added to each count.
BUCKETS, ADDED = 8192, 0.2
#: Calibration: how much of the summed evidence counts, and how much of the prior is mixed in; chosen on held-out labels.
TEMPERS, FLOORS = (0.02, 0.05, 0.1, 0.2, 0.35, 0.6, 1.0), (1e-6, 1e-4, 1e-3, 5e-3, 0.01, 0.02, 0.05)
#: Rounds of projected gradient at most, and the largest miss of a target, as a share of all tokens, that is good enough.
ROUNDS, MISS = 200, 1e-4
#: Totals that hardly move over so many rounds are those of the least squares fit.
STILL = 10
#: With a highest rate the budget is so much smaller than pure memberships would allow: mixed ones reach a little less.
SLACK = 0.005
SPACES = "[\\x20\\x09-\\x0D]+"


def n_tokens(text: Column) -> Column:
    """Runs of other characters than ASCII white space. Null: 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def words(rows: DataFrame) -> DataFrame:
    """A row for each word of the lower-cased text (white space parts words), with all other columns; at least one row a text,
    whose word may be empty."""
    rest = [c for c in rows.columns if c != "text"]
    return rows.select(*rest, F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), SPACES)).alias("w"))


def buckets(word: Column) -> list[Column]:
    """The hash buckets of a word's first and last three characters."""
    return [F.pmod(F.xxhash64(F.lit(k), F.substring(word, at, 3)), F.lit(BUCKETS)).cast("int") for k, at in enumerate((1, -3))]


class Classifier:
    """Naive Bayes over counted word pieces. `odds` has for each domain but the first its log odds against the first, by bucket;
    `temper` scales their sum over a text, and `floor` of the prior is mixed in, so that long texts do not saturate."""

    def __init__(self, domains: list[str], prior: list[float], odds: list[list[float]], temper: float = 1.0, floor: float = 1e-6):
        self.domains, self.prior, self.odds, self.temper, self.floor = domains, prior, odds, temper, floor

    def evidence(self, rows: DataFrame) -> DataFrame:
        """`rows` (text and others) with tokens and e, the summed log odds of the domains but the first. Words are counted as rows
        inside a task and leave it as one row a text."""
        keys = [c for c in rows.columns if c != "text"]
        at = rows.select(F.monotonically_increasing_id().alias("_row"), *keys, "text")
        said = words(at).select("_row", *keys, (F.col("w") != "").cast("int").alias("one"), *[b.alias(f"_b{k}") for k, b in enumerate(buckets(F.col("w")))])
        # one row with all odds, as a subquery: as literals they would be written out in every text of the plan that the driver keeps
        table = rows.sparkSession.createDataFrame([([[round(x, 3) for x in o] for o in self.odds],)], "odds array<array<double>>").scalar()
        odds = [F.get(table, F.lit(k)) for k in range(len(self.odds))]
        sums = [F.sum(F.when(F.col("one") == 1, F.get(o, F.col("_b0")) + F.get(o, F.col("_b1")))) for o in odds]
        out = said.groupBy("_row", *keys).agg(F.sum("one").cast("long").alias("tokens"), *[s.alias(f"_e{k}") for k, s in enumerate(sums)])
        return out.select(*keys, "tokens", F.array(*[F.coalesce(f"_e{k}", F.lit(0.0)) for k in range(len(odds))]).cast("array<double>").alias("e"))

    def posteriors(self, e: Column) -> Column:
        """array<double>: P(domain | text) from its evidence. Each step's array is bound once (a one-element transform)."""
        prior = F.array(*[F.lit(p) for p in self.prior])
        scaled = F.transform(F.concat(F.array(F.lit(0.0)), e), lambda x, k: F.log(F.get(prior, k)) + x * F.lit(self.temper))
        once = lambda a, f: F.get(F.transform(F.array(a), f), F.lit(0))
        parts = once(scaled, lambda logs: once(F.array_max(logs), lambda top: F.transform(logs, lambda x: F.exp(x - top))))
        shares = once(parts, lambda q: once(F.aggregate(q, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(q, lambda x: x / total)))
        return F.transform(shares, lambda x, k: x * F.lit(1.0 - self.floor) + F.lit(self.floor) * F.get(prior, k))


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: int = TEXTS) -> Classifier:
    """Fits on `labelled` (id, domain): piece counts from three quarters of up to `texts` texts a domain (those with the smallest
    hashes), temper and floor by the likelihood of the other quarter's labels; priors from all labelled ids. Null domains and ids
    teach nothing; of several labels of an id the first by name counts. Numbers by domain and bucket reach the driver, no text."""
    known = labelled.select(F.col(id_col).alias("doc_id"), F.col("domain").cast("string").alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = cut(known, "labelled")
    shares = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    domains, every = sorted(shares), sum(shares.values())
    if not domains:
        drop_cut(known)
        return Classifier([], [], [])
    part = (F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(4)) == 0).alias("aside")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = cut(rows.join(F.broadcast(bounded_ids(known, "doc_id", texts, by=["domain"])), "doc_id").select("domain", part, "text"), "fitted")
    said = words(rows.where("NOT aside").select("domain", "text")).where("w <> ''")
    counts = [[ADDED] * BUCKETS for _ in domains]
    for r in said.select("domain", F.explode(F.array(*buckets(F.col("w")))).alias("b")).groupBy("domain", "b").count().collect():
        counts[domains.index(r["domain"])][r["b"]] += r["count"]
    logs = [[math.log(x / total) for x in c] for c in counts for total in (sum(c),)]
    model = Classifier(domains, [shares[d] / every for d in domains], [[x - y for x, y in zip(o, logs[0], strict=True)] for o in logs[1:]])
    if len(domains) > 1:
        seen = model.evidence(rows.where("aside AND text IS NOT NULL").select("domain", "text"))
        # the evidence of a quarter of the bounded sample: K - 1 numbers a text
        held = [(domains.index(r["domain"]), [0.0, *r["e"]]) for r in seen.select("domain", "e").collect()]

        def likelihood(temper: float, floor: float) -> float:
            total = 0.0
            for own, e in held:
                logs = [math.log(p) + x * temper for p, x in zip(model.prior, e, strict=True)]
                top = max(logs)
                parts = [math.exp(x - top) for x in logs]
                total += math.log((1.0 - floor) * parts[own] / sum(parts) + floor * model.prior[own])
            return total

        if held:
            model.temper, model.floor = max(((t, f) for t in TEMPERS for f in FLOORS), key=lambda x: likelihood(*x))
    drop_cut(rows)
    drop_cut(known)
    return model


def rates(members: DataFrame, weights: list[float], max_rate: float | None = None, rounds: int = ROUNDS, miss: float = MISS) -> tuple[DataFrame, list[list[float]], list[float]]:
    """Fits the nonnegative rate of each row of `members` (tokens, p array<double>) so that sum(rate * tokens * p) meets the
    weights times a budget, from rate 1 for all, by projected gradient on the squared misses, each weighed by the size of its domain.

    In the metric weighed by tokens a step moves a row's rate by p . g with the same g for all rows, so a row's rate
    is a fold of max(0, rate - p . g) over the steps: nothing is stored by row. A round is one aggregation of K sums;
    a domain's step is one over its row of sum(tokens * p * p), so that small domains move as fast as large ones, with momentum. Every few steps the
    rates so far are cut, so that the fold stays short. With max_rate the budget is the largest that needs no higher
    rate where memberships are pure, less SLACK, and rates are cut off there. Where no rates meet the targets, the least squares
    fit is returned with a warning that tells the misses; rounds that run out before either are an error."""
    k = len(weights)
    dot = lambda g: sum((F.get("p", F.lit(i)) * F.lit(float(g[i])) for i in range(1, k)), F.get("p", F.lit(0)) * F.lit(float(g[0])))
    t = F.col("tokens").cast("double")
    first = members.agg(*[F.sum(t * F.get("p", F.lit(i))) for i in range(k)], *[F.sum(t * F.get("p", F.lit(i)) * F.get("p", F.lit(j))) for i in range(k) for j in range(k)]).first()
    have, gram = [x or 0.0 for x in first[:k]], [[first[k + i * k + j] or 0.0 for j in range(k)] for i in range(k)]
    total, norm = sum(have), [sum(map(abs, row)) for row in gram]
    scale = sum(weights) or 1.0
    budget = total
    if max_rate is not None:
        budget = (1.0 - SLACK) * min([total * max_rate] + [max_rate * have[i] / (weights[i] / scale) for i in range(k) if weights[i] > 0])
    want = [budget * w / scale for w in weights]
    start = 1.0 if max_rate is None else min(1.0, max_rate)
    now, steps = members.withColumn("rate", F.lit(start)), []
    if not any(norm) or not total:
        return now, [], want
    before, last, seen, written = [0.0] * k, [0.0] * k, [], None
    for step in range(rounds):
        got = now.agg(*[F.sum(t * F.get("p", F.lit(i)) * F.col("rate")) for i in range(k)]).first()
        off = [(got[i] or 0.0) - want[i] for i in range(k)]
        if max(map(abs, off)) <= miss * total:
            return now, steps, want
        seen.append(off)
        if step >= STILL and max(abs(a - b) for a, b in zip(off, seen[-1 - STILL], strict=True)) <= 0.2 * miss * total:
            warnings.warn(f"no rates meet the targets; least squares misses, as shares of all tokens: {[round(o / total, 6) for o in off]}", stacklevel=2)
            return now, steps, want
        speed = step / (step + 3.0) if sum(a * b for a, b in zip(off, last, strict=True)) <= 0 else 0.0
        g = [(o / n if n else 0.0) + speed * b for o, n, b in zip(off, norm, before, strict=True)]
        before, last = g, [-x for x in off]
        steps.append(g)
        moved = F.greatest(F.lit(0.0), F.col("rate") - dot(g))
        now = now.withColumn("rate", moved if max_rate is None else F.least(F.lit(float(max_rate)), moved))
        if (step + 1) % 8 == 0:
            now, old = cut(now, "rates"), written
            written = now
            if old is not None:
                drop_cut(old)
    raise RuntimeError(f"the rates did not converge in {rounds} rounds; misses: {off}")


def _mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], id_col: str, text_col: str, max_rate: float | None) -> tuple[DataFrame, list[str]]:
    """A row for each row of `docs`: doc_id, key (of its text), tokens, p, rate, copies; and the names of p's domains."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = train(rows, labelled.withColumnRenamed(id_col, "doc_id"), texts=TEXTS)
    aims = [float(weights.get(d, 0.0)) for d in model.domains]
    keyed = rows.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    if not any(aims):
        now = keyed.select("doc_id", "key", n_tokens(F.col("text")).alias("tokens"), F.array(F.lit(1.0)).alias("p"), F.lit(1.0).alias("rate"))
        names = ["all"]
    else:
        members = cut(model.evidence(keyed).select("doc_id", "key", "tokens", model.posteriors(F.col("e")).alias("p")), "members")
        now, _, _ = rates(members, aims, max_rate)
        names = model.domains
    chance = (F.pmod(F.xxhash64(F.lit(29), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "key"), F.lit(2**40)) + 0.5) / float(2**40)
    whole = F.floor("rate")
    return now.select("doc_id", "key", "tokens", "p", "rate", (whole + (chance < F.col("rate") - whole).cast("int")).cast("int").alias("copies")), names


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", max_rate: float | None = None) -> DataFrame:
    """One row for each row of `docs`: doc_id, tokens, domain (likeliest), posteriors (map), rate (expected copies), copies.

    copies rounds the rate up or down by a hash of id and text, so that its expectation is the rate. Domains without a weight are
    aimed at 0 tokens; weights of unknown domains are ignored. Null and empty texts have no tokens and the prior as posteriors; a tie
    of posteriors goes to the first domain by name. Repeated rows get equal rows; rows of one id with different texts, and rows with
    a null id, get each their own. Other columns are not looked at. Without labels every rate is 1. No rows: no rows.
    """
    now, names = _mixed(docs, labelled, weights, id_col, text_col, max_rate)
    listed = F.array(*map(F.lit, names))
    return now.select(
        "doc_id", "tokens", F.get(listed, (F.array_position("p", F.array_max("p")) - 1).cast("int")).alias("domain"),
        F.map_from_arrays(listed, F.col("p")).alias("posteriors"), "rate", "copies",
    )


def take(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that a mix with rates up to 1 takes: none twice, each by its own rate. A row is known
    by its id and text: repeated rows go or stay together, different texts of one id (or of a null id) each on their own. No rows: no rows."""
    mixed, _ = _mixed(docs, labelled, weights, id_col, text_col, 1.0)
    gone = mixed.where("copies = 0").select(F.col("doc_id").alias("_gone"), F.col("key").alias("_key")).distinct()
    same = docs[id_col].eqNullSafe(gone["_gone"]) & (text_key(docs[text_col].cast("string")) == gone["_key"])
    return docs.join(gone, same, "left_anti")

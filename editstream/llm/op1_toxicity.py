"""Toxicity by a weighted finite-state pattern grammar.

Lexicon. Insults are learned: over a bounded, documented sample of labelled
training documents Spark counts in how many distinct places (neighbouring
words, so that near copies count once), in toxic texts or not, each word and
each word beginning occurs; entries of a high toxic share that passes a
likelihood-ratio test (corrected for the number tried) get their log odds as
weight, beginnings only if no clean text has one. Threats, targets, negations and words
of reported speech are short fixed lists in the corpus's languages.

Grammar. A clause (a stretch without ``. ! ? ; :`` or line end) becomes a string
of symbols (insult, threat, target, negation, report, quote, other) that five
transducers read in composition, each what the one before it writes. Their arcs
are tables; the composed machine is the part of their product that texts reach.

* negation: writes a hit within reach of a negation word as negated;
* reported speech: after a word of saying, or inside quotes, a hit is reported;
* target: a hit near a target is aimed: behind one by its state, before one by
  a guess that a target within reach must confirm;
* threat: a threat word is a hit only if a target follows within reach (a guess);
* insult: writes the kind of what is left of a hit.

A path whose guess is not confirmed is not accepted. A hit weighs its entry's
weight times the factor of its kind (``FACTORS``: aimed more than plain, reported
and negated less), and the accepted path of greatest weight is the clause's
reading. Clauses without a hit give nothing, so words of the fixed lists never
count alone. An insult that is aimed at nobody counts by its entry's weight: the
corpora mark such texts (a test measures the recall without it).

A document's weight goes through a logistic curve fitted on the training sample,
which never falls, so a negated or reported clause scores below the plain one.
Labels are read for fitting only; language, source and id never enter a score.

An automaton finds clauses with an entry; only those are read by the grammar.
Texts are scored whole, in tasks, without a shuffle.

Defined cases: a null or empty text has no clause and gets the curve's score
for none; without training labels of both kinds the lexicon is empty and the
score is the toxic share seen (0 if none); repeated labels of an id count as
toxic if one is; repeated rows are scored alike; a very long text is read clause
by clause, whole; equal readings of a clause are settled by the order of the arcs;
columns besides id and text are not read (kept ones travel along, whatever their
names but ``score``, ``predicted`` and ``sums``); an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fraction_key, read_table, slices, stored, tidy

FIT_ROWS = 10_000
"""Bound of the training sample: the toxic and the other rows of smallest seeded hash, half each at most."""
PREFIXES = (4, 5, 6, 7)
REACH = 4
DOUBT = 3.0
SHARE = 0.9

# Function words of the grammar, by language (en, de, fr, es).
THREATS = ("kill hurt destroy crush beat töten umbringen verletzen vernichten "
           "tuer frapper détruire écraser matar golpear destruir aplastar").split()
TARGETS = ("you your yours he she they them him du dich dir ihr euch sie er "
           "tu toi te vous ils elles él ella ellos usted ustedes ti").split()
NEGATIONS = ("not no never isn't aren't don't won't without nicht kein keine nie niemals ohne "
             "ne pas jamais sans nunca jamás sin").split()
REPORTS = ("said says say wrote writes called calls quoted claims claimed sagte sagt schrieb nannte "
           "dit écrit appelé dijo dice escribió llamó").split()
KINDS = ("plain", "aimed", "threat", "negated", "reported")
FACTORS = (1.0, 1.5, 6.0, 0.1, 0.2)
"""What a hit of each kind weighs; a threat's entry weight is 1."""
INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "insult threat target negation report quote other".split()
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER)

_CLAUSE = re.compile(r"[.!?;:\n]+")
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”„«»]")


class Model(NamedTuple):
    words: dict[str, float]
    beginnings: dict[str, float]
    curve: list[float]


class Machine(NamedTuple):
    """A transducer: arcs of (state, symbol read) to (state, symbol written); several
    arcs are guesses. A path that ends outside ``final`` is not accepted."""
    start: object
    arcs: dict[tuple, list[tuple]]
    final: frozenset


def negation_machine() -> Machine:
    """State: tokens that a negation word still reaches."""
    arcs = {}
    for left in range(REACH + 1):
        for s in SYMBOLS:
            rest = left if s == QUOTE else REACH if s == NEGATION else max(left - 1, 0)
            arcs[left, s] = [(rest, f"{s} negated" if rest and s in (INSULT, THREAT) else s)]
    return Machine(0, arcs, frozenset(range(REACH + 1)))


def reported_machine() -> Machine:
    """State: a word of saying was read, a quotation is open."""
    arcs, states = {}, [(said, quoted) for said in (False, True) for quoted in (False, True)]
    for said, quoted in states:
        for s in (*SYMBOLS, f"{INSULT} negated", f"{THREAT} negated"):
            to = (said or s == REPORT, quoted != (s == QUOTE))
            arcs[(said, quoted), s] = [(to, f"{s} reported" if any(to) and s in (INSULT, THREAT) else s)]
    return Machine((False, False), arcs, frozenset(states))


def _awaiting(due: int, symbol: str) -> int | None:
    """Tokens left for a guessed target after ``symbol`` (0: none is due); None if it failed to come."""
    if not due or symbol == QUOTE:
        return due
    return 0 if symbol == TARGET else due - 1 or None


def _written() -> tuple[str, ...]:
    return (*SYMBOLS, *(f"{s} {how}" for s in (INSULT, THREAT) for how in ("negated", "reported")))


def target_machine() -> Machine:
    """State: tokens that a target still reaches, tokens left for a target that was guessed."""
    arcs = {}
    for near in range(REACH + 1):
        for due in range(REACH + 1):
            for s in _written():
                after = near if s == QUOTE else REACH if s == TARGET else max(near - 1, 0)
                wait = _awaiting(due, s)
                out = [] if wait is None else [((after, wait), f"{s} aimed" if s == INSULT and after else s)]
                if s == INSULT and not after and wait is not None:
                    out.append(((after, wait or REACH), f"{s} aimed"))  # who waits longest decides for all
                arcs[(near, due), s] = out
    return Machine((0, 0), arcs, frozenset((near, 0) for near in range(REACH + 1)))


def threat_machine() -> Machine:
    """State: tokens left for the target of a threat. A threat without one is any word."""
    arcs = {}
    for due in range(REACH + 1):
        for s in (*_written(), f"{INSULT} aimed"):
            wait = _awaiting(due, s)
            plain = OTHER if s == THREAT else s
            arcs[due, s] = [] if wait is None else [(wait, plain)]
            if s == THREAT and wait is not None:
                arcs[due, s].append((wait or REACH, "threat hit"))
    return Machine(0, arcs, frozenset([0]))


def insult_machine() -> Machine:
    """One state; writes the kind of a hit, and nothing for what is none."""
    kind = {INSULT: "plain", f"{INSULT} aimed": "aimed", "threat hit": "threat",
            **{f"{s} {how}": how for s in (INSULT, THREAT) for how in ("negated", "reported")}}
    return Machine(0, {(0, s): [(0, kind.get(s, ""))] for s in (*_written(), f"{INSULT} aimed", "threat hit")}, frozenset([0]))


class Composed:
    """Transducers in composition; arcs of the product are made when first met."""

    def __init__(self, *machines: Machine):
        self.machines = machines
        self.start = tuple(m.start for m in machines)
        self.made: dict[tuple, list[tuple]] = {}

    def arcs(self, states: tuple, symbol: str) -> list[tuple]:
        found = self.made.get((states, symbol))
        if found is None:
            paths = [((), symbol)]
            for machine, state in zip(self.machines, states):
                paths = [((*done, to), out) for done, read in paths for to, out in machine.arcs[state, read]]
            found = self.made[states, symbol] = paths
        return found

    def accepts(self, states: tuple) -> bool:
        return all(s in m.final for m, s in zip(self.machines, states))

    def best(self, symbols: Iterable[tuple[str, float]]) -> tuple[float, ...]:
        """Entry weights by kind on the accepted path of greatest weight. What is held
        is a state's best sums, however long the clause."""
        live = {self.start: (0.0, (0.0,) * len(KINDS))}
        for symbol, weight in symbols:
            after = {}
            for states, (total, sums) in live.items():
                for to, kind in self.arcs(states, symbol):
                    value = total
                    if kind:
                        k = KINDS.index(kind)
                        value += FACTORS[k] * weight
                    if to not in after or value > after[to][0]:
                        after[to] = (value, (*sums[:k], sums[k] + weight, *sums[k + 1:]) if kind else sums)
            live = after
        # The path without guesses is always accepted.
        return max((x for states, x in live.items() if self.accepts(states)), key=lambda x: x[0])[1]


class Grammar:
    """The composed transducers over the clauses of a text."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        import ahocorasick

        self.words, self.beginnings = words, beginnings
        self.lengths = sorted({len(b) for b in beginnings}, reverse=True)
        # Of a word in several lists the first holds.
        self.symbols = {w: s for s, words in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)) for w in words}
        self.machine = Composed(negation_machine(), reported_machine(), target_machine(), threat_machine(), insult_machine())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for w in {*words, *beginnings, *THREATS}:
            self.automaton.add_word(w)
        self.automaton.make_automaton()

    def weight(self, token: str) -> float:
        found = self.words.get(token)
        if found is not None:
            return found
        for n in self.lengths:
            if len(token) >= n and (found := self.beginnings.get(token[:n])) is not None:
                return found
        return 0.0

    def clause(self, text: str, sums: list[float]) -> None:
        """Adds the clause's output weights to ``sums``, in the order of KINDS."""
        for i, w in enumerate(self.machine.best(map(self.symbol, _TOKEN.finditer(text)))):
            sums[i] += w

    def symbol(self, match: re.Match) -> tuple[str, float]:
        token = match[0]
        if not token[0].isalpha():
            return QUOTE, 0.0
        if w := self.weight(token):
            return INSULT, w
        symbol = self.symbols.get(token, OTHER)
        return symbol, 1.0 if symbol == THREAT else 0.0

    def read(self, text: str) -> list[float]:
        sums = [0.0] * len(KINDS)
        low = text.lower()
        edges = done = None
        for end, n in self.automaton.iter(low):
            start = end - n + 1
            if start and low[start - 1].isalpha():
                continue
            if edges is None:
                edges = iter([*[(m.start(), m.end()) for m in _CLAUSE.finditer(low)], (len(low), len(low))])
                clause_start, done = 0, -1
                stop, after = next(edges)
            if start <= done:
                continue
            while start >= after and after < len(low):
                clause_start = after
                stop, after = next(edges)
            self.clause(low[clause_start:stop], sums)
            done = stop
        return sums


def features(sums: list[float]) -> list[float]:
    """A text's weight; it grows with length, and its logarithm tells hardly more after the first."""
    return [math.log1p(sum(f * s for f, s in zip(FACTORS, sums)))]


def curve_score(curve: list[float], x: list[float]) -> float:
    z = curve[0] + sum(w * v for w, v in zip(curve[1:], x))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_curve(xs, ys, penalty: float = 0.05) -> list[float]:
    """Logistic regression with a ridge penalty, by Newton's method."""
    import numpy as np

    x = np.hstack([np.ones((len(xs), 1)), np.array(xs, float).reshape(len(xs), -1)])
    y = np.array(ys, float)
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def lexicon(train: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Entries and their weights from (text, toxic) rows."""
    docs = train.select("text", "toxic").dropDuplicates(["text"])
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda x: x != "")
    places = F.transform("w", lambda x, i: F.struct(x.alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("place")))
    seen = docs.select("toxic", words.alias("w")).select("toxic", F.inline(F.filter(places, lambda p: F.length(p["word"]) >= 3)))
    seen = stored(seen.groupBy("word", "place").agg(F.max("toxic").alias("toxic")), "places")
    totals = seen.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    total, toxic = totals["n"], totals["toxic"] or 0
    if not 0 < toxic < total:
        return {}, {}
    base = toxic / total
    starts = [F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in PREFIXES]
    entries = F.filter(F.array("word", *starts), lambda x: x.isNotNull())
    counts = stored(seen.select(F.explode(entries).alias("entry"), "place", "toxic").groupBy("entry", "place").agg(F.max("toxic").alias("toxic"))
                    .groupBy("entry").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")), "entries")
    tried = counts.count()
    share = (F.col("t") + 0.5) / (F.col("n") + 1.0)
    gain = F.col("n") * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))
    odds = F.log(share / (1 - share)) - math.log(base / (1 - base))
    pure = (share > SHARE) & (~F.col("entry").endswith("*") | (F.col("t") == F.col("n")))
    found = counts.filter(pure & (gain >= math.log(max(tried, 2)) + DOUBT)).select(
        "entry", odds.alias("w"), gain.alias("gain")).orderBy(F.desc("gain"), "entry").collect()  # words of the bounded sample
    weights = {r["entry"]: r["w"] for r in found}
    # A beginning stands for its words; of beginnings inside each other the shortest that holds.
    starts = {e[:-1]: w for e, w in weights.items() if e.endswith("*")}
    starts = {e: w for e, w in starts.items() if not any(e[:k] in starts for k in range(1, len(e)))}
    words = {e: w for e, w in weights.items() if not e.endswith("*")}
    # One whole word is not a beginning: drop one that adds no word to an entry.
    starts = {e: w for e, w in starts.items() if e not in words or w >= words[e]}
    lone = {e for e in starts if sum(x.startswith(e) for x in words) == 1}
    return words, {e: w for e, w in starts.items() if e not in lone}


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled rows outside the held-out fold."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = fraction_key(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")))
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("toxic") == value).orderBy(order, "doc_id").limit(FIT_ROWS // 2)
        chosen = part if chosen is None else chosen.union(part)
    train = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic", F.md5(F.coalesce("text", F.lit(""))).alias("mark")), "train")
    words, beginnings = lexicon(train)
    seen = [(features(r["sums"]), r["toxic"]) for r in
            read(train, words, beginnings, ["toxic", "mark"]).orderBy("mark", "toxic").limit(4 * FIT_ROWS).select("toxic", "sums").collect()]
    toxic = sum(y for _, y in seen)
    if not 0 < toxic < len(seen):
        share = toxic / len(seen) if seen else 0.0
        return Model({}, {}, [math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0])
    level, slope = fit_curve([x for x, _ in seen], [y for _, y in seen])
    return Model(words, beginnings, [level, max(slope, 0.0)])


def read(docs: DataFrame, words: dict, beginnings: dict, keep: list[str]) -> DataFrame:
    """docs' columns ``keep`` and the grammar's output weights ``sums`` of text."""
    def run(batches):
        import pyarrow as pa

        grammar = Grammar(words, beginnings)
        for batch in slices(batches, "text"):
            sums = [grammar.read(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sums, pa.list_(pa.float64()))],
                                             names=[*keep, "sums"])

    rows = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("sums", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(tidy(run), schema)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """docs' columns ``keep``, score (0 to 1) and predicted (1 from 0.5 on)."""
    weight = F.lit(0.0)
    for i, f in enumerate(FACTORS):
        weight = weight + F.lit(f) * F.col("sums")[i]
    z = F.lit(float(model.curve[0])) + F.lit(float(model.curve[1])) * F.log1p(weight)
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))
    scored = read(docs, model.words, model.beginnings, keep).withColumn("score", 1 / (1 + F.exp(-z)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("sums")


def op1_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

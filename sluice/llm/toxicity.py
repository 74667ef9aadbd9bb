"""Toxicity by a weighted finite-state pattern grammar over clauses.

``learn`` fits a grammar on labelled documents, ``score_documents`` applies it to all.

* **Lexicon transducer** (word to symbol). Abusive words are learnt: every word, prefix and suffix of the
  labelled texts is counted by label in Spark, those far likelier in toxic texts are candidates, and each candidate
  must also stand between many different neighbours there, so the rare words of one text and
  its copies don't pass. Targets, threats, negations and verbs of reported speech are short
  lists in four languages.
* **Pattern transducers** (symbol to symbol): negation marks what follows it closely, reported speech what
  follows in its clause, a target marks the insult behind it, a threat needs its target, an
  insult may be followed by its target. They are composed into one deterministic table.
* **Weights.** A pattern that a clause can match weighs what its base and its marks weigh. They are fitted by logistic regression
  on clauses matched in the labelled texts, around the prior weights below, so patterns without
  evidence keep those: a negated or reported insult counts for little, a targeted one for much.

A document's log odds are a base plus its clauses' weights, a pattern that clauses repeat
counting by a quarter more for the second and the third. No label, language, source or id is an input of a score.

Defined results: null and empty texts have no clause and get the base score; texts of any length are
read whole; repeated rows are scored each; a null id is not held out and never fits.
Several labels of one id count as the largest, null labels are no labels. Without labelled
rows the prior weights and lists alone decide. An empty table gives no rows. Equal scores are equal. Further
columns pass through; ``score`` and the other results replace columns of these names.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import drop_saved, save, without

# Words of the pattern lists (English, German, French, Spanish).
TARGETS = """you your yours yourself u he him she her they them these those people
du dich dir dein deine ihr euch euer er ihn sie diese leute
tu te toi ton ta vous votre vos il elle ils elles eux ces gens
tú ti te tus usted ustedes vosotros él ella ellos ellas esos gente""".split()
THREATS = """kill hurt destroy beat shoot stab burn hang murder punish
töten umbringen verletzen zerstören schlagen erschießen verbrennen
tuer frapper détruire blesser brûler abattre
matar golpear destruir herir quemar disparar""".split()
NEGATIONS = """not never no nobody isn aren wasn don doesn didn won can't cannot without
nicht nie niemals kein keine keinen ohne
ne pas jamais aucun aucune sans
nunca jamás ningún ninguna sin""".split()
REPORTS = """said says say wrote writes called calls quoted quotes claimed claims according reported
sagte sagt schrieb schreibt nannte zitierte behauptete laut
dit écrit écrivait appelé cité selon
dijo dice escribió escribe llamó citó según""".split()

#: Prior weights by the base of a pattern, and what marks add: negated, reported, targeted.
PRIOR = {"S": 4.0, "W": 1.5, "T": 3.0, "K": 0.3, "A": 0.5}
MARKS = {"-": -2.5, "'": -2.0, "+": 1.0}
BASE = -3.0
#: Labelled rows used at most for fitting (by a hash of their ids), and units of the lexicon.
MAX_LABELS = 1_000_000
MAX_UNITS = 50_000
#: Lengths of prefixes and suffixes.
AFFIXES = range(3, 8)
#: Nats by which a unit's counts must beat chance, beyond the logarithm of the units tried.
MARGIN = 3.0
#: Least share of toxic contexts of a strong and of a weak unit.
STRONG, WEAK = 0.9, 0.5
PENALTY = 9
#: A pattern counts fully in its first clause, by a quarter more in the second and the third.
COUNT_CAP = 3
FLUSH = 200_000

#: Words, and the marks that end clauses.
_TOKENS = re.compile(r"[^\W_]+|[.!?;:\n]")
_ENDS = set(".!?;:\n")


def tokens_of(text: str | None) -> list[str]:
    return _TOKENS.findall(text.lower()) if text else []


def units_of(word: str) -> list[str]:
    """The word itself, its prefixes ``ab*`` and its suffixes ``*yz``."""
    sizes = [n for n in AFFIXES if n <= len(word)]
    return [word, *(word[:n] + "*" for n in sizes), *("*" + word[-n:] for n in sizes)]


# ------------------------------------------------------------------ transducers
# A transducer is a start state and step(state, symbol) -> (state, output symbol). Symbols
# of the lexicon: S and W (strong and weak insults), K (threat), G (target), N, R, and "o" for other words.
def _within(scope: int, opens: str, bases: str, mark: str):
    """Marks symbols of ``bases`` that follow one of ``opens`` within ``scope`` words."""
    def step(state, symbol):
        if symbol[0] == opens:
            return scope, symbol
        return max(0, state - 1), symbol + mark if state and symbol[0] in bases else symbol
    return 0, step


def _reported():
    """Marks insults and threats behind a verb of reported speech, to the clause's end."""
    def step(state, symbol):
        return (1, symbol) if symbol[0] == "R" else (state, symbol + "'" if state and symbol[0] in "SWK" else symbol)
    return 0, step


def _threat(scope: int = 3):
    """A target within ``scope`` words behind a threat becomes T with the threat's marks."""
    def step(state, symbol):
        left, marks = state
        if symbol[0] == "K":
            return (scope, symbol[1:]), symbol
        if symbol[0] == "G" and left:
            return (0, ""), "T" + marks
        return ((left - 1, marks) if left > 1 else (0, "")), symbol
    return (0, ""), step


def _addressed(scope: int = 2):
    """A target within ``scope`` words behind an insult becomes A."""
    def step(state, symbol):
        if symbol[0] in "SW":
            return scope, symbol
        return max(0, state - 1), "A" if symbol[0] == "G" and state else symbol
    return 0, step


PATTERNS = (_within(3, "N", "SWK", "-"), _reported(), _within(4, "G", "SW", "+"), _threat(), _addressed())


def compose(parts=PATTERNS, alphabet: str = "oSWKGNR") -> tuple[list[dict[str, tuple[int, str]]], list[str]]:
    """The parts run one behind the other, as one table: state -> symbol -> (state, pattern or ""), and all patterns."""
    first = tuple(start for start, _ in parts)
    number, table, patterns, todo = {first: 0}, [], set(), [first]
    for states in todo:
        row = {}
        for symbol in alphabet:
            out, following = symbol, []
            for state, (_, step) in zip(states, parts):
                state, out = step(state, out)
                following.append(state)
            following = tuple(following)
            if following not in number:
                number[following] = len(number)
                todo.append(following)
            event = out if out[0] in "SWTKA" else ""
            patterns.add(event)
            row[symbol] = (number[following], event)
        table.append(row)
    return table, sorted(patterns - {""})


TABLE, EVENTS = compose()


#: A pattern's weight is that of its base plus one for each of its marks.
PARTS = sorted({e[0] for e in EVENTS} | {e[0] + m for e in EVENTS for m in e[1:]})


def parts_of(events: list[str]) -> set[str]:
    """The weighted parts that the patterns of a clause have: ``S-+`` has ``S``, ``S-`` and ``S+``."""
    return {e[0] for e in events} | {e[0] + m for e in events for m in e[1:]}


def prior_weight(part: str) -> float:
    return MARKS[part[1]] if part[1:] else PRIOR[part]


@dataclass
class Grammar:
    """Lexicon units with their symbols, the base log odds and the weights of the patterns' parts."""

    units: dict[str, str] = field(default_factory=dict)
    base: float = BASE
    weights: dict[str, float] = field(default_factory=lambda: {p: prior_weight(p) for p in PARTS})


class Lexicon(dict):
    """Symbol by word; what is missing is looked up by its units and kept (bounded memory)."""

    def __init__(self, units: dict[str, str]):
        lists = {"G": TARGETS, "K": THREATS, "N": NEGATIONS, "R": REPORTS}
        self.units, self.fixed = units, {w: s for s, words in lists.items() for w in words} | {e: e for e in _ENDS}

        # What a word of a symbol S, W or K holds: texts without any of it have no pattern.
        self.cores = ahocorasick.Automaton()
        for core in {*(u.strip("*") for u in units), *THREATS}:
            self.cores.add_word(core, True)
        self.cores.make_automaton()

    def may_match(self, text: str | None) -> bool:
        return bool(text) and next(self.cores.iter(text.lower()), None) is not None

    def __missing__(self, word: str) -> str:
        found = {self.units[u] for u in units_of(word) if u in self.units}
        symbol = "S" if "S" in found else "W" if "W" in found else self.fixed.get(word, "o")
        if len(self) >= FLUSH:
            self.clear()
        if len(word) <= 64:
            self[word] = symbol
        return symbol


def clauses_of(symbols: list[str]) -> list[tuple[int, int, list[str]]]:
    """(first token, end, patterns) of each clause that matches a pattern."""
    out, low, state, events = [], 0, 0, []
    for i, s in enumerate(symbols):
        if s in _ENDS:
            if events:
                out.append((low, i, events))
            low, state, events = i + 1, 0, []
            continue
        state, event = TABLE[state][s]
        if event:
            events.append(event)
    if events:
        out.append((low, len(symbols), events))
    return out


def features_of(text: str | None, lexicon: Lexicon) -> dict[str, float]:
    """How far each part counts: 1, 1.25 or 1.5 for one, two, or three clauses and more that have it."""
    if not lexicon.may_match(text):  # every pattern needs an insult or a threat
        return {}
    symbols = [lexicon[t] for t in tokens_of(text)]
    if set(symbols).isdisjoint("SWK"):
        return {}
    counts = Counter(p for _, _, events in clauses_of(symbols) for p in parts_of(events))
    return {e: 1 + (min(n, COUNT_CAP) - 1) / 4 for e, n in counts.items()}


# ------------------------------------------------------------------ learning
def held_out(doc_id: str) -> Column:
    """Rows that never fit: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label_id: str, label: str, max_labels: int) -> DataFrame:
    """``text``, ``toxic`` of labelled rows that are not held out."""
    given = labels.filter(F.col(label).isNotNull() & F.col(label_id).isNotNull() & ~held_out(label_id))
    given = given.groupBy(F.col(label_id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    n = given.count()
    if n > max_labels:  # the documented bound; the hash makes the choice repeatable
        given = given.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(0.99 * max_labels / n * (1 << 20)))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(given), "id").select("text", "toxic")  # at most `max_labels` rows of two numbers


def _word_counts(rows: DataFrame) -> DataFrame:
    """``word``, ``toxic``, ``clean``: texts of each label that hold the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            words = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in (counts[1], counts[0]))], ["word", "toxic", "clean"])
            for c in counts:
                c.clear()
            return batch

        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[toxic > 0].update(set(tokens_of(value.as_py())) - _ENDS)
                if len(counts[0]) + len(counts[1]) > FLUSH:
                    yield out()
        yield out()

    return rows.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _unit_counts(words: DataFrame) -> DataFrame:
    w, n = F.col("word"), F.length("word")
    units = [w] + [F.when(n >= k, F.concat(F.left(w, F.lit(k)), F.lit("*"))) for k in AFFIXES] + \
        [F.when(n >= k, F.concat(F.lit("*"), F.right(w, F.lit(k)))) for k in AFFIXES]
    pairs = words.select(F.explode(F.array_compact(F.array(*units))).alias("unit"), "toxic", "clean")
    return pairs.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _gain(a, b, p0: float, log=F.log):
    """Nats by which ``a`` toxic of ``a + b`` beat the rate ``p0``."""
    n = a + b
    if log is math.log:
        return sum(x * math.log(x / n / p) for x, p in ((a, p0), (b, 1 - p0)) if x)
    return sum((F.when(x > 0, x * F.log(x / n / F.lit(p))).otherwise(0.0) for x, p in ((a, p0), (b, 1 - p0))), F.lit(0.0))


def _contexts(rows: DataFrame, units: set[str]) -> DataFrame:
    """``unit``, ``toxic``, ``n``: different pairs of neighbours of the words with each unit, by label."""
    shared = rows.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache, seen = shared.value, {}, set()
        cores = Lexicon({u: "S" for u in known})

        def out():
            cols = list(zip(*seen)) or [(), (), (), ()]
            seen.clear()
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["unit", "toxic", "before", "behind"])

        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                text = value.as_py()
                words = tokens_of(text) if cores.may_match(text) else []
                for i, w in enumerate(words):
                    found = cache.get(w)
                    if found is None:
                        found = tuple(u for u in units_of(w) if u in known)
                        if len(cache) >= FLUSH:
                            cache.clear()
                        cache[w] = found
                    for u in found:
                        seen.add((u, int(toxic > 0), words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    pairs = rows.mapInArrow(run, "unit string, toxic int, before string, behind string")
    pairs = pairs.select("unit", "toxic", F.xxhash64("before", "behind").alias("c")).distinct()
    return pairs.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def _cover(words: DataFrame, found: dict[str, tuple[str, int]], least: float) -> dict[str, str]:
    """The units that explain most toxic words first, as long as one adds ``least`` texts that no unit before it
    has, each clean text with it counting against ``PENALTY`` toxic ones: ``idiot``, and no longer prefix or chance
    suffix of the same words."""
    shared = words.sparkSession.sparkContext.broadcast(set(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(u for u in units_of(w) if u in shared.value) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.string())), batch.column(1)], ["units", "toxic"])

    sets = words.select("word", "toxic").mapInArrow(run, "units array<string>, toxic long").filter(F.size("units") > 0)
    sets = sets.groupBy("units").agg(F.sum("toxic").alias("toxic")).orderBy(F.desc("toxic"), "units").limit(MAX_UNITS).collect()
    by_unit: dict[str, list[int]] = {}
    for i, r in enumerate(sets):
        for u in r.units:
            by_unit.setdefault(u, []).append(i)
    chosen, left = {}, [r.toxic for r in sets]

    def entry(u: str) -> tuple:
        """Strong units first; of equal gains whole words, then the longest, which say the least more than they must."""
        symbol, clean = found[u]
        gain = sum(left[i] for i in by_unit[u]) - (PENALTY * clean if symbol == "S" else 0)
        return symbol != "S", -gain, "*" in u, -len(u), u

    heap = [entry(u) for u in by_unit]
    heapq.heapify(heap)
    while heap:
        u = heapq.heappop(heap)[-1]
        now = entry(u)
        if -now[1] < least:
            continue
        if heap and now > heap[0]:
            heapq.heappush(heap, now)
            continue
        chosen[u] = found[u][0]
        for i in by_unit[u]:
            left[i] = 0
    return chosen


def learn_units(rows: DataFrame, max_units: int = MAX_UNITS, margin: float = MARGIN) -> dict[str, str]:
    """Abusive words, prefixes and suffixes: unit -> S or W."""
    words = save(_word_counts(rows), "toxicity-words")
    counts = save(_unit_counts(words), "toxicity-units")
    toxic, clean = words.agg(F.sum("toxic"), F.sum("clean")).first()
    units: dict[str, str] = {}
    if toxic and clean:
        p0, least = toxic / (toxic + clean), math.log(counts.count()) + margin
        a, b = F.col("toxic"), F.col("clean")
        likely = counts.withColumn("gain", _gain(a, b, p0)).filter((a >= WEAK * (a + b)) & (a / (a + b) > p0) & (F.col("gain") >= least))
        candidates = {r.unit for r in likely.orderBy(F.desc("gain"), "unit").limit(max_units).select("unit").collect()}
        found = {}
        if candidates:
            counted = _contexts(rows, candidates).join(likely.select("unit", F.col("clean").alias("texts")), "unit")
            for unit, toxic, clean, texts in counted.select("unit", "toxic", "clean", "texts").collect():  # a row per candidate
                clean = max(clean, texts)  # against a unit, every text counts
                share = toxic / (toxic + clean + 1)
                if share >= WEAK and toxic / (toxic + clean) > p0 and _gain(toxic, clean, p0, math.log) >= least:
                    found[unit] = ("S" if share >= STRONG else "W", clean)
        units = _cover(words, found, least / -math.log(p0)) if found else {}
    drop_saved(words, counts)
    return units


def learn_weights(rows: DataFrame, units: dict[str, str], rounds: int = 12) -> tuple[float, dict[str, float]]:
    """Base and pattern weights: the mode of a logistic regression with unit-variance normal priors (Newton's method)."""
    shared = rows.sparkSession.sparkContext.broadcast(units)
    prior = np.array([BASE, *(prior_weight(p) for p in PARTS)])
    size = len(prior)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            found = [features_of(v.as_py(), lexicon) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[f.get(p, 0.0) for p in PARTS] for f in found], pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    seen = save(rows.mapInArrow(match, "x array<double>, toxic int").groupBy("x", "toxic").agg(F.count(F.lit(1)).alias("n")), "toxicity-features")

    def derivatives(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size + 1, size))
            for batch in batches:
                if batch.num_rows:
                    x = np.hstack([np.ones((batch.num_rows, 1)), batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)])
                    y, n = (batch.column(i).to_numpy() for i in (1, 2))
                    p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
                    total[:size] += (x * (n * p * (1 - p))[:, None]).T @ x
                    total[size] += ((y > 0) - p) * n @ x
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at // size), pa.array(at % size), pa.array(total.ravel())], ["i", "j", "s"])

        out = np.zeros((size + 1, size))
        for i, j, s in seen.mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s")).collect():
            out[i, j] = s
        return out[:size] + np.eye(size), out[size] - (theta - prior)

    theta = prior
    for _ in range(rounds):
        curve, slope = derivatives(theta)
        step = np.linalg.solve(curve, slope)
        theta = theta + step * min(1.0, 2.0 / np.abs(step).max(initial=1e-9))
        if np.abs(step).max() < 1e-6:
            break
    drop_saved(seen)
    return float(theta[0]), dict(zip(PARTS, map(float, theta[1:])))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "toxic", max_labels: int = MAX_LABELS) -> Grammar:
    """A grammar fitted on the labelled documents that are not held out."""
    rows = training_rows(docs, labels, doc_id, text, label_id, label, max_labels)
    units = learn_units(rows)
    base, weights = learn_weights(rows, units)
    return Grammar(units, base, weights)


# ------------------------------------------------------------------ scoring
def score_documents(docs: DataFrame, grammar: Grammar, text: str = "text", threshold: float = 0.3, clauses: bool = False) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; with ``clauses`` also the matched clauses: their words, patterns and weight. Map-only."""
    own = ["score", "predicted", "clauses"]
    plain = without(docs, own)
    at = plain.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    kind = pa.list_(pa.struct([("words", pa.string()), ("patterns", pa.list_(pa.string())), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        lexicon = Lexicon(g.units)
        for batch in batches:
            scores, matched = [], []
            for value in batch.column(at):
                value = value.as_py()
                odds = g.base + sum(g.weights[e] * n for e, n in sorted(features_of(value, lexicon).items()))
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))))
                if clauses:
                    words = tokens_of(value)
                    matched.append([{"words": " ".join(words[low:end]), "patterns": events, "weight": sum(g.weights[p] for p in sorted(parts_of(events)))}
                                    for low, end, events in clauses_of([lexicon[w] for w in words])])
            score = pa.array(scores, pa.float64())
            columns = [*batch.columns, score, pc.greater_equal(score, threshold).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(matched, kind)] if clauses else []), [*batch.schema.names, *own[: len(columns) - len(batch.columns) + clauses]])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields] + ["score double", "predicted int"]
    if clauses:
        fields.append("clauses array<struct<words: string, patterns: array<string>, weight: double>>")
    return plain.mapInArrow(run, ", ".join(fields))

"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon maps words to symbols: insult, threat, target, negation, reported speech. Insults are stems with weights
learnt from labelled rows. Small transducers rewrite the symbols of a clause in turn: the threat transducer keeps a
threat only near a target, the target transducer marks what is aimed at somebody, negation and reported speech mark
what is denied or quoted. They are composed into one machine when a task starts. A document's score is the logistic
of the log odds of toxic labels plus the weights of its matched clauses. A text whose clauses weigh less than one plain
insult is lowered by what that says of the label, counted on the rows learnt from: so texts without a match are clean
however many of the labelled rows are toxic. Texts are searched for lexicon stems by one
automaton; only clauses with a match go through the grammar.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import batches, discard, labelled_sample, mix, part_of, staged, word_hashes

TOXIC_ROWS, CLEAN_ROWS = 1500, 6000  # labelled rows that the lexicon is learnt from, at most
STEM_LENGTHS = (4, 5, 6, 7)
LEXICON_SIZE = 2000  # learnt entries, at most
LEAST_CONTEXTS, LEAST_ROWS = 8, 4  # different neighbours and toxic rows that an entry must have
LEAST_WEIGHT = 3.0  # log odds
SLICE = 1 << 14  # rows that a worker gives out at a time when it learns
ROWS = 512  # documents of which a worker gives out the clean ones at once
NEAR = 4  # words that a target or a negation reaches
FACTORS = {"target": 1.25, "negation": 0.25, "reported": 0.4}
THREAT_WEIGHT = 5.0

# Fixed word lists of the grammar.
TARGETS = "you your you're u he she they them him her his their these those people tu vous du ihr sie usted ustedes".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nicht kein keine ne pas jamais nunca".split()
REPORTS = "said says say called calls wrote writes claimed reported sagte dit dijo".split()
THREATS = "kill hurt beat shoot stab destroy burn punch".split()

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, clauses int"
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CLAUSE_END = ".!?;:\n"

Machine = dict[tuple[int, str], tuple[int, str]]


def _symbols(base: list[str]) -> list[str]:
    return base + [f"{b}+{m}" for b in base[:2] for m in ("target", "negation", "reported")]


def reach(trigger: str, mark: str, span: int | None, accepts: list[str]) -> Machine:
    """A transducer that adds ``mark`` to insults and threats within ``span`` words after ``trigger`` (None: to the
    end of the clause)."""
    machine: Machine = {}
    top = span or 1
    for state in range(top + 1):
        for symbol in accepts:
            after = top if symbol == trigger else state if span is None else max(0, state - 1)
            marked = state > 0 and symbol.split("+")[0] in ("insult", "threat")
            machine[state, symbol] = after, f"{symbol}+{mark}" if marked else symbol
    return machine


def compose(first: Machine, second: Machine, inputs: list[str]) -> Machine:
    """The transducer that feeds what ``first`` writes to ``second``; reachable states only, numbered from 0."""
    number, todo, out = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        a, b = state = todo.pop()
        for symbol in inputs:
            a2, middle = first[a, symbol]
            b2, last = second[b, middle]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            out[number[state], symbol] = number[a2, b2], last
    return out


INPUTS = ["insult", "threat", "target", "negation", "reported", "other"]


def grammar() -> Machine:
    """Target, negation and reported-speech transducers composed in that order."""
    marks = ("target", "negation", "reported")
    written = [INPUTS]
    for mark in marks:
        written.append(written[-1] + [f"{s}+{mark}" for s in written[-1] if s.split("+")[0] in ("insult", "threat")])
    machine = reach("target", "target", NEAR, written[0])
    machine = compose(machine, reach("negation", "negation", NEAR, written[1]), INPUTS)
    return compose(machine, reach("reported", "reported", None, written[2]), INPUTS)


def clause_weight(tokens: list[tuple[str, float]], machine: Machine) -> float:
    """The weight of a clause given as (symbol, weight of an insult). Targets also count when they follow."""
    marks: list[set[str]] = []
    state = 0
    for symbol, _ in tokens:
        state, written = machine[state, symbol]
        marks.append(set(written.split("+")[1:]))
    state = 0
    for k in range(len(tokens) - 1, -1, -1):
        state, written = machine[state, tokens[k][0]]
        marks[k] |= {"target"} & set(written.split("+")[1:])
    total = 0.0
    for (symbol, weight), found in zip(tokens, marks):
        if symbol == "threat":
            weight = THREAT_WEIGHT if "target" in found else 0.0
            found = found - {"target"}
        elif symbol != "insult":
            continue
        total += weight * math.prod(FACTORS[m] for m in found)
    return total


class Scorer:
    """Scores texts with a lexicon of whole words (``"word"``) and stems (``"stem*"``)."""

    def __init__(self, lexicon: dict[str, float], prior: float, absence: float = 0.0):
        self.prior, self.absence, self.machine = prior, absence, grammar()
        self.whole = {k: w for k, w in lexicon.items() if not k.endswith("*")}
        self.stems = {k[:-1]: w for k, w in lexicon.items() if k.endswith("*")}
        self.lengths = sorted({len(k) for k in self.stems})
        self.fixed = {w: s for s, ws in (("target", TARGETS), ("negation", NEGATIONS), ("reported", REPORTS), ("threat", THREATS)) for w in ws}
        self.search = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for key in {*self.whole, *self.stems, *THREATS}:
            self.search.add_word(key)
        self.search.make_automaton()

    def _symbol(self, word: str) -> tuple[str, float]:
        weight = self.whole.get(word)
        if weight is None:
            found = [self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems]
            weight = max(found, default=None)
        return ("insult", weight) if weight is not None else (self.fixed.get(word, "other"), 0.0)

    def log_odds(self, text: str | None) -> tuple[float, int]:
        """Log odds of toxic and the number of clauses that matched."""
        weight, matched = self.weigh(text)
        return self.prior + weight + self.absence * max(0.0, 1 - weight / LEAST_WEIGHT), matched

    def weigh(self, text: str | None) -> tuple[float, int]:
        """The weight of the clauses that matched and their number."""
        lowered = (text or "").lower()
        total, matched, done = 0.0, 0, -1
        for last, length in self.search.iter(lowered):
            first = last - length + 1
            if first <= done or first and (lowered[first - 1].isalnum()):
                continue
            start = max(lowered.rfind(c, 0, first) for c in _CLAUSE_END) + 1
            ends = [e for e in (lowered.find(c, last) for c in _CLAUSE_END) if e >= 0]
            done = min(ends, default=len(lowered))
            weight = clause_weight([self._symbol(w) for w in _WORD.findall(lowered[start:done])], self.machine)
            total, matched = total + weight, matched + (weight > 0)
        return total, matched


def _features(text: str) -> Iterator[tuple[str, tuple[str, str]]]:
    """Words and stems of a text with their neighbouring words."""
    found = _WORD.findall(text.lower())
    for k, word in enumerate(found):
        around = (found[k - 1] if k else "", found[k + 1] if k + 1 < len(found) else "")
        if len(word) >= 3:
            yield word, around
        for n in STEM_LENGTHS:
            if len(word) > n:
                yield f"{word[:n]}*", around


def _evidence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per feature: rows of either label, and a context number for each different neighbourhood in toxic rows. A worker
    holds the counts of one batch of texts, and of the rows made from them one slice."""
    for frame in batches(frames):
        toxic, clean, contexts = Counter(), Counter(), defaultdict(set)
        for text, label in zip(frame["text"], frame["label"]):
            if not text:
                continue
            if label:
                seen = set()
                for feature, around in _features(text):
                    contexts[feature].add(around)
                    seen.add(feature)
                toxic.update(seen)
            else:
                clean.update({feature for feature, _ in _features(text)})
        pairs = ((f, " ".join(c).encode()) for f, cs in contexts.items() for c in cs)
        for some in itertools.batched(pairs, SLICE):
            numbers = mix(word_hashes([c for _, c in some])).astype(np.int64)
            yield _found([f for f, _ in some], 0, 0, pd.array(numbers, "Int64"))
        every = itertools.chain(toxic, (f for f in clean if f not in toxic))
        for some in itertools.batched(every, SLICE):
            yield _found(some, [toxic[f] for f in some], [clean[f] for f in some], pd.array([None] * len(some), "Int64"))


def _found(features, toxic, clean, context) -> pd.DataFrame:
    return pd.DataFrame({"feature": features, "toxic": toxic, "clean": clean, "context": context})


def _light(texts: DataFrame, lexicon: dict[str, float]) -> dict[int, int]:
    """How many of the labelled ``texts`` of either label weigh less than one plain insult."""
    grams = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(grams.value, 0.0)
        for frame in frames:
            light = [scorer.weigh(t)[0] < LEAST_WEIGHT for t in frame["text"]]
            yield frame.loc[np.array(light, bool), ["label"]]

    return {r["label"]: r["count"] for r in texts.mapInPandas(run, "label int").groupBy("label").count().collect()}


def learn(docs: DataFrame, labels: DataFrame, keep) -> tuple[dict[str, float], float, float]:
    """A lexicon of at most ``LEXICON_SIZE`` entries with weights, the log odds of the toxic label, and what a text
    without a match adds to them (zero or less).

    Reads labels where ``keep`` holds: at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` rows, chosen by a hash. Copies
    of one toxic text don't make its words insults: an entry needs different neighbours. Without labelled rows of
    both kinds the lexicon is empty and the log odds are those of one row in ten.
    """
    toxic = labelled_sample(labels, "toxic", keep & (F.col("toxic") == 1), TOXIC_ROWS)
    clean = labelled_sample(labels, "toxic", keep & (F.col("toxic") == 0), CLEAN_ROWS)
    sample = toxic.unionByName(clean).groupBy("doc_id").agg(F.min("label").alias("label"))
    total = labels.filter(keep & F.col("toxic").isin(0, 1)).agg(F.sum("toxic"), F.count(F.lit(1))).first()
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")
    texts = staged(texts, "labelled")
    found = texts.mapInPandas(_evidence, "feature string, toxic long, clean long, context long")
    # Contexts are counted apart from the sums, each once: the first grouping holds one row per context.
    each = found.groupBy("feature", "context").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = each.groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count("context").alias("contexts")
    )
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {}, math.log(0.1 / 0.9), 0.0
    weight = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    rows = (
        counts.filter((F.col("contexts") >= LEAST_CONTEXTS) & (F.col("toxic") >= LEAST_ROWS))
        .select("feature", weight.alias("weight"), "toxic")
        .filter(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("toxic"), "feature")
        .limit(LEXICON_SIZE)
        .collect()
    )
    share = (total[0] + 1) / (total[1] + 2)
    lexicon = {r["feature"]: r["weight"] for r in _useful(rows)}
    light = _light(texts, lexicon)
    discard(texts)
    absence = math.log((light.get(1, 0) + 0.5) / (sizes[1] + 1)) - math.log((light.get(0, 0) + 0.5) / (sizes[0] + 1))
    return lexicon, math.log(share / (1 - share)), min(0.0, absence)


def _useful(rows: list) -> list:
    """Without the stems that one word of the lexicon explains: they would only add words never seen as toxic."""
    most: dict[str, int] = defaultdict(int)
    for r in rows:
        if not r["feature"].endswith("*"):
            for n in STEM_LENGTHS:
                if len(r["feature"]) > n:
                    stem = r["feature"][:n] + "*"
                    most[stem] = max(most[stem], r["toxic"])
    return [r for r in rows if most[r["feature"]] < 0.8 * r["toxic"]]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, clauses (how many matched).

    Null and empty texts have no match. Repeated rows are scored alike; a null doc_id is held out of learning and
    gets held_out false. Other columns are not read.
    """
    grams = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, part_of("doc_id", 5) != 0))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*grams.value)
        for frame in frames:
            found = [scorer.log_odds(t) for t in frame["text"]]
            odds = np.array([o for o, _ in found], dtype=float)
            probability = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "held_out": frame["held_out"],
                    "score": probability,
                    "predicted": (probability >= 0.5).astype("int32"),
                    "clauses": np.array([n for _, n in found], dtype="int32"),
                }
            )

    held_out = F.coalesce(part_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held_out).mapInPandas(run, SCHEMA)


def _clean(frames: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    """The rows that are not toxic, of ``ROWS`` rows at a time: a worker holds the text of one of them beside its input."""
    for frame in frames:
        for start in range(0, frame.num_rows, ROWS):
            rows = frame.slice(start, ROWS)
            texts = rows.column(rows.schema.get_field_index("text"))
            yield rows.filter(pa.array([scorer.log_odds(t.as_py())[0] < 0 for t in texts], pa.bool_()))


def keep_clean(docs: DataFrame, known: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that a lexicon learnt on ``known`` with ``labels`` does not call toxic."""
    lexicon = docs.sparkSession.sparkContext.broadcast(learn(known, labels, part_of("doc_id", 5) != 0))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _clean(frames, Scorer(*lexicon.value))

    return docs.mapInArrow(run, docs.schema)

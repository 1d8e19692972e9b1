"""Toxicity by a weighted finite-state pattern grammar over clauses.

Four small transducers read a clause's token classes: insult or threat (emits a hit), target (a hit near a person word
weighs more), negation (a hit soon after a negator weighs less) and reported speech (a hit in quoted or reported
words weighs less). Their composition is one deterministic machine whose weights multiply. The insult arcs are a
fixed seed list plus words and word stems learned from a bounded sample of labelled rows: those that stand in many
different contexts of toxic texts and hardly in others, so that copies of a text count once. An Aho-Corasick machine finds
the hits of a whole text; only their clauses are run through the grammar. The clause weights' sum becomes a
probability by a logistic fit on the sample.

Defined cases: null and empty texts have no clause and score as clean; with no labels the seed list and a fixed
curve are used; repeated rows are scored each; an empty table gives an empty result; a
clause of any length is run whole, in time linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.base import crc_mod, map_batches, materialize, table
from touchline.llm.features import fit_logistic, labelled_ids, thinned

PER_CLASS, MIN_ODDS, CUT = 2000, 12.0, 0.5
#: Seed arcs.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "imbecile", "vermin")
THREATS = ("kill", "hurt", "destroy", "beat", "strangle")
INTENT = {"will", "shall", "gonna", "going", "i'll", "we'll"}
TARGETS = {"you", "your", "yours", "you're", "he", "she", "they", "them", "him", "her", "these", "those", "people", "tu", "vous", "du", "ihr", "sie", "usted"}
NEGATORS = {"not", "never", "no", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "pas", "jamais", "nunca"}
REPORTERS = {"said", "says", "wrote", "quoted", "called", "claimed", "according", "reported", "alleged", "sagte", "dit", "dijo"}
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”„«»]")
CLAUSE_ENDS = ".!?;:\n"
_CLAUSE = re.compile(f"[{re.escape(CLAUSE_ENDS)}]")

#: Factors of a hit's weight: a threat, near a target, soon after a negator, within reported or quoted words.
THREAT, NEAR, NEGATED, REPORTED = 1.6, 1.4, 0.5, 0.6
#: Tokens that each transducer remembers its trigger for.
MEMORY = {"intent": 4, "target": 6, "negator": 3, "reporter": 9, "quote": 12}


def compose() -> dict[tuple[tuple[int, int, int, int], str], tuple[tuple[int, int, int, int], float]]:
    """The reachable product machine: ((intent, target, negation, report) counters, class) -> (next, weight emitted)."""
    sets = {"intent": 0, "target": 1, "negator": 2, "reporter": 3, "quote": 3}
    table_: dict = {}
    todo = [(0, 0, 0, 0)]
    while todo:
        state = todo.pop()
        if (state, "other") in table_:
            continue
        for symbol in ("intent", "target", "negator", "reporter", "quote", "insult", "threat", "other"):
            nxt = [max(0, x - 1) for x in state]
            if symbol in sets:
                closing = symbol == "quote" and state[3] > MEMORY["reporter"]
                nxt[sets[symbol]] = 0 if closing else MEMORY[symbol]
            weight = 0.0
            if symbol == "insult" or symbol == "threat" and state[0]:
                weight = (THREAT if symbol == "threat" else 1.0) * (NEAR if state[1] else 1.0)
                weight *= (NEGATED if state[2] else 1.0) * (REPORTED if state[3] else 1.0)
            table_[state, symbol] = (tuple(nxt), weight)
            todo.append(tuple(nxt))
    return table_


class Grammar:
    """The composed machine over a lexicon of whole words and word stems."""

    def __init__(self, words: list[str], stems: list[str]):
        self.words, self.stems = set(words) | set(INSULTS), tuple(stems)
        self.machine, self.finder = compose(), ahocorasick.Automaton()
        for w in self.words:
            self.finder.add_word(w, (w, "insult", False))
        for w in THREATS:
            self.finder.add_word(w, (w, "threat", False))
        for w in self.stems:
            if w not in self.finder:
                self.finder.add_word(w, (w, "insult", True))
        self.finder.make_automaton()

    def kind(self, token: str) -> str:
        if token in self.words or self.stems and token.startswith(self.stems):
            return "insult"
        for name, group in (("threat", THREATS), ("target", TARGETS), ("negator", NEGATORS), ("reporter", REPORTERS), ("intent", INTENT)):
            if token in group:
                return name
        return "quote" if not token[0].isalpha() else "other"

    def run(self, tokens: list[str]) -> float:
        state, total = (0, 0, 0, 0), 0.0
        for t in tokens:
            state, weight = self.machine[state, self.kind(t)]
            total += weight
        return total

    def score(self, text: str | None) -> tuple[float, int]:
        """Sum of the clause weights and number of matched clauses of a whole text."""
        if not text:
            return 0.0, 0
        low = text.lower()
        total, clauses, done = 0.0, 0, -1
        for end, (word, _, stem) in self.finder.iter(low):
            at = end + 1 - len(word)
            if at < done or at and low[at - 1].isalpha() or not stem and end + 1 < len(low) and low[end + 1].isalpha():
                continue
            # the whole clause, however long; what lies before it is never looked at again
            lo = max(done, 0, *(low.rfind(c, max(done, 0), at) + 1 for c in CLAUSE_ENDS))
            cut = _CLAUSE.search(low, end + 1)
            hi = cut.start() if cut else len(low)
            after = _TOKEN.findall(low, end + 1, hi)
            weight = self.run(_TOKEN.findall(low, lo, hi))
            if weight and any(t in TARGETS for t in after[:4]):
                weight *= NEAR
            total, clauses, done = total + weight, clauses + (weight > 0), hi
        return total, clauses


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(y, text) of the labelled sample, written once: PER_CLASS ids of each label, and of repeated ids a thinned part."""
    ids = labelled_ids(labels, "toxic", PER_CLASS, 5)
    chosen = docs.sparkSession.createDataFrame(ids, "id long, y int")
    rows = materialize(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "y", "text"), "sample")
    return thinned(rows, 4 * PER_CLASS).select("y", "text")


def learn(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Insult words and stems from the sample; as many as it holds."""
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return [], []

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = [t for t in _TOKEN.findall((text or "").lower()) if t[0].isalpha()]
                seen = sorted(set(zip(tokens, ["", *tokens], [*tokens[1:], ""], strict=False)))
                for k in range(0, len(seen), 10000):
                    part = seen[k : k + 10000]
                    yield pa.RecordBatch.from_arrays([pa.array([y] * len(part), pa.int32()), pa.array([x[0] for x in part], pa.string()), pa.array([f"{x[1]} {x[2]}" for x in part], pa.string())], names=["y", "word", "around"])

    each = rows.mapInArrow(contexts, "y int, word string, around string")
    count = each.where("length(word) >= 3").groupBy("word", "around").agg(F.max("y").alias("y1"), F.min("y").alias("y0")).groupBy("word").agg(F.sum("y1").alias("c1"), F.sum(1 - F.col("y0")).alias("c0"))
    count = materialize(count, "words")
    least = max(4, n1 // 200)
    odds = ((F.col("c1") + 0.5) / (n1 + 1)) / ((F.col("c0") + 0.5) / (n0 + 1))
    words = [r.word for r in count.where((F.col("c1") >= least) & (odds >= MIN_ODDS)).orderBy(F.desc(odds), "word").collect()]
    stems: list[str] = []
    for size in (4, 5, 6):
        by = count.where(F.length("word") > size).groupBy(F.substring("word", 1, size).alias("stem")).agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"), F.sum(F.when(F.col("c1") > 0, 1).otherwise(0)).alias("forms"))
        good = by.where((F.col("c0") == 0) & (F.col("forms") >= 4) & (F.col("c1") >= 2 * least + 2)).orderBy(F.desc("c1"), "stem").collect()
        stems += [r.stem for r in good if not any(r.stem.startswith(s) for s in stems)]
    return words, stems


def score_texts(docs: DataFrame, words: list[str], stems: list[str], keep: list[str]) -> DataFrame:
    """keep columns with weight and clauses of each text; the lexicon is bounded by the sample's words."""
    cache: list[Grammar] = []

    def run(texts: pa.Array) -> dict[str, pa.Array]:
        if not cache:
            cache.append(Grammar(words, stems))
        got = [cache[0].score(t.as_py()) for t in texts]
        return {"weight": pa.array([w for w, _ in got], pa.float64()), "clauses": pa.array([c for _, c in got], pa.int64())}

    return map_batches(docs, run, "weight double, clauses long", keep, ["text"])


def fit(rows: DataFrame, words: list[str], stems: list[str]) -> tuple[float, float]:
    """Slope and offset of the probability over log(1 + weight), by the sample."""
    got = sorted(score_texts(rows, words, stems, ["y"]).select("y", "weight").collect())
    if len({r.y for r in got}) < 2:
        return 8.0, -2.0
    a, b = fit_logistic(np.log1p([[r.weight] for r in got]), np.array([r.y for r in got], float))
    return float(a), float(b)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = sample(docs, table(spark, sf_dir, "labels"))
    words, stems = learn(rows)
    a, b = fit(rows, words, stems)
    curve = 1 / (1 + F.exp(-(F.lit(a) * F.log1p("weight") + F.lit(b))))
    out = score_texts(docs, words, stems, ["doc_id"]).withColumn("score", curve)
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "clauses")


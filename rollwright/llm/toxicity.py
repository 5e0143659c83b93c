"""Toxicity by a weighted finite-state grammar over clauses.

Words become marks: I insult, H threat, T target, N negation, R reported speech, O other. Small transducers
each read marks and add a flag when their pattern is complete; their product (composition) is one automaton
that reads a clause in a single pass and ends in the set of flags the clause matched. A clause scores by the
weight of its flags, an insult that is negated or reported counting less than one aimed at a target; a text
scores by the sum of its matched clauses, so isolated marks without an insult or a threat add nothing.

Insults are learned: words and word beginnings that occur in toxic training texts so much more often than in
others that chance is ruled out; copies vote once. Weights of flag sets are smoothed log odds over the training
clauses. Training reads at most ``SAMPLE`` labelled texts of each class, chosen by a hash of the id.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwright.llm.common import keyed_texts, small_batches
from rollwright.llm.shingles import shingle_set, signature

SAMPLE = 2_500  # labelled texts of each class that training reads at most
LEAST_TEXTS = 3  # toxic texts that a learned beginning must newly explain
RISK = 0.01  # chance that any learned insult is none
STEMS = (4, 5, 6, 7)  # lengths of word beginnings that may be learned

# Function words of the four languages that the grammar reads.
MARKS = {
    "T": "you your he she they them him her du dich dir ihr euch tu toi vous te tú usted ustedes él ella".split(),
    "N": "not never no isn't aren't nicht nie kein keine pas jamais ne aucun nunca ni jamás".split(),
    "R": "said says quote quoted claimed wrote sagte schrieb behauptet dit écrit affirme dijo dice escribió".split(),
    "H": "kill hurt destroy attack beat töten schlagen vernichten tuer frapper détruire matar golpear destruir".split(),
}
FLAGS = {"I": "insult", "H": "threat", "T": "target", "N": "negation", "R": "reported"}
CLAUSE = regex.compile(r"[.!?;:\n]+")
WORD = regex.compile(r"[\p{L}\p{M}'’]+")


class Transducer:
    """Deterministic: ``step(state, mark)`` gives the next state; ``final`` tells what a state has matched."""

    def __init__(self, arcs: dict[tuple[int, str], int], final: dict[int, frozenset[str]]) -> None:
        self.arcs, self.final = arcs, final

    def step(self, state: int, mark: str) -> int:
        return self.arcs.get((state, mark), state)


def seen(mark: str) -> Transducer:
    """Matches a clause that holds the mark."""
    return Transducer({(0, mark): 1}, {1: frozenset({FLAGS[mark]})})


def before(first: str, seconds: str) -> Transducer:
    """Matches a clause in which one of ``seconds`` follows ``first``: what comes first governs it."""
    return Transducer({(0, first): 1} | {(1, s): 2 for s in seconds}, {2: frozenset({FLAGS[first]})})


@functools.cache
def grammar() -> Transducer:
    """Composition of all patterns: states are tuples of theirs, numbered as they are reached."""
    parts = [seen("I"), seen("H"), seen("T"), before("N", "IH"), before("R", "IH")]
    number = {(0,) * len(parts): 0}
    arcs, final = {}, {}
    for state in (queue := [(0,) * len(parts)]):
        final[number[state]] = frozenset().union(*(p.final.get(s, frozenset()) for p, s in zip(parts, state)))
        for mark in FLAGS:
            reached = tuple(p.step(s, mark) for p, s in zip(parts, state))
            if reached not in number:
                number[reached] = len(number)
                queue.append(reached)
            arcs[number[state], mark] = number[reached]
    return Transducer(arcs, final)


def features(word: str) -> set[str]:
    """What may be learned from a word: itself, and its beginnings (marked by a star)."""
    return {word, *(word[:n] + "*" for n in STEMS if len(word) > n)}


class Lexicon:
    def __init__(self, insults: frozenset[str]) -> None:
        self.insults = insults
        self.fixed = {word: mark for mark, words in MARKS.items() for word in words}

    def mark(self, word: str) -> str | None:
        if word in self.insults or any(word[:n] + "*" in self.insults for n in STEMS):
            return "I"
        return self.fixed.get(word)

    def clauses(self, text: str) -> Iterator[frozenset[str]]:
        """Flags of every clause with an insult or a threat."""
        automaton = grammar()
        for clause in CLAUSE.split(text.lower()):
            state = 0
            for word in WORD.findall(clause):
                mark = self.mark(word)
                if mark:
                    state = automaton.step(state, mark)
            flags = automaton.final[state]
            if flags & {"insult", "threat"}:
                yield flags


class Model:
    def __init__(self, insults: frozenset[str], weights: dict[frozenset[str], float], bias: float) -> None:
        self.lexicon, self.weights, self.bias = Lexicon(insults), weights, bias
        stems = sorted({x.rstrip("*") for x in insults} | set(MARKS["H"]))
        self.any = regex.compile(r"(?<![\p{L}\p{M}])(?:" + "|".join(map(regex.escape, stems)) + ")") if stems else None

    def score(self, text: str | None) -> float:
        """0 to 1; null and empty texts score as one without a matched clause."""
        total = self.bias
        if text and self.any and self.any.search(text.lower()):
            total += sum(self.weights[flags] for flags in self.lexicon.clauses(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id's text is divisible by five; false for a null id, which has no label."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def apart(texts: list[str]) -> list[int]:
    """Places of the texts, without copies and near copies of earlier ones: those would vote many times."""
    known: set[int] = set()
    kept = []
    for i, text in enumerate(texts):
        hashes = shingle_set(text, 3)
        if not len(hashes):
            continue
        marks = signature(hashes, 8).tolist()
        if sum(m in known for m in marks) < 4:
            kept.append(i)
        known.update(marks)
    return kept


def learn_insults(texts: list[str], toxic: np.ndarray) -> frozenset[str]:
    """Features whose share of toxic texts cannot be chance (Bonferroni over all features of toxic texts).

    Words that pass are insults. Beginnings that pass are taken greedily by the toxic texts that no insult
    explains yet, longest first among equals, as they may cover many forms of one word.
    """
    rows = apart(texts)
    found = lambda i: set().union(*map(features, set(WORD.findall(texts[i].lower()))))
    often = Counter(itertools.chain.from_iterable(found(i) for i in rows if toxic[i]))
    tried = len(often)
    holders: dict[str, set[int]] = {x: set() for x, n in often.items() if n >= LEAST_TEXTS}
    del often
    clean: Counter[str] = Counter()
    for i in rows:
        if toxic[i]:
            for x in found(i) & holders.keys():
                holders[x].add(i)
        else:
            clean.update(found(i) & holders.keys())
    bad = sum(bool(toxic[i]) for i in rows)
    share = bad / max(1, len(rows))
    level = RISK / max(1, tried)
    fit = {}
    for x, held in holders.items():
        n, b = len(held) + clean[x], clean[x]
        tail = sum(math.comb(n, k) * share ** (n - k) * (1 - share) ** k for k in range(b + 1)) if b <= 0.05 * n else 1.0
        if tail <= level:
            fit[x] = held
    chosen = {x for x in fit if not x.endswith("*")}
    explained = set().union(*(fit[x] for x in chosen))
    while fit:
        best = max(fit, key=lambda x: (len(fit[x] - explained), -clean[x], len(x), x))
        if len(fit[best] - explained) < LEAST_TEXTS:
            break
        chosen.add(best)
        explained |= fit.pop(best)
    return frozenset(chosen)


def train(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Fit on labelled rows that are not held out; without toxic ones the model has no insults."""
    wanted = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out("doc_id")).select("doc_id", "toxic").distinct()
    rows = []
    for value in (0, 1):
        ids = wanted.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        rows += keyed_texts(df, id_column, text_column).join(F.broadcast(ids), "doc_id").orderBy("doc_id").collect()
    texts, toxic = [r["text"] or "" for r in rows], np.array([r["toxic"] == 1 for r in rows], dtype=bool)
    insults = learn_insults(texts, toxic)
    lexicon = Lexicon(insults)
    counts: dict[frozenset[str], list[int]] = {}
    for text, label in zip(texts, toxic, strict=True):
        for flags in set(lexicon.clauses(text)):
            counts.setdefault(flags, [0, 0])[int(label)] += 1
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    bias = -4.0
    weights = {}
    for chosen in itertools.chain.from_iterable(itertools.combinations(sorted(FLAGS.values()), n) for n in range(6)):
        flags = frozenset(chosen)
        clean, bad = counts.get(flags, [0, 0])
        # What the grammar expects of an unseen pattern: insults weigh most, targets add, negation and report take away.
        prior = (
            5.0 * ("insult" in flags) + 1.0 * ("threat" in flags) + 0.5 * ("target" in flags)
            - 0.5 * ("negation" in flags) - 0.5 * ("reported" in flags)
        )
        seen_ = (bad / n1 + clean / n0) * 200
        odds = math.log((bad + 0.5) / (n1 + 1)) - math.log((clean + 0.5) / (n0 + 1)) + 2.0 if bad + clean else 0.0
        weights[flags] = max(0.0, (prior + seen_ * odds) / (1 + seen_))
    return Model(insults, weights, bias)


def toxicity(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; only the text enters the score.

    Repeated rows are scored each; other columns are left out. No rows in, no rows out.
    """
    model = train(df, labels, id_column, text_column)
    insults, weights, bias = model.lexicon.insults, model.weights, model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(insults, weights, bias)
        for batch in small_batches(batches):
            scores = pa.array(map(fitted.score, batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    scored = keyed_texts(df, id_column, text_column).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

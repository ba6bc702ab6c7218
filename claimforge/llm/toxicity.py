"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read a clause word by word: insult and threat (weights learned
from labels), target (who is addressed), negation and reported speech. Composed, they
form one machine whose state is what the clause has said so far; an insult or threat
makes it emit a weight that depends on that state. A text's score comes from the
clauses that matched, never from a word alone: "he is not an idiot" and "she said
'you idiot'" weigh less than "you idiot".
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import class_weights, fold, labelled_sample, table

# Labelled rows of each class that the lexicon is learned from, and their longest text.
TRAIN_ROWS = 4000
TRAIN_CHARS = 200_000
THRESHOLD = 0.3
PREFIXES = (3, 4, 5, 6, 7)
# A candidate's share of clean texts, against toxic ones, stays below this.
LEAK = 0.03
# It is in three toxic texts at least, and either in this share of them or so often that the
# count has less than this chance if toxic and clean texts had it alike.
SUPPORT = 0.02
CHANCE = 1e-6

THREATS = "kill murder stab shoot strangle hurt töten umbringen erschießen tuer tuerai matar mataré asesinar".split()
TARGETS = (
    "you your yours yourself he she they him her them du dich dir ihr euch sie er tu te toi vous il elle ils "
    "elles usted ustedes tú él ella ellos ellas"
).split()
NEGATIONS = "not never no isn't aren't don't won't nicht kein keine keinen nie pas jamais aucun ni nunca".split()
REPORTS = (
    "said says say wrote writes quoted called claimed reported sagte sagt schrieb nannte dit disait écrit "
    "dijo dice escribió"
).split()

WORDS = r"[^\W\d_]+(?:'[^\W\d_]+)?"
CLAUSE_END = r"[.!?;:\n]"
# How far, in words, a negation reaches.
REACH = 2
NEGATED, REPORTED, TARGETED = 0.4, 0.6, 1.5
THREAT_WEIGHT = 2.0
MIXERS = [np.uint64(m) for m in (2654435761, 2246822519, 3266489917, 668265263)]


@dataclass(frozen=True)
class State:
    """What a clause has said before the next word."""

    targeted: bool = False
    reported: bool = False
    negated: int = 0


def classes(words: Iterable[str], name: str) -> dict[str, str]:
    return dict.fromkeys(words, name)


MEANING = classes(TARGETS, "target") | classes(NEGATIONS, "negation") | classes(REPORTS, "report")


def step(state: State, meaning: str | None, weight: float) -> tuple[State, float]:
    """One transition: the next state and the weight emitted."""
    if weight:
        factor = (TARGETED if state.targeted else 1.0) * (REPORTED if state.reported else 1.0)
        return State(state.targeted, state.reported, 0), weight * factor * (NEGATED if state.negated else 1.0)
    return (
        State(
            state.targeted or meaning == "target",
            state.reported or meaning == "report",
            REACH if meaning == "negation" else max(0, state.negated - 1),
        ),
        0.0,
    )


@dataclass(frozen=True)
class Grammar:
    """Weights of whole words and of word beginnings, and the calibration of a total."""

    words: dict[str, float]
    stems: dict[str, float]
    slope: float = 1.0
    shift: float = -2.0

    def pattern(self) -> str | None:
        """Finds a word that may emit a weight; null without a lexicon."""
        ways = [rf"{re.escape(w)}\b" for w in self.words] + [re.escape(s) for s in self.stems]
        return rf"\b(?:{'|'.join(sorted(ways, key=len, reverse=True))})" if ways else None

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for length in {len(s) for s in self.stems}:
            found = max(found, self.stems.get(word[:length], 0.0))
        return found

    def clause(self, words: list[str]) -> float:
        state, total = State(), 0.0
        for word in words:
            state, out = step(state, MEANING.get(word), self.weight(word))
            total += out
        return total

    def score(self, total: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(total) + self.shift))))


class Reader:
    """A grammar ready to read whole texts."""

    def __init__(self, grammar: Grammar):
        pattern = grammar.pattern()
        self.grammar = grammar
        self.find = re.compile(pattern).search if pattern else None
        self.ends = re.compile(CLAUSE_END)
        self.words = re.compile(WORDS)

    def total(self, text: str | None) -> tuple[float, int]:
        """Weight of all matched clauses, and how many they are."""
        if not text or not self.find:
            return 0.0, 0
        text = text.lower()
        total, clauses, at = 0.0, 0, 0
        while hit := self.find(text, at):
            # The clause before ended at ``at``, so nothing before it is searched again.
            begin = max(at - 1, *(text.rfind(end, at, hit.start()) for end in ".!?;:\n")) + 1
            stop = self.ends.search(text, hit.end())
            at = stop.end() if stop else len(text)
            out = self.grammar.clause(self.words.findall(text[begin:at]))
            total += out
            clauses += out > 0
        return total, clauses


# Learning -------------------------------------------------------------------


def candidates(text: str) -> set[str]:
    """Whole words (marked by a final $) and word beginnings of a text."""
    found = set()
    for word in set(re.findall(WORDS, text.lower())):
        if len(word) >= 3:
            found.add(word + "$")
        found.update(word[:n] for n in PREFIXES if len(word) > n)
    return found


def family(text: str) -> list[int]:
    """Four least hashes of the text's 5-word shingles, equal for most of its near copies."""
    words = text.lower().split()
    hashes = np.array(
        [zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))], np.uint64
    )
    return [int(((hashes * m + m) & np.uint64(0xFFFFFFFF)).min()) * 4 + k for k, m in enumerate(MIXERS)]


def one_per_family(texts: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """Texts that share two of the four hashes with no earlier text."""
    seen, kept = set(), {}
    for text, label in zip(texts, labels, strict=True):
        hashes = family(text)
        if text not in kept and sum(h in seen for h in hashes) < 2:
            kept[text] = label
        seen.update(hashes)
    return list(kept), list(kept.values())


def chance(toxic: int, clean: int, share: float) -> float:
    """Probability that at most ``clean`` of ``toxic + clean`` texts are clean, if ``share`` are toxic."""
    n = toxic + clean
    return sum(
        math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + (n - i) * math.log(share) + i * math.log1p(-share)
        )
        for i in range(clean + 1)
    )


def learn(texts: list[str], labels: list[int], weights: tuple[float, float] = (1.0, 1.0)) -> Grammar:
    """Words and word beginnings that tell toxic texts from clean ones, with log-odds weights.

    A clean and a toxic text stand for ``weights`` texts in the calibration.

    Copies and near copies count once, else their shared words would look telling. Of
    candidates that extend each other the most specific one is taken that loses no
    more than a tenth of the toxic texts.
    """
    texts, labels = one_per_family(texts, labels)
    toxic, clean, n = Counter(), Counter(), [0, 0]
    for text, label in zip(texts, labels, strict=True):
        n[label] += 1
        (toxic if label else clean).update(candidates(text))
    if not all(n):
        return Grammar(dict.fromkeys(THREATS, THREAT_WEIGHT), {})
    good = {
        c: k
        for c, k in toxic.items()
        if k >= 3
        and (clean[c] + 0.5) / n[0] <= LEAK * k / n[1]
        and (k >= SUPPORT * n[1] or chance(k, clean[c], n[1] / sum(n)) <= CHANCE)
    }
    longer = defaultdict(list)
    for c in good:
        for size in range(PREFIXES[0], len(c)):
            if c[:size] in good:
                longer[c[:size]].append(c)
    taken: dict[str, float] = {}
    for c in sorted(good, key=lambda c: (-good[c], c)):
        if any(c[:size] in taken for size in range(PREFIXES[0], len(c) + 1)):
            continue
        if any(e in taken and good[e] >= 0.8 * good[c] for e in longer[c]):
            continue
        best = max([c, *(e for e in longer[c] if good[e] >= 0.9 * good[c])], key=lambda e: (len(e), e))
        odds = ((good[best] + 0.5) / (n[1] + 1)) / ((clean[best] + 0.5) / (n[0] + 1))
        taken[best] = math.log(odds)
    words = {c[:-1]: weight for c, weight in taken.items() if c.endswith("$")}
    stems = {c: weight for c, weight in taken.items() if not c.endswith("$")}
    return calibrated(Grammar(dict.fromkeys(THREATS, THREAT_WEIGHT) | words, stems), texts, labels, weights)


def calibrated(
    grammar: Grammar, texts: list[str], labels: list[int], weights: tuple[float, float] = (1.0, 1.0)
) -> Grammar:
    """Logistic regression of the label on log(1 + total), weighted by label, a little regularised."""
    reader = Reader(grammar)
    x = np.log1p([reader.total(text)[0] for text in texts])
    rows, y = np.column_stack([x, np.ones_like(x)]), np.array(labels, float)
    beta, pull = np.zeros(2), np.diag([0.05, 0.05])
    count = np.where(y > 0, weights[1], weights[0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        hessian = (rows * (count * p * (1 - p))[:, None]).T @ rows + pull
        beta = beta + np.linalg.solve(hessian, rows.T @ (count * (y - p)) - pull @ beta)
    return Grammar(grammar.words, grammar.stems, float(beta[0]), float(beta[1]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Grammar:
    """Learn from at most ``rows`` labelled documents of each class, held-out ones excluded.

    Of these, texts of more than ``TRAIN_CHARS`` characters teach nothing: both bounds keep
    what comes to the driver within 2 * rows * TRAIN_CHARS. The classes are calibrated with their shares of all labels that are not held out.
    """
    keep = fold("doc_id", 4) != 2
    sample = labelled_sample(docs, labels, "toxic", keep, rows).where(F.length("text") <= TRAIN_CHARS)
    found = sample.select("text", "label").toPandas()
    weights = class_weights(labels, "toxic", keep, rows)
    return learn(found["text"].tolist(), found["label"].astype(int).tolist(), weights)


def rate(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), ``toxic_clauses`` and ``toxic``.

    Whole texts are read, in time linear in their length.

    A null or empty text, or one without a matched clause, has the score of a total of
    0. All rows stay, repeated ones and null ids too; columns of ``docs`` with these
    three names are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {"toxicity", "toxic_clauses", "toxic"}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(grammar)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            totals = [reader.total(text.as_py()) for text in texts]
            scores = [grammar.score(total) for total, _ in totals]
            yield pa.record_batch(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([n for _, n in totals], pa.int64()),
                 pa.array([s >= THRESHOLD for s in scores], pa.bool_())],
                names=[*batch.schema.names, "toxicity", "toxic_clauses", "toxic"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds}, toxicity double, toxic_clauses long, toxic boolean")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = rate(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rated.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        F.col("toxic").cast("int").alias("predicted"),
        "toxic_clauses",
    )


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not rated toxic, with their own columns."""
    grammar = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rate(docs, grammar).where(~F.col("toxic")).select(*docs.columns)

"""Toxicity by a weighted finite-state pattern grammar (operator 6).

A lexicon transducer maps words to classes: insult stems and threats with weights, and the fixed cue words for
targets, negation and reported speech. Small transducers for these phenomena are composed into one machine that
reads a clause and writes an event for every insult or threat: plain, targeted, negated or reported. An event
counts its stem's weight times the weight of its kind, so clauses are scored, not isolated words.

Insult stems and their weights (log ratios of rates per word) are learned from labelled rows: a sample of at most
``max_labelled`` labelled documents, taken in hash order and once per text. The clause sums are turned into a
probability by a logistic function fitted on the same sample. Every document is scored as a whole.

Defined cases: null and empty texts have no clause and get the score of a text without matches; repeated rows are
scored alike; labels without a document are ignored; without both classes among the labels all scores are 0; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage

# Cue words in English, German, French and Spanish.
TARGETS = "you your yourself u he she they him her them du dich dir dein ihr euch sie er tu toi te vous il elle ils tú usted ustedes él ella ellos".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ningún tampoco".split()
REPORTS = "said says say called calls claimed reported quoted wrote sagte sagt nannte schrieb behauptete dit disait appelé écrit dijo dice llamó escribió".split()
THREATS = "kill murder hurt destroy stab shoot strangle umbringen töten erschlagen tuer frapper égorger matar golpear apuñalar".split()
#: Weight of each kind of event.
KINDS = {"plain": 1.0, "targeted": 1.25, "negated": 0.4, "reported": 0.6}
THREAT_WEIGHT = 2.0

#: Working columns; named so that no column of a documents table clashes.
CLAUSES, N_WORDS = "__tox_clauses", "__tox_words"

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
_CUES = {w: c for c, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}


class Machine:
    """A deterministic transducer over word classes: (state, class) -> (state, mark)."""

    def __init__(self, start: int, step: Callable[[int, int], tuple[int, bool]]):
        self.start, self.step = start, step


#: A negation reaches the three words after it; a report and a target reach the rest of the clause.
NEGATED = Machine(0, lambda s, c: (3 if c == NEGATION else max(s - 1, 0), s > 0))
REPORTED = Machine(0, lambda s, c: (1 if c == REPORT else s, s > 0))
TARGETED = Machine(0, lambda s, c: (1 if c == TARGET else s, s > 0))


def compose(*machines: Machine) -> list[list[tuple[int, tuple[bool, ...]]]]:
    """The product machine: table[state][class] = (next state, marks); state 0 is the start."""
    names = {tuple(m.start for m in machines): 0}
    table, todo = [], list(names)
    while todo:
        state, row = todo.pop(0), []
        for c in range(6):
            step = [m.step(s, c) for m, s in zip(machines, state, strict=True)]
            new = tuple(s for s, _ in step)
            if new not in names:
                names[new] = len(names)
                todo.append(new)
            row.append((names[new], tuple(mark for _, mark in step)))
        table.append(row)
    return table


GRAMMAR = compose(NEGATED, REPORTED, TARGETED)


def clause_score(words: list[str], weight: Callable[[str], tuple[int, float]]) -> float:
    """Weight of the events of one clause; a target after the event counts as well."""
    state, total = 0, 0.0
    classes = [weight(w) for w in words]
    aimed = any(c == TARGET for c, _ in classes)
    for c, value in classes:
        state, (negated, reported, targeted) = GRAMMAR[state][c]
        if c in (INSULT, THREAT):
            kind = "negated" if negated else "reported" if reported else "targeted" if targeted or aimed else "plain"
            total += value * KINDS[kind]
    return total


class Scorer:
    """Lexicon and grammar for one set of stems; finds the clauses that hold a match and scores those."""

    def __init__(self, stems: dict[str, float]):
        import ahocorasick

        self.stems, self.longest = stems, max(map(len, stems), default=0)
        self.find = ahocorasick.Automaton()
        for s in {*stems, *THREATS}:
            self.find.add_word(s, len(s))
        self.find.make_automaton()

    def weight(self, word: str) -> tuple[int, float]:
        for n in range(min(len(word), self.longest), 2, -1):
            if (w := self.stems.get(word[:n])) is not None:
                return INSULT, w
        if word in THREATS:
            return THREAT, THREAT_WEIGHT
        return _CUES.get(word, OTHER), 0.0

    def score(self, text: str) -> tuple[float, int]:
        """(sum of clause scores, number of words)."""
        low, total, done = text.lower(), 0.0, -1
        for end, n in self.find.iter(low):
            at = end - n + 1
            if at < done or at and low[at - 1].isalpha():
                continue
            lo = max(low.rfind(c, 0, at) for c in ".!?;:\n") + 1
            cut = _CLAUSE_END.search(low, at)
            done = cut.start() if cut else len(low)
            total += clause_score(_WORD.findall(low, lo, done), self.weight)
        return total, len(low.split())


def _features_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of words: documents and occurrences by class, and totals under the empty prefix."""
    docs, hits = (Counter(), Counter()), (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            words = Counter(_WORD.findall((text.as_py() or "").lower()))
            own: Counter = Counter()
            for w, n in words.items():
                for k in range(3, min(len(w), 10) + 1):
                    own[w[:k]] += n
            own[""] = sum(words.values())
            hits[toxic].update(own)
            docs[toxic].update(own.keys())
    keys = sorted({*hits[0], *hits[1]})
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())] + [
        pa.array([c[k] for k in keys], pa.int64()) for c in (*docs, *hits)], names=["stem", "d0", "d1", "c0", "c1"])


def choose_stems(rows: list, n0: int, n1: int, w0: int, w1: int, least_ratio: float = 5.0) -> dict[str, float]:
    """Stems whose rate in toxic text is far above the rest, without those a shorter or longer one stands for."""
    seen = {r["stem"]: r for r in rows}
    ratio = {}
    for s, r in seen.items():
        by_doc = (r["d1"] / n1) / ((r["d0"] + 0.5) / n0)
        by_word = (r["c1"] / w1) / ((r["c0"] + 0.5) / w0)
        if by_doc >= least_ratio and by_word >= least_ratio:
            ratio[s] = float(np.log(by_word))
    longer: dict[str, int] = {}
    for s in ratio:
        longer[s[:-1]] = max(longer.get(s[:-1], 0), seen[s]["d1"])
    kept: dict[str, float] = {}
    for s in sorted(ratio, key=lambda s: (len(s), s)):
        if longer.get(s, 0) >= 0.97 * seen[s]["d1"]:
            continue  # its longer form occurs in the same documents and is more specific
        above = [kept[s[:k]] for k in range(3, len(s)) if s[:k] in kept]
        if not above or ratio[s] > max(above) + 0.7:
            kept[s] = ratio[s]
    return kept


def _inputs(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(total)), np.log1p(total), 10 * total / (words + 20), np.log1p(words) / 5])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, rounds: int = 60) -> np.ndarray:
    """Newton steps for ridge logistic regression, classes weighted alike."""
    b = np.zeros(x.shape[1])
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    reg = ridge * np.eye(x.shape[1]) * len(y) / 10
    reg[0, 0] = 1e-6 * len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (share * (p - y)) + reg @ b
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + reg, grad)
        b -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return b


def _clauses_task(stems: dict[str, float], with_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(stems)
        for batch in batches:
            kept = [c for c in batch.schema.names if with_text or c != "text"]
            got = [scorer.score(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())],
                names=[*kept, CLAUSES, N_WORDS])
    return run


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, least_share: float = 0.02):
    """(stems, logistic coefficients) from ``labels`` (doc_id, toxic); None without both classes. Of several labels of
    one id or one text the highest counts."""
    picked = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # broadcast: at most max_labelled rows of two numbers
    sample = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id")
              .groupBy("text").agg(F.max("toxic").alias("toxic")))
    sample = cut_lineage(sample)
    parts = sample.mapInArrow(_features_task, "stem string, d0 long, d1 long, c0 long, c1 long")
    sums = cut_lineage(parts.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "c0", "c1")]))
    whole = sums.where("stem = ''").first()
    if whole is None or not whole["d1"] or not whole["d0"]:
        return None
    n0, n1 = whole["d0"], whole["d1"]
    rows = sums.where((F.col("stem") != "") & (F.col("d1") >= max(3, least_share * n1))).collect()  # at most max_labelled / 3 words each
    stems = choose_stems(rows, n0, n1, max(whole["c0"], 1), max(whole["c1"], 1))
    fit = sample.mapInArrow(_clauses_task(stems), f"toxic int, {CLAUSES} double, {N_WORDS} long").toPandas()
    x = _inputs(fit[CLAUSES].to_numpy(), fit[N_WORDS].to_numpy())
    return stems, fit_logistic(x, fit["toxic"].to_numpy(float))


def _scored(docs: DataFrame, model, with_text: bool) -> tuple[DataFrame, Column]:
    stems, b = model if model else ({}, None)
    kept = [f for f in docs.schema if with_text or f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    got = docs.mapInArrow(_clauses_task(stems, with_text), f"{schema}, {CLAUSES} double, {N_WORDS} long")
    if b is None:
        return got, F.lit(0.0)
    c, n, b = F.col(CLAUSES), F.col(N_WORDS), [F.lit(float(v)) for v in b]
    return got, 1 / (1 + F.exp(-(b[0] + b[1] * F.log1p(c) + b[2] * 10 * c / (n + 20) + b[3] * F.log1p(n.cast("double")) / 5)))


def score(docs: DataFrame, model, cut: float = 0.7) -> DataFrame:
    """doc_id, score, predicted, clauses (sum of clause weights) of every whole text; one pass, no shuffle."""
    got, p = _scored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model, False)
    return got.select("doc_id", p.alias("score"), F.col(CLAUSES).alias("clauses")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int"))


def keep_clean(docs: DataFrame, model, cut: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that ``score`` does not predict toxic; one pass, no shuffle."""
    got, p = _scored(docs, model, True)
    return got.where(p < cut).select(*[f"`{c}`" for c in docs.columns])


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1

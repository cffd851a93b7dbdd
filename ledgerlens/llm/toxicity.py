"""Toxicity (operator 7): a weighted finite-state grammar over clauses.

A lexical transducer reads a word's letters and writes a symbol with a weight: an insult
(stems and weights are learnt from labelled rows), a threat, a target, a negation, a word of
reported speech. Four further transducers over symbols are composed with each other into one
machine: negation turns insults and threats within its reach into denied ones, reported
speech into quoted ones, a target marks those that follow it in the clause, and a last one
lets only matched symbols through. A clause's score is the sum of the weights on its accepting
path, by output symbol. A bare insult or threat, with no target, negation or report before it in
the clause, is a match too, of a class and weight of its own: most toxic texts hold no other.

The document's matched clauses, summed by symbol, go through a logistic regression on the
same labelled rows to give a probability. At most ``max_rows`` labelled rows (in the order of
a seeded hash) are learnt from; everything is scored over whole texts.

Null and empty texts match nothing and get the score of no match; null labels are not learnt
from; with no labels of both kinds the lexicon is empty and every score is the share of
toxic labels (0.5 without labels). Repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sheltered, stored
from .labelled import fit_logistic, labelled_sample, sigmoid

# --- fixed values: word lists in English, German, French and Spanish -------------------------
THREATS = frozenset(
    "kill hurt destroy beat stab shoot burn hang punish "
    "umbringen töten schlagen vernichten erschießen tuer frapper détruire brûler égorger "
    "matar golpear destruir quemar disparar".split())
TARGETS = frozenset(
    "you your yours yourself he she they them his her their these those "
    "du dich dir dein deine ihr euch euer tu toi ton ta vous votre vos ils elles "
    "tú usted ustedes vosotros vuestro ellos ellas".split())
NEGATIONS = frozenset(
    "not no never neither nor cannot don't isn't aren't wasn't won't "
    "nicht kein keine nie niemals pas jamais aucun nunca ningún tampoco".split())
REPORTS = frozenset(
    "said says say wrote writes claimed claims called calls quoted reported "
    "sagte sagt schrieb behauptete dit disait écrit affirme dijo dice escribió".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = "other insult threat target negation report quote".split()
#: How many words a negation reaches.
REACH = 3

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]|[\"“”„«»]")
_CLAUSE_END = frozenset(".!?;:\n")
_QUOTES = frozenset("\"“”„«»")
#: Letters of the stems that a lexicon may hold; a whole word ends with "$".
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)


class Transducer:
    """A deterministic weighted transducer over symbols.

    ``arcs`` maps (state, symbol) to (next state, symbol written, factor of the weight); a
    missing arc keeps the state and copies the symbol with factor 1.
    """

    def __init__(self, arcs: dict, start=0):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def symbols(self) -> set:
        return {s for _, s in self.arcs} | {out for _, out, _ in self.arcs.values()}

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one writes is read by ``other``."""
        arcs = {}
        alphabet = self.symbols() | other.symbols()
        states = {s for s, _ in self.arcs} | {a for a, _, _ in self.arcs.values()} | {self.start}
        others = {s for s, _ in other.arcs} | {a for a, _, _ in other.arcs.values()} | {other.start}
        for (a, b), symbol in product(product(states, others), alphabet):
            na, mid, fa = self.step(a, symbol)
            nb, out, fb = other.step(b, mid)
            arcs[(a, b), symbol] = ((na, nb), out, fa * fb)
        return Transducer(arcs, (self.start, other.start))


def negation() -> Transducer:
    arcs = {}
    for k in range(REACH + 1):
        arcs[k, NEGATION] = (REACH, OTHER, 1.0)
        for s in (OTHER, TARGET, REPORT, QUOTE):
            arcs[k, s] = (max(0, k - 1), s, 1.0)
        for s in (INSULT, THREAT):
            arcs[k, s] = (max(0, k - 1), f"denied {s}" if k else s, 1.0)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """States: 0 plain, 1 after a word of report, 2 inside quotation marks after one."""
    arcs = {(0, REPORT): (1, OTHER, 1.0), (1, REPORT): (1, OTHER, 1.0), (1, QUOTE): (2, OTHER, 1.0),
            (2, QUOTE): (1, OTHER, 1.0), (2, REPORT): (2, OTHER, 1.0), (0, QUOTE): (0, OTHER, 1.0)}
    for s in (INSULT, THREAT):
        arcs[1, s] = (1, f"quoted {s}", 1.0)
        arcs[2, s] = (2, f"quoted {s}", 1.0)
    return Transducer(arcs)


def target() -> Transducer:
    arcs = {(0, TARGET): (1, OTHER, 1.0), (1, TARGET): (1, OTHER, 1.0)}
    for s in (INSULT, THREAT):
        arcs[1, s] = (1, f"aimed {s}", 1.0)
    return Transducer(arcs)


def matched() -> Transducer:
    """Lets classes of matches through, bare insults and threats included, and drops the weight
    of all else."""
    return Transducer({(0, s): (0, OTHER, 0.0) for s in (TARGET, NEGATION, REPORT, QUOTE)})


MATCHES = [INSULT, THREAT, f"aimed {INSULT}", f"aimed {THREAT}", f"denied {INSULT}", f"denied {THREAT}",
           f"quoted {INSULT}", f"quoted {THREAT}"]


def grammar() -> Transducer:
    return negation().then(reported_speech()).then(target()).then(matched())


class Lexicon:
    """The lexical transducer: a letter trie whose nodes carry the weight of their stem."""

    def __init__(self, stems: dict[str, float]):
        self.root: dict = {}
        for stem, weight in stems.items():
            node = self.root
            for letter in stem:
                node = node.setdefault(letter, {})
            node[""] = weight

    def read(self, word: str) -> tuple[str, float]:
        """Symbol and weight of a word in lower case."""
        if word in NEGATIONS:
            return NEGATION, 0.0
        if word in TARGETS:
            return TARGET, 0.0
        if word in REPORTS:
            return REPORT, 0.0
        best, node = 0.0, self.root
        for letter in [*word, "$"]:
            node = node.get(letter)
            if node is None:
                break
            best = max(best, node.get("", 0.0))
        if best:
            return INSULT, best
        return (THREAT, 1.0) if word in THREATS else (OTHER, 0.0)


class Scorer:
    """Matches of the grammar in texts."""

    #: Words whose symbol is remembered.
    CACHE = 1 << 18

    def __init__(self, stems: dict[str, float]):
        self.lexicon, self.machine = Lexicon(stems), grammar()
        self.known: dict[str, tuple[str, float]] = {}

    def _symbol(self, token: str) -> tuple[str, float]:
        if len(self.known) > self.CACHE:
            self.known.clear()
        found = (QUOTE, 0.0) if token in _QUOTES else self.lexicon.read(token)
        self.known[token] = found
        return found

    def clause(self, symbols: list[tuple[str, float]]) -> dict[str, float]:
        """Weights of a clause by output symbol."""
        state, out = self.machine.start, {}
        for symbol, weight in symbols:
            state, written, factor = self.machine.step(state, symbol)
            if weight and factor and written != OTHER:
                out[written] = out.get(written, 0.0) + weight * factor
        return out

    def features(self, text: str | None) -> list[float]:
        """Per kind of match the log of its summed weight; the largest clause score, the logs
        of the matched clauses and of their share."""
        totals, most, hits, clauses = dict.fromkeys(MATCHES, 0.0), 0.0, 0, 1
        known, current, hot = self.known, [], False
        for m in _TOKEN.finditer(text.lower() if text else ""):
            token = m[0]
            if token in _CLAUSE_END:
                clauses += 1
                if hot:
                    found = self.clause(current)
                    for s, w in found.items():
                        totals[s] += w
                    most, hits = max(most, sum(found.values())), hits + bool(found)
                current, hot = [], False
                continue
            symbol = known.get(token) or self._symbol(token)
            current.append(symbol)
            hot = hot or symbol[1] > 0
        if hot:
            found = self.clause(current)
            for s, w in found.items():
                totals[s] += w
            most, hits = max(most, sum(found.values())), hits + bool(found)
        return [*(math.log1p(totals[s]) for s in MATCHES), most, math.log1p(hits),
                math.log1p(100 * hits / clauses)]


def stem_counts(sample: DataFrame) -> DataFrame:
    """Labelled texts of either label that hold a stem: ``stem, toxic, clean``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(re.findall(r"[^\W\d_]+", text.lower()))
                stems = {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n} | {w + "$" for w in words}
                counts.update((s, label) for s in stems)
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([counts[k] for k in keys], pa.int64())], names=["stem", "label", "n"])

    return (sample.mapInArrow(run, "stem string, label int, n long").groupBy("stem")
            .agg(F.sum(F.col("n") * F.col("label")).alias("toxic"),
                 F.sum(F.col("n") * (1 - F.col("label"))).alias("clean")))


def learn_stems(sample: DataFrame, min_toxic: int, min_odds: float, max_stems: int) -> dict[str, float]:
    """Stems that are at least ``min_odds`` times commoner in toxic texts, with the log of that
    ratio as weight; at most ``max_stems``, the most telling ones."""
    totals = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, clean = int(totals[0]), int(totals[1] - totals[0])
    if not toxic or not clean:
        return {}
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    rows = (stem_counts(sample).where((F.col("toxic") >= min_toxic) & (odds >= min_odds))
            .select("stem", F.log(odds).alias("weight"), "toxic")
            .orderBy(F.desc(F.col("weight") * F.col("toxic")), "stem").limit(max_stems).collect())
    return {r["stem"]: r["weight"] for r in rows}


def learn(sample: DataFrame, min_toxic: int = 5, min_odds: float = 20.0,
          max_stems: int = 4000) -> tuple[dict[str, float], np.ndarray]:
    """Stems and regression weights from labelled ``text, label`` (bounded in number).

    Stems are learnt from one half of the texts (by a hash of the text, so that copies stay
    together), the regression from matches in the other half, and then the stems from all.
    """
    half = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    width = len(MATCHES) + 3

    def features(rows: DataFrame, stems: dict[str, float]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(stems)
            for batch in batches:
                x = [scorer.features(t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])
        return rows.mapInArrow(run, "x array<double>, label int").collect()

    found = []
    for learn_from, fit_on in ((half, ~half), (~half, half)):
        found += features(sample.where(fit_on), learn_stems(sample.where(learn_from), min_toxic, min_odds, max_stems))
    y = np.array([r["label"] for r in found], float)
    x = np.array([r["x"] for r in found], float).reshape(len(found), width)
    stems = learn_stems(sample, min_toxic, min_odds, max_stems)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        z = math.log((share + 1e-6) / (1 - share + 1e-6))
        return stems, np.array([z] + [0.0] * width)
    return stems, fit_logistic(x, y)


def toxicity(docs: DataFrame, stems: dict[str, float], weights: np.ndarray, id_col: str = "doc_id",
             text_col: str = "text", extra: bool = False) -> DataFrame:
    """Score (0 to 1) of every row: ``doc_id, score``, or all columns and ``__score``."""
    given = docs.columns
    docs, _ = sheltered(docs, id_col, text_col)
    keep = docs.columns if extra else [id_col]
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("__read"))
    names = [*keep, "__score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(stems)
        for batch in batches:
            texts = batch.column(len(keep))
            x = np.array([scorer.features(texts[i].as_py()) for i in range(len(texts))], float)
            score = sigmoid(weights[0] + x.reshape(len(texts), -1) @ weights[1:]) if len(texts) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(score)],
                                             names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    out = rows.mapInArrow(run, f"{schema}, __score double")
    return out.toDF(*given, "__score") if extra else out.select(F.col(id_col).alias("doc_id"), F.col("__score").alias("score"))


def learnt_from(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = 16000,
                seed: int = 5, **parameters) -> tuple[dict[str, float], np.ndarray]:
    """Learn from at most ``max_rows`` rows of ``labels``, joined with their texts."""
    return learn(stored(labelled_sample(docs, labels, label_col, max_rows, seed), "labelled"), **parameters)

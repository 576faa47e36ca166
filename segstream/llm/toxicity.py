"""Toxicity by a weighted finite-state grammar over clauses.

A text's words become symbols: insult (I), threat (T), target (Y), negation
(N), report verb or quotation (R), any other (O). Small transducers rewrite the
symbols of one clause: negation marks insults and threats within a few words
after a negating word, reported speech marks them from the report to the end of
the clause, and the target transducer, run in both directions, marks those that
stand with a person. They are composed into one machine. A clause adds the
weights of its marked insults and threats to its marks' sums; a logistic model
over these sums gives the score, so an insult that is negated or reported
counts for what such clauses were worth in the labelled rows.

Insults are learned: words and word beginnings (stems) that toxic training
texts share and clean ones lack, picked greedily until most toxic texts are
covered ``COVER`` times; copies of a text count once. The training sample is
bounded (``fit_toxic`` and ``fit_clean`` rows by hash) and only holds rows whose
crc32(doc_id) mod 4 is not 2. Scoring reads whole texts: an automaton finds
candidate insults and threats, and only clauses that hold one are parsed.

Defined results: a null or empty text has no clause and gets the model's base
score; rows with a null doc_id are never held out and never trained on; a
label that is null is ignored, and of a doc_id with several labels the largest
counts; without toxic or clean training rows the fixed words alone are used;
repeated rows get equal scores; an empty table gives an empty result; input
columns named like an output give way to it.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import with_outputs

#: Words of the grammar in English, French, German and Spanish.
THREATS = "kill hurt destroy burn stab shoot tuer frapper töten umbringen schlagen matar golpear".split()
TARGETS = "you your yours u he she they them tu toi vous ton votre du dich dir ihr sie dein tú ti usted ustedes".split()
NEGATIONS = "not no never nor isn't aren't don't ne pas jamais kein keine nicht nie nunca ni".split()
REPORTS = "said says called wrote quoted claimed reported dit écrit appelé sagte schrieb nannte dijo escribió llamó".split()
INSULTS = "idiot moron stupid scum imbécile crétin trottel dummkopf estúpido imbécil".split()

WORD = re.compile(r"[\w']+")
CLAUSE_END = re.compile(r"[.!?;:\n|]+")
QUOTE = re.compile(r"[\"«»“”„]")
REACH = 3  #: words that a negation reaches
COVER = 3  #: lexicon units that a toxic training text should hold
STEMS = range(4, 8)  #: lengths of word beginnings
MARKS = ("", "y", "n", "r")  #: plain, with a target, negated, reported
FEATURES = [a + m for a in "IT" for m in MARKS]

Machine = dict[tuple[object, str], tuple[object, str]]


def mark(symbol: str, flag: str) -> str:
    return symbol if flag in symbol else symbol + flag


def harms(flags: str = "") -> list[str]:
    """I and T with every set of the marks in ``flags``."""
    out = ["I", "T"]
    for f in flags:
        out += [s + f for s in out]
    return out


def negation(symbols: Iterable[str]) -> Machine:
    m: Machine = {}
    for state in range(REACH + 1):
        for s in symbols:
            if s == "N":
                m[state, s] = (REACH, s)
            elif s[0] in "IT" and state:
                m[state, s] = (state - 1, mark(s, "n"))
            else:
                m[state, s] = (max(0, state - 1), s)
    return m


def remembering(symbols: Iterable[str], opener: str, flag: str) -> Machine:
    """Marks insults and threats after the opener, up to the end of the clause."""
    m: Machine = {}
    for state in (0, 1):
        for s in symbols:
            m[state, s] = (1 if s == opener else state, mark(s, flag) if state and s[0] in "IT" else s)
    return m


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that feeds the output of ``first`` to ``second``."""
    m: Machine = {}
    states = {s for s, _ in second}
    for (p, symbol), (p2, out) in first.items():
        for q in states:
            if (q, out) in second:
                q2, last = second[q, out]
                m[(p, q), symbol] = ((p2, q2), last)
    return m


PLAIN = ["I", "T", "Y", "N", "R", "O"]
FORWARD = compose(compose(negation(PLAIN), remembering([*harms("n"), *"YNRO"], "R", "r")), remembering([*harms("nr"), *"YNRO"], "Y", "y"))
BACKWARD = remembering([*harms("nry"), *"YNRO"], "Y", "y")


def run(machine: Machine, start: object, symbols: list[str]) -> list[str]:
    out, state = [], start
    for s in symbols:
        state, o = machine[state, s]
        out.append(o)
    return out


def parse(symbols: list[str]) -> list[str]:
    forward = run(FORWARD, ((0, 0), 0), symbols)
    return run(BACKWARD, 0, forward[::-1])[::-1]


class Grammar:
    """Lexicon, machines and the logistic model; small, shipped to every task."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.classes = {w: "Y" for w in TARGETS} | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTS} | {w: "T" for w in THREATS}
        self.coefficients, self.bias = np.array([2.0, 2.5, -0.5, 0.2, 0.5, 1.0, -0.5, 0.0]), -3.0
        self.finder = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"finder": None}

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.words.get(word)
        if weight is None:
            for n in STEMS:
                weight = self.stems.get(word[:n]) if len(word) >= n else None
                if weight is not None:
                    break
        if weight is not None:
            return "I", weight
        return self.classes.get(word, "O"), 1.0

    def clauses(self, text: str) -> Iterable[str]:
        """The clauses that hold a candidate insult or threat, each once."""
        if self.finder is None:
            import ahocorasick

            self.finder = ahocorasick.Automaton()
            for unit in {*self.words, *self.stems, *THREATS}:
                self.finder.add_word(unit, len(unit))
            self.finder.make_automaton()
        end = 0
        for last, length in self.finder.iter(text):
            first = last - length + 1
            if first < end or (first and (text[first - 1].isalnum() or text[first - 1] == "_")):
                continue  # parsed already, or not at the beginning of a word
            begin = end
            for m in CLAUSE_END.finditer(text, end):
                if m.start() > first:
                    end = m.end()
                    break
                begin = m.end()
            else:
                end = len(text)
            yield text[begin:end]

    def features(self, text: str | None) -> np.ndarray:
        sums = dict.fromkeys(FEATURES, 0.0)
        for clause in self.clauses((text or "").lower()):
            found = [(w, *self.symbol(w)) for w in WORD.findall(QUOTE.sub(" said ", clause))]
            for (_, _, weight), s in zip(found, parse([f[1] for f in found])):
                if s[0] in "IT":
                    flag = "n" if "n" in s else "r" if "r" in s else "y" if "y" in s else ""
                    sums[s[0] + flag] += weight
        return np.log1p(np.array([sums[f] for f in FEATURES]))

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients + self.bias, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> None:
        """Weighted ridge logistic regression by Newton steps."""
        z, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
        penalty = np.diag([*[ridge] * x.shape[1], 1e-3])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + penalty
            step = np.linalg.solve(hessian, z.T @ (weight * (y - p)) - penalty @ w)
            w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        self.coefficients, self.bias = w[:-1], float(w[-1])


def units(text: str) -> set[str]:
    """The text's words (``=word``) and word beginnings."""
    words = {w for w in WORD.findall(text.lower()) if w.isalpha()}
    return {"=" + w for w in words if len(w) > 2} | {w[:n] for w in words for n in STEMS if len(w) >= n}


def without_copies(texts: list[str]) -> list[str]:
    """One text of each group that shares its two smallest shingle hashes."""
    seen: dict[tuple, str] = {}
    for t in texts:
        w = t.lower().split()
        h = {xxhash.xxh64_intdigest(" ".join(w[i : i + 4])) for i in range(max(1, len(w) - 3))}
        seen.setdefault(tuple(sorted(h)[:2]), t)
    return list(seen.values())


def learn_lexicon(toxic: list[str], clean: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Weighted words and stems, by greedy cover of the toxic texts."""
    toxic, clean = without_copies(toxic), without_copies(clean)
    holders: dict[str, list[int]] = defaultdict(list)
    for i, t in enumerate(toxic):
        for u in units(t):
            holders[u].append(i)
    support = max(3, math.ceil(0.01 * len(toxic)))
    holders = {u: d for u, d in holders.items() if len(d) >= support}
    against: Counter = Counter()
    for t in clean:
        against.update(u for u in units(t) if u in holders)
    rate = {u: (len(d) / len(toxic)) / ((against[u] + 0.5) / (len(clean) + 1)) for u, d in holders.items()}
    # few clean texts may hold a unit, and rarely against how often toxic ones do
    usable = {u: d for u, d in holders.items() if rate[u] >= 20 and against[u] <= 0.02 * len(d) + 0.002 * len(clean) * (len(d) > 20)}
    need = np.full(len(toxic), COVER)
    words, stems = {}, {}
    while usable:
        gain = {u: int((need[d] > 0).sum()) for u, d in usable.items()}
        unit = max(gain, key=lambda u: (gain[u], rate[u], u.startswith("="), -len(u), u))
        if gain[unit] < support:
            break
        rows = np.array(usable.pop(unit))
        need[rows] -= 1
        name = unit.removeprefix("=")
        (words if unit.startswith("=") else stems)[name] = 1.0
        # what only repeats the unit (its longer or shorter forms) adds nothing new
        chosen = set(rows.tolist())

        def repeats(u: str, d: list[int]) -> bool:
            v = u.removeprefix("=")
            return (v.startswith(name) or name.startswith(v)) and len(chosen.intersection(d)) >= 0.5 * len(d)

        usable = {u: d for u, d in usable.items() if gain[u] >= support and not repeats(u, d)}
    return words, stems


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def train(docs: DataFrame, labels: DataFrame, fit_toxic: int = 1000, fit_clean: int = 4000) -> Grammar:
    """Grammar learned from the labelled rows of ``docs`` that aren't held out."""
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(remainder(F.col("doc_id"), 4) != 2)
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # one row for each label
    bound = {1: fit_toxic, 0: fit_clean}
    picked = [marked.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in bound.items()]
    chosen = picked[0].union(picked[1])
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"]).orderBy("doc_id", "text").limit(2 * (fit_toxic + fit_clean)).collect()
    by = {y: [r["text"] for r in rows if r["toxic"] == y] for y in (0, 1)}
    if not by[0] or not by[1]:
        return Grammar(dict.fromkeys(INSULTS, 1.0), {})
    words, stems = learn_lexicon(by[1], by[0])
    grammar = Grammar(dict.fromkeys(INSULTS, 1.0) | words, stems)
    x = np.array([grammar.features(t) for t in by[0] + by[1]])
    y = np.array([0.0] * len(by[0]) + [1.0] * len(by[1]))
    share = np.where(y == 1, sizes[1] / len(by[1]), sizes[0] / len(by[0]))
    grammar.fit(x, y, share / share.mean())
    return grammar


def score_column(docs: DataFrame, labels: DataFrame, fit_toxic: int = 1000, fit_clean: int = 4000) -> Column:
    """The toxicity of column ``text``, by a grammar learned from ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fit_toxic, fit_clean))

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts))

    return toxic(F.col("text").cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_toxic: int = 1000, fit_clean: int = 4000) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    scored = with_outputs(docs, held_out=held, score=score_column(docs, labels, fit_toxic, fit_clean))
    return with_outputs(scored, predicted=(F.col("score") >= threshold).cast("int"))

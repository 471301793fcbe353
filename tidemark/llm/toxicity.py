"""Toxicity by a weighted finite-state pattern grammar over clauses.

Tokens become symbols (insult, threat verb, target, negation, report, other). Small transducers that tell whether a target,
negation, report or threat verb is near are composed with those for insults and threats into one; its outputs say how what
was said is meant: plain, aimed at somebody, negated, reported, or a threat, and how many tokens back. The insult lexicon (words and word beginnings) and the weights of
the outputs are learned from labelled rows; nothing but the text is an input of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import arrow, scope, table
from tidemark.shipping import ship

SAMPLE_ROWS = 20_000  # labelled rows that the lexicon and weights are learned from, by least hash of doc_id
SUPPORT = 8  # different contexts in toxic texts that a lexicon entry needs
PREFIXES = (4, 5, 6, 7)
HELD_TERMS = 100_000  # counts that a task holds before it sends them

# fixed values: function words of the four languages
NEGATIONS = frozenset("not no never neither nor isn't aren't wasn't don't nicht kein keine nie pas jamais aucun ni nunca jamás tampoco".split())
REPORTS = frozenset("said says wrote called claimed quoted reported alleged sagte sagt nannte schrieb dit disait écrit appelé dijo dice escribió llamó".split())
TARGETS = frozenset("you your you're u he she they him her them people du dich dir ihr euch sie er tu toi vous votre il elle tú usted ustedes ellos".split())
THREATS = frozenset("kill hurt destroy shoot stab strangle burn murder töten umbringen schlagen tuer frapper matar golpear".split())

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_ENDS = ".!?;:\n"
CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")
AFTER = 3  # tokens after an insult in which a target still makes it aimed

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "ITGNRO"
PLAIN, AIMED, NEGATED, REPORTED, MENACE = range(5)


@dataclass(frozen=True)
class Within:
    """A transducer whose state is how many tokens back a symbol was seen, up to `reach`; it outputs whether it still holds."""

    symbol: str
    reach: int

    def step(self, state: int, symbol: str) -> tuple[int, bool]:
        state = self.reach if symbol == self.symbol else max(0, state - 1)
        return state, state > 0


NEAR = (Within(TARGET, 4), Within(NEGATION, 3), Within(REPORT, 12), Within(THREAT, 3))


class Insults:
    """A transducer over (symbol, what is near) that outputs (meaning, tokens back) of insults. Its state is a bit for each of the
    last AFTER tokens that was an insult a target may still follow, the latest lowest."""

    def step(self, state: int, symbol: str, near: tuple[bool, ...]) -> tuple[int, list[tuple[int, int]]]:
        aimed, negated, reported, _ = near
        state, out = state << 1, []
        if symbol == TARGET:
            out, state = [(AIMED, back) for back in range(AFTER, 0, -1) if state >> back & 1], 0
        elif state >> AFTER & 1:
            out, state = [(PLAIN, AFTER)], state & ~(1 << AFTER)
        if symbol == INSULT:
            if negated or reported or aimed:
                out = [*out, (NEGATED if negated else REPORTED if reported else AIMED, 0)]
            else:
                state |= 1
        return state, out

    def end(self, state: int) -> list[tuple[int, int]]:
        return [(PLAIN, back) for back in range(AFTER - 1, -1, -1) if state >> back & 1]


class Threats:
    """A transducer over (symbol, what is near) that outputs the meaning of a target soon after a threat verb."""

    def step(self, state: int, symbol: str, near: tuple[bool, ...]) -> tuple[int, list[tuple[int, int]]]:
        _, negated, reported, menaced = near
        return 0, [(REPORTED if reported else MENACE, THREATENED)] if symbol == TARGET and menaced and not negated else []

    def end(self, state: int) -> list[tuple[int, int]]:
        return []


THREATENED = -1  # in place of tokens back: the output weighs one


class Composed:
    """The composition of transducers over symbols with transducers over (symbol, their outputs), as one transition table that is
    filled while it runs. States are numbers."""

    def __init__(self, near: tuple[Within, ...], then: tuple):
        self.near, self.then = near, then
        self.names = [((0,) * len(near), (0,) * len(then))]
        self.numbers, self.moves = {self.names[0]: 0}, {}

    def _move(self, state: int, symbol: str) -> tuple[int, list[tuple[int, int]]]:
        near, then = self.names[state]
        seen = [t.step(s, symbol) for t, s in zip(self.near, near)]
        told = tuple(x[1] for x in seen)
        made = [t.step(s, symbol, told) for t, s in zip(self.then, then)]
        name = tuple(x[0] for x in seen), tuple(x[0] for x in made)
        if name not in self.numbers:
            self.numbers[name] = len(self.names)
            self.names.append(name)
        got = self.moves[state, symbol] = self.numbers[name], [out for x in made for out in x[1]]
        return got

    def read(self, symbols: list[str], weights: list[float]) -> list[float]:
        """The outputs of a clause by meaning, each weighing what its token does."""
        total, state = [0.0] * 5, 0
        for i, symbol in enumerate(symbols):
            state, out = self.moves.get((state, symbol)) or self._move(state, symbol)
            for meaning, back in out:
                total[meaning] += 1.0 if back == THREATENED else weights[i - back]
        for t, s in zip(self.then, self.names[state][1]):
            for meaning, back in t.end(s):
                total[meaning] += weights[len(symbols) - 1 - back]
        return total


GRAMMAR = Composed(NEAR, (Insults(), Threats()))


@dataclass(frozen=True)
class Lexicon:
    """Weights of insulting words, and of word beginnings."""

    words: dict[str, float]
    prefixes: dict[str, float]

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for k in PREFIXES:
            if len(word) > k:
                found = max(found, self.prefixes.get(word[:k], 0.0))
        return found

    def finder(self):
        """An automaton of all strings that can start a match."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for s in [*self.words, *self.prefixes, *THREATS]:
            found.add_word(s, len(s))
        if len(found):
            found.make_automaton()
        return found


def _clauses(text: str, finder) -> list[str]:
    """The whole clauses of a lower-cased text that hold possible matches, each once, in order."""
    out, done = [], 0
    for end, length in finder.iter(text) if len(finder) else ():
        begin = end - length + 1
        if begin < done or begin and text[begin - 1].isalpha():
            continue
        lo = max(done, *(text.rfind(c, done, begin) + 1 for c in CLAUSE_ENDS))
        stop = CLAUSE_END.search(text, end)
        done = stop.start() if stop else len(text)
        out.append(text[lo:done])
    return out


def _symbol(word: str, weight: float) -> str:
    return INSULT if weight else THREAT if word in THREATS else TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else OTHER


def features(text: str | None, lexicon: Lexicon, finder) -> list[float]:
    """log(1 + weight) of the text's matched clauses by meaning: plain, aimed, negated, reported, menace."""
    total = [0.0] * 5
    for clause in _clauses((text or "").lower(), finder):
        words = WORD.findall(clause)
        weights = [lexicon.weight(w) for w in words]
        for k, x in enumerate(GRAMMAR.read([_symbol(w, x) for w, x in zip(words, weights)], weights)):
            total[k] += x
    return [float(np.log1p(x)) for x in total]


def _terms(words: list[str]) -> Iterator[tuple[str, str, int]]:
    """(term, kind, place) of words: the words themselves and their beginnings."""
    for i, w in enumerate(words):
        if len(w) > 2:
            yield w, "w", i
        for k in PREFIXES:
            if len(w) > k:
                yield w[:k], "p", i


def _letters(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Entries from rows (text, toxic): terms far likelier in toxic texts, seen in many contexts, not in copies of one text."""

    def packed(found: tuple[Counter, Counter]) -> pa.RecordBatch:
        keys = list(found[0].keys() | found[1].keys())
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), *(pa.array([f[k] for k in keys], pa.int64()) for f in found)], ["term", "kind", "clean", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                found[toxic.as_py()].update({(t, k) for t, k, _ in _terms(_letters(text.as_py()))})
                if len(found[0]) + len(found[1]) > HELD_TERMS:
                    yield packed(found)
                    found = Counter(), Counter()
        yield packed(found)

    texts = table(sample.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-texts")
    size = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, {})
    counts = arrow(texts.select("text", F.col("toxic").cast("int")), count, "term string, kind string, clean long, toxic long").groupBy("term", "kind").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    support = min(SUPPORT, max(2, n_toxic // 10))
    likely = table(counts.where(F.col("toxic") >= support).withColumn("odds", odds).where("odds > 2.5").select("term", "kind", "odds"), "toxic-terms")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                words = ["", *_letters(text.as_py()), ""]
                seen = sorted({(t, k, f"{words[i]} {words[i + 2]}") for t, k, i in _terms(words[1:-1])})
                for at in range(0, len(seen), HELD_TERMS):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*seen[at : at + HELD_TERMS])], ["term", "kind", "near"])

    near = arrow(texts.where("toxic = 1").select("text"), contexts, "term string, kind string, near string").join(likely.select("term", "kind"), ["term", "kind"]).distinct()
    wide = near.groupBy("term", "kind").count().where(F.col("count") >= support).select("term", "kind")
    entries = likely.join(wide, ["term", "kind"]).collect()  # each from SUPPORT of the sample's toxic texts, so bounded by the sample
    words, prefixes = {}, {}
    for r in sorted(entries, key=lambda r: (len(r.term), r.term, r.kind == "w")):
        if any(r.term[:k] in prefixes for k in PREFIXES):
            continue
        (words if r.kind == "w" else prefixes)[r.term] = round(min(r.odds, 6.0), 3)
    return Lexicon(words, prefixes)


# bias and weights before any label is seen; plain, aimed, negated, reported, menace
PRIOR = np.array([-3.0, 2.5, 3.0, 0.5, 0.8, 4.0])
RIDGE = 2.0


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 25) -> np.ndarray:
    """Ridge-logistic weights around PRIOR."""
    a, w = np.hstack([np.ones((len(x), 1)), x]), PRIOR.copy()
    for _ in range(steps if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + RIDGE * np.eye(a.shape[1])
        w = w - np.linalg.solve(hess, a.T @ (p - y) + RIDGE * (w - PRIOR))
    return w


@dataclass(frozen=True)
class Grammar:
    lexicon: Lexicon
    weights: np.ndarray


def _features(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The first column, and x: features of the column text."""
    key = texts.columns[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = lexicon.finder()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t.as_py(), lexicon, finder) for t in batch.column(1)], pa.list_(pa.float64()))], [key, "x"])

    return arrow(texts, scan, f"{key} {texts.schema[0].dataType.simpleString()}, x array<double>")


def held_out(doc_id: str) -> Column:
    """crc32 of the id as text, mod 5, is 0: rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Grammar:
    """A grammar from at most `sample` labelled documents that are not held out; without labels the prior weights and no lexicon.
    Of rows that repeat an id one text is learned from, that of the least hash, so the sample is bounded whatever docs hold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("own")).select("own.text", "own.toxic"), "toxic-sample")
    lexicon = learn_lexicon(rows)
    seen = _features(rows.select("toxic", "text"), lexicon).collect()  # five numbers a sampled row
    x, y = np.array([r.x for r in seen]).reshape(-1, 5), np.array([r.toxic for r in seen], float)
    return Grammar(lexicon, fit_weights(x, y))


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, score) of every row: 0 to 1, higher where clauses insult or threaten. Null and empty texts get the bias alone;
    repeated rows are scored apart; only doc_id and text are read."""
    w = grammar.weights
    z = F.lit(float(w[0]))
    for k in range(5):
        z = z + F.element_at("x", k + 1) * float(w[k + 1])
    made = _features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), grammar.lexicon)
    return made.select("doc_id", F.round(1 / (1 + F.exp(-z)), 9).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): every document scored by a grammar learned from the labels that are not held out."""
    with scope(docs.sparkSession):
        grammar = train(docs, labels)
    scored = score(docs, grammar)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows scored 0.5 or more; all columns stay as they are. Only texts go through Python. Null and empty texts
    and repeated rows are judged like others, each by its text; an empty table gives no rows."""
    with scope(docs.sparkSession):
        grammar = train(docs, labels)
    w, lexicon, finders = grammar.weights, grammar.lexicon, []

    @F.arrow_udf("boolean")
    def toxic(texts: pa.Array) -> pa.Array:
        finders[:] = finders or [lexicon.finder()]
        x = np.array([features(t.as_py(), lexicon, finders[0]) for t in texts]).reshape(-1, 5)
        return pa.array(np.round(1 / (1 + np.exp(-(x @ w[1:] + w[0]))), 9) >= 0.5)

    ship(docs.sparkSession)
    return docs.where(~toxic(F.col("text").cast("string")))

"""Toxicity: a lexicon trie under Levenshtein automata, weighed by context and learned weights.

Terms are a fixed list of insults plus terms mined from labelled rows: whole words, and word
beginnings for languages that inflect. They form one trie. A word is matched by the Levenshtein
automaton of the trie's terms, that is by the intersection of the two: a state is the set of
(trie node, edits spent) still possible, determinised step by step and remembered, so that a
word costs one table look-up per letter and stops as soon as no term is in reach. Terms of 5 to 9
letters allow one edit, longer ones two, shorter ones and word beginnings none.

Each hit is judged in its context window: inside quotation marks or after a word that reports
speech it counts as quoted, beside an address (you, du, tu ...), another hit or an exclamation
mark as an attack. A document's sums of these go into a logistic model.

Labels come from a bounded sample (``TRAIN_ROWS``) of the labelled training rows; the model is
fitted on features made with terms mined from the other half of the sample, so that chance terms
do not look better than they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import filter_rows, keep_plan, pick

TRAIN_ROWS = 8000  # labelled rows that a fit uses at most, by hash of doc_id
MINED_TERMS = 800  # mined terms at most
LEAST_DOCS = 3  # toxic documents of the sample that a mined term must stand in
WINDOW = 6  # words on either side of a hit that make its context

# Insults, words that report speech, words of address.
INSULTS = """asshole bastard bitch bollocks brainless clown coward creep cretin crap damn degenerate despicable
dimwit dirtbag disgrace disgusting dumb dumbass dunce filth filthy fool freak garbage halfwit hideous idiot idiotic
ignorant imbecile inferior jackass jerk lame liar loser lowlife lunatic moron moronic nitwit parasite pathetic pig
pathetic psycho rat repulsive retard retarded rotten scum scumbag shit shut sicko slime slob slut sleazy stupid
stupidity subhuman trash traitor twat twit ugly useless vermin vile whore wimp worthless wretch
dummkopf trottel idiotin arschloch scheisse schwein abschaum connard salaud crétin merde ordure imbécile
estúpido imbécil idiota basura mierda cabrón pendejo asqueroso inútil""".split()
REPORTING = set("""said says say wrote writes called calls word term phrase quote quoted quotes quoting spelled
meaning means definition sagte schrieb nannte wort zitat dit écrit appelé mot terme citation dijo escribió llamó
palabra término cita""".split())
ADDRESS = set("you your youre yours u ur yourself du dein deine euch ihr tu toi vous votre usted ustedes tú vosotros".split())
QUOTES = "\"“”„«»‹›"
_WORD = re.compile(r"[^\W\d_]+")
FEATURES = ("weight", "exact", "near", "begins", "quoted", "attack", "kinds", "density")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class Lexicon:
    """Trie of weighted terms; a term ending in ``*`` matches every longer word that begins so."""

    def __init__(self, terms: dict[str, float]):
        self.terms = sorted(terms)
        self.weight = [terms[t] for t in self.terms]
        self.kids: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.reach: list[int] = [0]  # most edits that any term below allows
        for i, t in enumerate(self.terms):
            node, stem = 0, t.endswith("*")
            budget = 0 if stem else edits_allowed(t)
            self.reach[0] = max(self.reach[0], budget)
            for ch in t.rstrip("*"):
                if ch not in self.kids[node]:
                    self.kids[node][ch] = len(self.kids)
                    self.kids.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.reach.append(0)
                node = self.kids[node][ch]
                self.reach[node] = max(self.reach[node], budget)
            (self.stem if stem else self.word)[node] = i
        self._restart()

    def _restart(self) -> None:
        self._id: dict[tuple, int] = {}
        self._sets: list[tuple] = []
        self._next: list[dict[str, int]] = []
        self._hit: list[tuple] = []
        self._start = self._state({0: 0}, -1)
        self._known: dict[str, tuple | None] = {}

    def __getstate__(self):
        return dict(zip(self.terms, self.weight))

    def __setstate__(self, terms):
        self.__init__(terms)

    def _state(self, nodes: dict[int, int], stem: int) -> int:
        """Number of the state for {node: least edits}, with terms' letters left out as edits."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if nodes[node] < e:
                continue
            for kid in self.kids[node].values():
                if e + 1 <= self.reach[kid] and nodes.get(kid, 9) > e + 1:
                    nodes[kid] = e + 1
                    todo.append((kid, e + 1))
        key = (tuple(sorted(nodes.items())), stem)
        if key not in self._id:
            self._id[key] = len(self._sets)
            self._sets.append(key)
            self._next.append({})
            ends = [(e, -len(self.terms[self.word[n]]), self.word[n]) for n, e in key[0]
                    if self.word[n] >= 0 and e <= edits_allowed(self.terms[self.word[n]])]
            best = min(ends) if ends else None
            if best and (best[0] == 0 or stem < 0):
                self._hit.append((best[2], "exact" if best[0] == 0 else "near"))
            else:
                self._hit.append((stem, "begins") if stem >= 0 else None)
        return self._id[key]

    def _step(self, state: int, ch: str) -> int:
        nodes, stem = self._sets[state]
        new: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] and new.get(node, 9) > e:
                new[node] = e

        for node, e in nodes:
            kid = self.kids[node].get(ch)
            if kid is not None:
                put(kid, e)
                if e == 0 and self.stem[kid] >= 0:
                    stem = self.stem[kid]
                if e == 0 and kid not in new:
                    new[kid] = 0  # on the way to a word or stem without edits
            put(node, e + 1)
            for other in self.kids[node].values():
                if other != kid:
                    put(other, e + 1)
        out = self._state(new, stem)
        self._next[state][ch] = out
        return out

    def match(self, word: str) -> tuple | None:
        """(term, how) of a lower-case word, or None."""
        if len(self._sets) > 200_000 or len(self._known) > 400_000:  # bounds what a long-lived worker remembers
            self._restart()
        state = self._start
        for ch in word:
            nxt = self._next[state].get(ch)
            state = self._step(state, ch) if nxt is None else nxt
            if not self._sets[state][0]:
                break
        self._known[word] = self._hit[state]
        return self._hit[state]

    def features(self, text: str | None) -> list[float]:
        """The sums of a document's hits; see FEATURES."""
        out = dict.fromkeys(FEATURES, 0.0)
        text = text or ""
        low = text.lower()
        words = _WORD.findall(low)
        known = self._known
        found = {}
        for w in set(words):
            hit = known[w] if w in known else self.match(w)
            if hit:
                found[w] = hit
        if found:
            spans = [m.span() for m in _WORD.finditer(low)]
            at = [i for i, w in enumerate(words) if w in found]
            for n, i in enumerate(at):
                term, how = found[words[i]]
                a, b = spans[i]
                left = low[spans[max(0, i - WINDOW)][0]:a]
                right = low[b:spans[min(len(words) - 1, i + WINDOW)][1] + 2]
                quoted = ((sum(left.count(q) for q in QUOTES) % 2 == 1 and any(q in right for q in QUOTES))
                          or any(w in REPORTING for w in words[max(0, i - 3):i]))
                attack = (any(w in ADDRESS for w in words[max(0, i - WINDOW):i + WINDOW + 1])
                          or n > 0 and i - at[n - 1] <= WINDOW or n + 1 < len(at) and at[n + 1] - i <= WINDOW
                          or "!" in right[:2])
                if quoted:
                    out["quoted"] += 1
                    continue
                out["weight"] += max(0.0, self.weight[term])
                out[how] += 1
                out["attack"] += attack
            out["kinds"] = len({found[w][0] for w in found})
            out["density"] = 100 * len(at) / len(words)
        return [float(np.log1p(out[f])) for f in FEATURES]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (last: intercept) of ridge logistic regression by Newton's method."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_rows(labels: DataFrame, docs: DataFrame, label: str, modulus: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, text, y, half) of at most ``rows`` labelled rows whose crc32 class is not held out."""
    labels = (pick(labels, "doc_id", label).dropna().groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .where(F.crc32(F.col("doc_id").cast("string")) % modulus != held_out)
              .withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(rows))
    few = F.broadcast(labels.select("doc_id", "y", F.pmod("_h", F.lit(2)).alias("half")))  # at most ``rows`` rows
    return keep_plan(pick(docs, "doc_id", "text").join(few, "doc_id"))


def mined_terms(sample: DataFrame) -> list[dict[str, float]]:
    """Weighted terms mined from half 0, from half 1 and from the whole sample."""
    words = sample.select("y", "half", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w")).where("length(w) > 2")
    terms = words.select("y", "half", F.explode(F.expr(
        "filter(array(w, if(length(w) > 4, left(w, 4) || '*', null), if(length(w) > 5, left(w, 5) || '*', null), "
        "if(length(w) > 6, left(w, 6) || '*', null)), x -> x is not null)")).alias("t"))
    size = {(r.half, r.y): r.n for r in sample.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    # a beginning counts once per word, so its counts are occurrences of distinct words
    seen = terms.groupBy("t").agg(*[F.sum(((F.col("half") == h) & (F.col("y") == y)).cast("int")).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)])
    odds = []
    for i, halves in enumerate(((0,), (1,), (0, 1))):
        pos, neg = (sum(F.col(f"n{h}{y}") for h in halves) for y in (1, 0))
        all_pos, all_neg = (sum(size.get((h, y), 0) for h in halves) for y in (1, 0))
        odds.append((pos, F.log((pos + 0.5) / (all_pos + 1.0)) - F.log((neg + 0.5) / (all_neg + 1.0)), f"odds{i}"))
    for pos, o, name in odds:
        seen = seen.withColumn(name, F.when((pos >= LEAST_DOCS) & (o > 1.5), o).otherwise(0.0)).withColumn(
            name + "z", F.col(name) * F.sqrt(pos.cast("double")))
    top = (seen.where("greatest(odds0z, odds1z, odds2z) > 0").orderBy(F.greatest("odds0z", "odds1z", "odds2z").desc(), "t")
           .limit(4 * MINED_TERMS).collect())
    out = []
    for i in range(3):
        best = sorted((r for r in top if r[f"odds{i}"] > 0), key=lambda r: (-r[f"odds{i}z"], r.t))[:MINED_TERMS]
        out.append({t: 1.0 for t in INSULTS} | {r.t: r[f"odds{i}"] for r in best})
    return out


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def scores(self, texts: list) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = np.array([self.lexicon.features(t) for t in texts]) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    Without both classes among them (or without any) the fixed list decides with fixed weights.
    """
    sample = training_rows(labels, docs, "toxic", 5, 0, rows)
    first, second, both = (Lexicon(t) for t in mined_terms(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            half = b.column(2).to_pylist()
            x = [(second if h == 0 else first).features(t) for t, h in zip(b.column(0).to_pylist(), half)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    got = sample.select("text", "y", "half").mapInArrow(run, "y int, x array<double>").collect()  # at most ``rows``
    y = np.array([r.y for r in got], float)
    if len(set(y)) < 2:
        return Model(both, np.array([0, 2.0, 1.0, 1.0, -0.5, 0.5, 0, 0, -2.0]))
    order = np.lexsort([*np.array([r.x for r in got]).T, y])  # sums do not depend on the order of collection
    return Model(both, fit_logistic(np.array([r.x for r in got])[order], y[order]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text).

    Null and empty texts have no hits and get the model's intercept. A null doc_id is not held
    out. Repeated rows repeat; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                s = model.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])
    return (pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
            .select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
                    "score", "predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that the model does not call toxic."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                yield part.filter(pa.array(model.scores(part.column(at).to_pylist()) < 0.5))
    return filter_rows(docs, run)

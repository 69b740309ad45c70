"""Toxicity by Levenshtein automata over a lexicon trie, with scores by context.

The lexicon is learned: words, and stems with many endings, that hardly occur but in labelled toxic texts, or hardly but there without being quoted or reported; and
stems that innocent texts hold too, but hardly so often in so few words: those count where they are dense. A token
runs through the trie and all words' Levenshtein automata at once: a state is the set of trie nodes with the edits
spent so far, and states are made deterministic as tokens need them. A hit counts more if it is aimed at somebody and
less if it is quoted. A logistic regression turns the hits into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import aside, table, text_batches, written

#: Labelled rows of the bounded training sample, letters of a lexicon word at least, and in how many of the sample's toxic texts and how precisely it has to occur. (No share of all toxic texts is asked for: a rare language's words have none.)
SAMPLE, MIN_LETTERS, MIN_TEXTS, MIN_PRECISION = 12_000, 3, 5, 0.95
#: A stem is dense in a text that holds it so many times at least, and once in so many words; how precisely dense stems tell.
TIMES, WITHIN, DENSE_PRECISION = 2, 200, 0.9
#: Letters of a stem, and endings that make one.
STEM, ENDINGS = range(4, 9), 8
THRESHOLD = 0.7
CONTEXT = 4
#: Fixed values. Words near a hit that aim it at somebody, and that report it: in English, German, French and Spanish.
AIMED = frozenset("you your yours yourself you're youre u ur du dich dir dein deine deinen deinem deiner ihr euch euer eure eurer tu toi ton tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra".split())
REPORTED = frozenset(
    "said says say quote quoted quotes called wrote word words term phrase sagte sagt sagen zitat zitiert zitierte schrieb schreibt nannte wort wörter begriff "
    "disait dire citation cité écrit écrivait appelé mot mots terme expression dijo dice decir cita citado escribió escribe llamó palabra palabras término expresión".split()
)
QUOTES = "\"'«»‘’“”„‹›"
#: Fixed values. Characters that stand for letters.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
#: A hit's weight: quoted, plain, aimed.
WEIGHTS = (0.4, 1.0, 1.5)
#: Tokens, and states of the automaton, that a worker remembers.
REMEMBERED, STATES = 100_000, 20_000
EDGE = re.compile(r"^[^\w@$]+|[^\w$]+$")
#: What parts words that are glued together: all that is neither a letter nor a digit, at first without the signs that may stand for letters.
GLUE, SIGNS = re.compile(r"(?:[^\w@$!|]|_)+"), re.compile(r"[\W_]+")
REPEATED = re.compile(r"(.)\1{2,}")


def quoted(raw: str) -> bool:
    return raw[0] in QUOTES or raw.rstrip(".,:;!?")[-1:] in QUOTES


def bare(raw: str) -> str:
    return raw.strip(QUOTES + ".,:;!?()")


def plainly(tokens: list[str]) -> set[str]:
    """The tokens that stand somewhere neither in quotes nor near a word that reports them."""
    shade = {i for at, raw in enumerate(tokens) if bare(raw) in REPORTED for i in range(at - CONTEXT, at + CONTEXT + 1) if i != at}
    return {raw for raw in {x for at, x in enumerate(tokens) if at not in shade} if not quoted(raw)}


def edits_allowed(word: str) -> int:
    return 0 if len(word) < 5 else 1 if len(word) < 9 else 2


class Automaton:
    """All lexicon words within their allowed edits."""

    def __init__(self, words: list[str], stems: list[str] = ()):
        """A stem stands for itself with any ending and allows no edits."""
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.most = [0]
        self.stems: dict[int, str] = {}
        for w, stem in sorted({(w, False) for w in words} | {(w, True) for w in stems}):
            at, edits = 0, 0 if stem else edits_allowed(w)
            self.most[0] = max(self.most[0], edits)
            for c in w:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                    self.most.append(0)
                at = self.children[at][c]
                self.most[at] = max(self.most[at], edits)
            if stem:
                self.stems[at] = w
            else:
                self.word[at] = w
        self.alphabet = {c for x in self.children for c in x}
        self.reset()

    def reset(self) -> None:
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.moves: list[dict[str, int]] = [{}]
        self.final: list[tuple[int, str] | None] = [None]
        self.stem: list[str | None] = [None]
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, spent: dict[int, int]) -> frozenset:
        """Add what follows by letters left out of the token; keep each node's fewest edits."""
        todo = list(spent)
        while todo:
            at = todo.pop()
            for child in self.children[at].values():
                if (e := spent[at] + 1) <= self.most[child] and e < spent.get(child, 99):
                    spent[child] = e
                    todo.append(child)
        return frozenset(spent.items())

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.states:
            self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.moves.append({})
            self.stem.append(next((self.stems[at] for at, e in pairs if not e and at in self.stems), None))
            self.final.append(min(((e, self.word[at]) for at, e in pairs if self.word[at] and e <= edits_allowed(self.word[at])), default=None))
        return self.states[pairs]

    def _move(self, state: int, c: str) -> int:
        spent: dict[int, int] = {}

        def put(at: int, e: int) -> None:
            if e <= self.most[at] and e < spent.get(at, 99):
                spent[at] = e

        for at, e in self.sets[state]:
            put(at, e + 1)  # a letter too many
            for letter, child in self.children[at].items():
                put(child, e + (letter != c))
        to = self._state(self._closed(spent))
        self.moves[state][c] = to
        return to

    def find(self, token: str) -> tuple[int, str] | None:
        """(edits, word) of the closest lexicon word, or None."""
        state, moves = self.start, self.moves
        for c in token:
            c = c if c in self.alphabet else ""
            to = moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if not state:
                return None
            if self.stem[state]:
                return 0, self.stem[state]
        found = self.final[state]
        if len(self.sets) > STATES:
            self.reset()
        return found


@dataclass
class Model:
    lexicon: list[str]
    stems: list[str] = ()
    #: Tokens near a lexicon word that are in clean texts.
    innocent: frozenset = frozenset()
    #: Weights of the bias, of words and stems, of misspellings and of dense stems.
    coef: tuple[float, ...] = (-3.0, 6.0, 3.0, 3.0)
    dense: frozenset = frozenset()
    _automaton: Automaton | None = field(default=None, repr=False)
    _seen: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None, "_seen": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def look_up(self, raw: str) -> tuple[int, str]:
        """0: no hit; 1: a lexicon word, disguised or not; 2: a misspelling of one. With the letters that were found."""
        if self._automaton is None:
            self._automaton = Automaton(self.lexicon, self.stems)
            self._words = frozenset(self.lexicon)
        token = EDGE.sub("", raw)
        forms: dict[str, None] = {}
        for x in (token,) if token.isalpha() else (token, token.strip("@$!|")):  # a sign at an edge is a letter or none
            plain = x.translate(DISGUISE)
            if plain.isalpha():
                forms[plain] = None
                forms[REPEATED.sub(r"\1", plain)] = None
        if any(x in self._words for x in forms):
            return 1, token
        near = []
        for x in forms:
            found = self._automaton.find(x)
            if found is not None:
                if not found[0]:
                    return 1, token
                near.append(x)
        return (2, near[0]) if near and not any(x in self.innocent for x in near) else (0, token)

    def kinds(self, raw: str) -> tuple[tuple[int, str], ...]:
        """The hits of a token as a whole or, if it is none, of the words that are glued together in it."""
        whole = self.look_up(raw)
        if whole[0]:
            return (whole,)
        token = EDGE.sub("", raw)
        for between in () if token.isalpha() else (GLUE, SIGNS):
            if len(parts := [x for x in between.split(token) if x]) > 1:
                return tuple(x for part in parts for x in self.kinds(part))
        return ()

    def stem_of(self, raw: str) -> tuple[tuple[int, str], ...]:
        """The dense stem with which a token begins."""
        token = EDGE.sub("", raw)
        return next((((3, token[:n]),) for n in STEM if token[:n] in self.dense), ())

    @staticmethod
    def dense_only(hot: dict[str, tuple], tokens: list[str]) -> dict[str, tuple]:
        """The hits without stems that aren't dense in this text."""
        times: dict[str, int] = {}
        for raw in tokens:
            for kind, letters in hot.get(raw, ()):
                if kind == 3:
                    times[letters] = times.get(letters, 0) + 1
        there = {x for x, n in times.items() if n >= TIMES and n * WITHIN >= len(tokens)}
        return {raw: kept for raw, kinds in hot.items() if (kept := tuple(x for x in kinds if x[0] < 3 or x[1] in there))}

    def hits(self, text: str) -> list[tuple[str, int, float]]:
        """(letters, kind, weight by context) of every hit in the text."""
        tokens, seen = text.lower().split(), self._seen
        if len(seen) > REMEMBERED:
            seen.clear()
        hot = {}
        for raw in set(tokens):
            kinds = seen.get(raw)
            if kinds is None:
                kinds = seen[raw] = self.kinds(raw) or self.stem_of(raw)
            if kinds:
                hot[raw] = kinds
        hot = self.dense_only(hot, tokens) if self.dense and hot else hot
        out = []
        if hot:
            for at, raw in enumerate(tokens):
                if raw in hot:
                    near = tokens[max(0, at - CONTEXT) : at] + tokens[at + 1 : at + 1 + CONTEXT]
                    stripped = [bare(x) for x in near]
                    stripped += SIGNS.split(raw)  # what is glued to the hit is near it too
                    reported = quoted(raw) or any(x in REPORTED for x in stripped)
                    weight = WEIGHTS[0] if reported else WEIGHTS[2] if any(x in AIMED for x in stripped) else WEIGHTS[1]
                    out += [(letters, kind, weight) for kind, letters in hot[raw]]
        return out

    def features(self, text: str | None) -> tuple[float, float, float]:
        mass = [0.0, 0.0, 0.0]
        for _, kind, weight in self.hits(text or ""):
            mass[kind - 1] += weight
        return tuple(map(math.log1p, mass))

    def score(self, text: str | None) -> float:
        z = self.coef[0] + sum(w * x for w, x in zip(self.coef[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 3 == 1


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first is the bias. Weights of hits aren't negative."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    w[1:] = np.maximum(w[1:], 0)
    return w


def longest(stems: dict[str, int]) -> frozenset:
    """Of dense stems that begin with one another the shortest, unless a longer one is dense in nearly as many texts."""
    kept = dict(stems)
    for x in sorted(stems, key=len):
        if longer := [y for y in kept if y != x and y.startswith(x)]:
            if x in kept and max(stems[y] for y in longer) >= 0.95 * stems[x]:
                del kept[x]
            elif x in kept:
                kept = {y: n for y, n in kept.items() if y not in longer}
    return frozenset(kept)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample: the `sample` labelled rows outside the held-out fold whose ids have the smallest hashes.

    Equal texts count once. Without labelled texts of both kinds the lexicon is empty and every score is low.
    """
    text_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL").groupBy("text").agg(F.max("toxic").alias("toxic")))

    @F.pandas_udf("array<string>")
    def parts(text: pd.Series) -> pd.Series:
        """The text's tokens, and their beginnings with a * behind; a + before those that occur plainly, a - before others, then a # for those that are dense, a . for others."""

        def named(tokens: dict[str, int]) -> dict[str, int]:
            found: dict[str, int] = {}
            for raw, n in tokens.items():
                if MIN_LETTERS <= len(t := EDGE.sub("", raw)) and t.isalpha():
                    for x in (t, *(f"{t[:k]}*" for k in STEM if k <= len(t))):
                        found[x] = found.get(x, 0) + n
            return found

        def of(x: str) -> list[str]:
            tokens = x.lower().split()
            plain, own = plainly(tokens), Counter(tokens)
            there = named({t: own[t] for t in plain})
            return sorted(f"{'+' if t in there else '-'}{'#' if n >= TIMES and n * WITHIN >= len(tokens) else '.'}{t}" for t, n in named(own).items())

        return text.map(of)

    totals = dict(texts.groupBy("toxic").count().collect())
    if not totals.get(1) or not totals.get(0):
        return Model([])
    found = written(texts.select("toxic", F.explode(parts("text")).alias("part")).select("toxic", F.substring("part", 3, 1 << 30).alias("part"), F.col("part").startswith("+").cast("int").alias("plain"), (F.substring("part", 2, 1) == "#").cast("int").alias("dense")))
    each = {"n": F.sum("toxic"), "m": F.count("*"), "plain_n": F.sum(F.col("toxic") * F.col("plain")), "plain_m": F.sum("plain"), "dense_n": F.sum(F.col("toxic") * F.col("dense")), "dense_m": F.sum("dense")}
    counted = written(found.groupBy("part").agg(*(x.alias(name) for name, x in each.items())).where(F.col("n") >= MIN_TEXTS))
    # more texts than a group of near copies has, and more than chance puts behind the best of so many candidates
    chance = math.log(100 * max(1, counted.count())) / math.log(1 + totals[0] / totals[1])
    enough = max(MIN_TEXTS, chance)
    counted = counted.where(F.col("n") >= enough)
    # clean texts that only quote or report a term don't speak against it: its plain occurrences tell, if there are enough
    telling = (F.col("n") >= MIN_PRECISION * F.col("m")) | ((F.col("plain_n") >= enough) & (F.col("plain_n") >= MIN_PRECISION * F.col("plain_m")))
    telling_dense = (F.col("dense_n") >= enough) & (F.col("dense_n") >= DENSE_PRECISION * F.col("dense_m"))
    # endings of toxic texts' tokens, however rare each is
    endings = found.where("toxic = 1 AND part NOT LIKE '%*'").select(F.explode(F.array(*(F.concat(F.substring("part", 1, n), F.lit("*")) for n in STEM))).alias("part"), F.col("part").alias("token")).distinct().groupBy("part").agg(F.count("*").alias("endings"))
    # as many words and stems as pass: each is in several texts of the bounded sample
    begun = counted.where(F.col("part").endswith("*") & (telling | telling_dense)).join(endings, "part").where(F.col("endings") >= ENDINGS).select("part", telling.alias("once"), "dense_n").collect()
    stems = {r["part"][:-1] for r in begun if r["once"]}
    begins = lambda x, least: any(x[:n] in stems for n in STEM if n <= least)
    stems = {x for x in stems if not begins(x, len(x) - 1)}  # the shortest of those that begin with one another
    words = {r["part"] for r in counted.where(telling & ~F.col("part").endswith("*")).select("part").collect()}
    words = {x for x in words if not begins(x, len(x))}
    model = Model(sorted(words), sorted(stems), dense=longest({r["part"][:-1]: r["dense_n"] for r in begun if not r["once"]}))

    # innocent misspellings come from one half of the sample, the regression from the other
    half = F.xxhash64(F.lit("half"), F.col("text")) % 2 == 0

    @F.pandas_udf("array<string>")
    def near(text: pd.Series) -> pd.Series:
        return text.map(lambda x: sorted({letters for letters, kind, _ in model.hits(x) if kind == 2}))

    clean = texts.where("toxic = 0").select(half.alias("half"), F.explode(near("text")).alias("token")).groupBy("token").agg(F.max("half").alias("first"))
    # at most as many tokens as the sample's texts have near a lexicon word
    seen = clean.collect()
    first = Model(model.lexicon, model.stems, frozenset(r["token"] for r in seen if r["first"]), dense=model.dense)

    @F.pandas_udf("a double, b double, c double")
    def features(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([first.features(x) for x in text], columns=["a", "b", "c"])

    rows = texts.where(~half).select("toxic", features("text").alias("f")).select("toxic", "f.*").toPandas()
    coef = logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy(float)) if rows["toxic"].nunique() == 2 else np.array(Model.coef)
    return Model(model.lexicon, model.stems, frozenset(r["token"] for r in seen), tuple(map(float, coef)), model.dense)


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1).

    Null and empty texts get the score of a text without hits. Rows are independent, so repeated ids and rows, null
    ids and an empty table need no rule. Other columns stay; one called score is replaced.
    """

    text_batches(docs.sparkSession)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.score(x) for x in batch], dtype="float64")

    return docs.withColumn("score", F.pandas_udf(scores, "double")(F.col(text_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below THRESHOLD."""
    docs, columns = aside(docs, "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model).where(F.col("score") < THRESHOLD).select(*columns)

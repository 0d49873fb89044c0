"""Toxicity scores by weak supervision.

Voters look at a text and fire or not: lexicons of words and word beginnings that occur far more
often in a bounded sample of toxic rows than in one of other rows, one lexicon per family of
terms that begin alike, and patterns of shouting, insistence and accumulation. A generative
label model then looks at the votes on all texts, without labels: by expectation maximisation it
estimates how often texts are toxic and how often each voter fires on toxic and on other texts;
correlations between voters that toxicity does not explain are estimated from the residuals, and
correlated voters share their weight. All it needs is how many texts have which votes: with
``LEXICONS`` lexicons and four patterns there are 2^16 kinds of votes at most, whatever the size of
the table. Its posterior labels train the linear classifier that scores every text, over the
presence of words and word beginnings.

Words are cut at marks inside them. One of over 40 characters, as in scripts without spaces, has
all its runs of four to six characters as beginnings.

Bounded by parameters are the labelled rows that terms are mined from and the rows that the
linear classifier is fitted to, chosen by a hash, so the same for any order and files of a table;
the label model counts every row, and every row is scored. Nulls: a null text is empty and scored
as such; a null id belongs to no fold and is never learnt from. Without toxic labels every score
is zero. Repeated rows are each scored; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns_of, durable, id_of, id_or_null, one_in, some_ids, text_of

_MARKS = re.compile(r"[.,;:!?\"'()\[\]{}<>«»„“”‘’…*_~\-–—¡¿/\\|+=&#@]+")
_LONG = 40
_BEGINNINGS = (4, 5, 6)
_KEPT_WORDS = 300_000
PATTERNS = 4
LEXICONS = 12


def terms_of(word: str) -> Iterator[str]:
    """The parts of a word between marks, each closed by a blank, and their beginnings."""
    for part in _MARKS.split(word):
        if len(part) > _LONG:
            for size in _BEGINNINGS:
                yield from (part[at : at + size] for at in range(len(part) - size + 1))
        elif part:
            yield part + " "
            yield from (part[:size] for size in _BEGINNINGS if len(part) >= size)


def text_terms(text: str) -> set[str]:
    return {term for word in set(text.lower().split()) for term in terms_of(word)}


@cache
def _capitals() -> np.ndarray:
    return np.array([chr(code).isupper() for code in range(0x110000)])


def patterns(text: str, hits: int) -> list[bool]:
    """Shouting, insistence, a third of the text in capitals, and several terms of the lexicons."""
    n = max(1, len(text))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return [
        text.count("!") * 100 > n,
        "!!" in text or "??" in text,
        int(_capitals()[codes].sum()) * 3 > n,
        hits >= 3,
    ]


@dataclass
class Scorer:
    """Voters and weights, by term. What a word stands for is remembered, within bounds."""

    lexicon: dict[str, int]  # term: voter
    n_lexicons: int
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def terms(self, text: str) -> set[str]:
        """The lexicons' terms in a text."""
        found: set[str] = set()
        for word in set(text.lower().split()):
            terms = self.known.get(word)
            if terms is None:
                terms = tuple(term for term in terms_of(word) if term in self.lexicon)
                if len(self.known) < _KEPT_WORDS:
                    self.known[word] = terms
            if terms:
                found.update(terms)
        return found

    def votes(self, text: str) -> tuple[list[bool], set[str]]:
        terms = self.terms(text)
        fired = {self.lexicon[term] for term in terms}
        lexicons = [voter in fired for voter in range(self.n_lexicons)]
        return lexicons + patterns(text, len(terms)), terms

    def score(self, text: str) -> float:
        logit = self.bias + sum(self.weights.get(term, 0.0) for term in self.terms(text))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}


def one_of_alike(rows: DataFrame) -> DataFrame:
    """Rows (text, toxic) without most near copies: one per smallest hash of three words.

    Copies of one toxic text would make any of its words look toxic.
    """

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            keys = []
            for text in batch["text"]:
                words = text.encode().lower().split()
                triples = zip(words, words[1:], words[2:], strict=False)
                hashes = (xxhash.xxh64_intdigest(b" ".join(each)) for each in triples)
                keys.append(min(hashes, default=len(words)) >> 1)
            yield batch.assign(alike=keys)

    signed = rows.mapInPandas(sign, "text string, toxic int, alike long")
    return signed.dropDuplicates(["alike", "toxic"]).drop("alike")


def mine_terms(
    labelled: DataFrame, *, least_ratio: float = 4.0, doubt: float = 1.5, most: int = 20_000
) -> list[tuple[str, float]]:
    """Terms and their log ratios from rows (text, toxic), the strongest ``most`` of them.

    Both counts of a term are taken ``doubt`` standard errors to its disadvantage.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                counts[int(toxic)].update(text_terms(text))
            terms = list(counts[0].keys() | counts[1].keys())
            yield pd.DataFrame(
                {"term": terms, "others": [counts[0][t] for t in terms], "toxic": [counts[1][t] for t in terms]}
            )

    totals = {row.toxic: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    n_toxic, n_others = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_others:
        return []
    counted = (
        labelled.mapInPandas(count, "term string, others long, toxic long")
        .groupBy("term")
        .agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))
    )
    at_least = F.col("toxic") - doubt * F.sqrt("toxic")
    at_most = F.col("others") + doubt * (1 + F.sqrt("others"))
    ratio = (at_least / n_toxic) / (at_most / n_others)
    strong = counted.where(ratio >= least_ratio)
    rows = strong.select("term", F.log(ratio).alias("weight")).orderBy(F.desc("weight"), "term").limit(most)
    return [(row.term, row.weight) for row in rows.collect()]


def lexicons(terms: list[str], most: int = LEXICONS) -> tuple[dict[str, int], int]:
    """A voter per family of terms with the same first three letters; small families share one."""
    sizes = Counter(term[:3] for term in terms)
    families = {family: i for i, (family, _) in enumerate(sizes.most_common(most - 1))}
    rest = len(families)
    lexicon = {term: families.get(term[:3], rest) for term in terms}
    return lexicon, max(lexicon.values(), default=-1) + 1


@dataclass
class LabelModel:
    """Estimated share of toxic texts, firing rates of voters on (other, toxic) texts, and the
    weight of each after its correlations."""

    prior: float
    rates: np.ndarray
    shares: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fires = np.log(self.rates[1] / self.rates[0])
        silent = np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        logit = np.log(self.prior / (1 - self.prior)) + (votes * fires + (1 - votes) * silent) @ self.shares
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, trusted: np.ndarray, rounds: int = 30) -> LabelModel:
    """From the kinds of votes, as a 0/1 matrix of kinds and voters, and the number of texts of
    each; ``trusted`` voters give the first guess."""
    n = max(1, int(counts.sum()))
    guess = np.where(votes[:, trusted].any(axis=1), 0.9, 0.02)
    model = LabelModel(0.1, np.zeros((2, votes.shape[1])), np.ones(votes.shape[1]))
    for _ in range(rounds):
        sure = np.stack([1 - guess, guess]) * counts
        totals = sure.sum(axis=1, keepdims=True)
        model.rates = np.clip((sure @ votes + 0.5) / (totals + 1), 1e-4, 1 - 1e-4)
        model.prior = float(np.clip(totals[1, 0] / n, 1e-3, 0.5))
        guess = model.posterior(votes)
    # What voters have in common beyond the label: correlations of the residuals, of which
    # those that chance explains are left out.
    residual = votes - (guess[:, None] * model.rates[1] + (1 - guess[:, None]) * model.rates[0])
    weighted = residual * counts[:, None]
    scale = np.sqrt((weighted * residual).sum(axis=0) / n) + 1e-9
    common = np.abs(residual.T @ weighted / n / np.outer(scale, scale)).clip(0, 1)
    common[common < 3 / np.sqrt(n)] = 0
    np.fill_diagonal(common, 1)
    model.shares = 1 / common.sum(axis=1)
    return model


def fit_linear(present: list[list[int]], labels: np.ndarray, size: int, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression on the presence of terms, with soft labels, by gradient steps (Adam)."""
    rows = np.repeat(np.arange(len(present)), [len(each) for each in present])
    columns = np.array([at for each in present for at in each], dtype=np.int64)
    weights = np.zeros(size + 1)
    weights[size] = -2.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, rounds + 1):
        logit = np.bincount(rows, weights=weights[columns], minlength=len(labels)) + weights[size]
        slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(labels)
        gradient = np.append(np.bincount(columns, weights=slope[rows], minlength=size), slope.sum())
        gradient[:size] += 1e-6 * weights[:size]
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        weights -= 0.1 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return weights[:size], float(weights[size])


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_labelled: int = 6_000,
    most_fitted: int = 24_000,
) -> Scorer:
    """A scorer from ``labels`` (id, toxic) of each kind up to a bound, and all texts.

    About ``most_fitted`` texts, and the labelled ones, are what the linear classifier is fitted to.
    """
    given = columns_of(docs, id=id_column, text=text_column)
    texts = given.select(F.col("id").cast("long").alias("id"), text_of("text").alias("text"))
    kinds = [
        some_ids(labels.where(F.col("toxic") == kind).select("id", "toxic").distinct(), most_labelled)
        for kind in (0, 1)
    ]
    chosen = texts.join(F.broadcast(kinds[0].unionByName(kinds[1])), "id")
    labelled = durable(one_of_alike(chosen.select("text", F.col("toxic").cast("int"))))
    terms = [term for term, _ in mine_terms(labelled)]
    if not terms:
        return Scorer({}, 0)
    scorer = Scorer(*lexicons(terms))
    number = {term: at for at, term in enumerate(terms)}
    voters = scorer.n_lexicons + PATTERNS

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [scorer.votes(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "votes": [sum(1 << voter for voter, fired in enumerate(votes) if fired) for votes, _ in found],
                    "terms": [sorted(number[term] for term in present) for _, present in found],
                }
            )

    def voted(rows: DataFrame) -> DataFrame:
        return rows.mapInPandas(vote, "id long, votes int, terms array<int>")

    # Chosen by a hash of the whole row, as ids may be missing or repeated.
    every = durable(voted(texts.select(F.xxhash64("id", "text").alias("id"), "text")))
    kinds_of_votes = every.groupBy("votes").agg(F.count("*").alias("n")).toPandas().sort_values("votes")
    patterns_ = _bits(kinds_of_votes["votes"], voters)
    model = fit_label_model(patterns_, kinds_of_votes["n"].to_numpy(), np.arange(scorer.n_lexicons))

    sample = one_in(every, every.count() // most_fitted, "id").toPandas()
    learnt = voted(labelled.select(F.xxhash64("text").alias("id"), "text")).toPandas()
    seen = pd.concat([sample, learnt]).sort_values(["id", "votes"])
    posterior = model.posterior(_bits(seen["votes"], voters))
    weights, scorer.bias = fit_linear([list(each) for each in seen["terms"]], posterior, len(terms))
    scorer.weights = dict(zip(terms, weights.tolist(), strict=True))
    return scorer


def _bits(votes: pd.Series, voters: int) -> np.ndarray:
    return (votes.to_numpy(np.int64)[:, None] >> np.arange(voters) & 1).astype(float)


def score(docs: DataFrame, scorer: Scorer, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The ids of ``docs`` with a column ``score``."""
    given = columns_of(docs, id=id_column, text=text_column)
    rows = given.select(id_of("id").alias("id"), text_of("text").alias("text"))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [scorer.score(text) for text in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "score": scores})

    return rows.mapInPandas(apply, "id long, score double").withColumn("id", id_or_null("id"))

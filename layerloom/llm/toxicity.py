"""Toxicity by weak supervision.

Lexicons are mined in Spark from the labelled learning rows: words and word beginnings whose toxic
share is far above the usual one. They, a list of known insults, and patterns of writing form the
voters. A generative label model, fitted by expectation maximisation to the counts of all vote
patterns of all documents, estimates how often each voter fires in either class and how far voters
repeat each other within a class; correlated voters share their weight. Its posterior labels train a
linear classifier over the mined terms and all voters, which scores every text. In the posterior of
a document whose label is known the label is one more voter: the others together can outvote it.

What comes to the driver does not grow with the number of rows: terms that at least ``SUPPORT`` of
the toxic learning rows hold, at most 2**``VOTERS`` vote patterns, and a sample of ``SAMPLE``
labelled rows for the classifier.

Defined cases: a null or empty text fires no voter and gets the classifier's base score; without
labels of both classes every score is 0; labels repeated for an id count once, as toxic if one of
them is; repeated rows are scored each; an empty table gives an empty result. Of ``docs`` only id
and text are read, of ``labels`` id and label.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import slices
from layerloom.llm.common import stage

# Common insults, the voter that needs no labels.
INSULTS = (
    "bastard clown coward creep disgusting dumb fool freak garbage idiot imbecile jerk liar loser "
    "lunatic moron parasite pathetic pig rat scum stupid swine trash ugly vermin worthless"
).split()
# Letters of the word beginnings that are mined besides whole words.
STEMS = (4, 5, 6, 7)
# A beginning is mined once for each of these numbers of uses in a text.
TIMES = (1, 2, 3)
# Share of the toxic learning rows that must hold a mined term, at every size of the input. A row with
# d terms supports d of them, so at most (terms of a mean toxic row) / SUPPORT terms can be mined.
SUPPORT = 0.004
# A term is mined if its documents are so much likelier (in nats) under its own toxic share than
# under the usual one, and if that share is high enough.
EVIDENCE = 11.0
MIN_SHARE = 0.4
# Patterns of writing; with the insults and the lexicons of mined terms they are the voters.
WRITING = (
    r"(\p{Lu}{2,}\P{L}+){8}",  # shouting
    r"(\S[!?*#$%&]{2,}\s+){4}",  # signs after words
    r"\p{L}\*+\p{L}",  # masked letters
    r"\pN{7,}",  # numbers that may expose somebody
)
PATTERNS = 1 + len(WRITING)
# Toxic shares that part the lexicons of whole words, beginnings, and beginnings used repeatedly.
LEVELS = (0.95, 0.8, 0.6)
VOTERS = PATTERNS + 3 * (len(LEVELS) + 1)
# Log odds of a known label as a voter: right about 95 times of 100.
LABEL_ODDS = 3.0
# Labelled rows that the linear classifier is fitted to.
SAMPLE = 30_000
THRESHOLD = 0.3


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct lower-case words, and the distinct pairs of text and word with their counts."""
    letters = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\P{L}+", " ")
    lists = pc.split_pattern(letters, " ")
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    text = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    pair, n = np.unique(text * max(1, len(names)) + coded.indices.to_numpy(), return_counts=True)
    text, word = np.divmod(pair, max(1, len(names)))
    real = np.fromiter((bool(n) for n in names), bool, len(names))[word]
    return names, text[real], word[real], n[real]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other documents with each term."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        at = 0
        for part in slices(batch.column("text")):
            mine = toxic[at : at + len(part)]
            at += len(part)
            names, text, word, uses = _words(part)
            for k in (0, *STEMS):
                ids: dict[str, int] = {}
                term = np.full(len(names), -1)
                for i, name in enumerate(names):
                    if len(name) >= max(1, k):
                        term[i] = ids.setdefault(name[:k] if k else name, len(ids))
                found, width = term[word], max(1, len(ids))
                pair, at_pair = np.unique(text[found >= 0] * width + found[found >= 0], return_inverse=True)
                times = np.bincount(at_pair, uses[found >= 0], len(pair))
                for least in TIMES if k else (1,):
                    doc, which = np.divmod(pair[times >= least], width)
                    n = np.bincount(which, minlength=width)
                    held = np.flatnonzero(n)
                    n_toxic = np.bincount(which[mine[doc]], minlength=width)[held]
                    mark = "*" * least if k else ""
                    every = list(ids)
                    terms = pa.array([every[i] + mark for i in held.tolist()], pa.string())
                    yield pa.record_batch([terms, pa.array(n_toxic), pa.array(n[held])], names=["term", "n_toxic", "n"])


def mine(labelled: DataFrame) -> list[tuple[str, float]]:
    """Terms of ``labelled`` (``text``, ``toxic``) that speak for toxicity, the strongest first, with
    the toxic share of their documents. None is cut off: what is mined follows from shares alone once
    there is evidence."""
    totals = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < totals[1] < totals[0]:
        return []
    base = totals[1] / totals[0]
    counts = (
        labelled.select("text", "toxic")
        .mapInArrow(_count, "term string, n_toxic long, n long")
        .groupBy("term")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n").alias("n"))
    )
    share = F.col("n_toxic") / F.col("n")
    rest = F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - base))).otherwise(0.0)
    evidence = F.col("n") * (share * F.ln(share / base) + rest)
    held = F.col("n_toxic") >= SUPPORT * totals[1]
    strong = counts.where(held & (share >= MIN_SHARE) & (share > base)).withColumn("evidence", evidence)
    found = strong.where(F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), "term")
    return [(r["term"], r["share"]) for r in found.select("term", share.alias("share")).collect()]


def _lexicon(term: str, share: float) -> int:
    """Terms of one kind and about one toxic share form a lexicon, so its members are alike."""
    kind = min(2, term.count("*"))
    return kind * (len(LEVELS) + 1) + sum(share < level for level in LEVELS)


class Voters:
    """Votes and terms of texts."""

    def __init__(self, terms: list[tuple[str, float]]):
        self.place = {t: k for k, (t, _) in enumerate(terms)}
        self.stems = {t.rstrip("*") for t, _ in terms if t.endswith("*")}
        self.insults = frozenset(INSULTS)
        self.voter = [PATTERNS + _lexicon(t, share) for t, share in terms]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        names, text, word, uses = _words(texts)
        votes = np.zeros(len(texts), np.int64)
        known, rude = {}, np.zeros(len(names), bool)
        for i, name in enumerate(names):
            if name:
                stems = {name[:k] for k in STEMS if len(name) >= k} & self.stems
                if stems or name in self.place:
                    known[i] = (self.place.get(name), stems)
                rude[i] = name in self.insults
        votes[text[rude[word]]] |= 1
        for k, pattern in enumerate(WRITING):
            fires = pc.match_substring_regex(pc.fill_null(texts, ""), pattern).to_numpy(zero_copy_only=False)
            votes[fires] |= 1 << (k + 1)
        has = np.zeros(len(names), bool)
        has[list(known)] = True
        hit = has[word]
        terms: list[set[int]] = [set() for _ in range(len(texts))]
        begun: list[dict[str, int]] = [{} for _ in range(len(texts))]
        for t, w, n in zip(text[hit].tolist(), word[hit].tolist(), uses[hit].tolist()):
            whole, stems = known[w]
            if whole is not None:
                terms[t].add(whole)
            for s in stems:
                begun[t][s] = begun[t].get(s, 0) + n
        for t, stems in enumerate(begun):
            for s, n in stems.items():
                marked = (self.place.get(s + "*" * k) for k in TIMES if k <= n)
                terms[t].update(p for p in marked if p is not None)
        for t, found in enumerate(terms):
            for f in found:
                votes[t] |= 1 << self.voter[f]
        return votes, [np.array(sorted(s), np.int32) for s in terms]


def vote(docs: DataFrame, voters: Voters, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the ``votes`` as bits, and the ``terms`` of each text. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(0)):
                votes, terms = voters(part)
                kept = [batch.column(k + 1).slice(at, len(part)) for k in range(len(keep))]
                new = [pa.array(votes), pa.array(terms, pa.list_(pa.int32()))]
                yield pa.record_batch([*kept, *new], names=[*keep, "votes", "terms"])
                at += len(part)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    picked = docs.select(F.col("text").alias("_text"), *keep)
    return picked.mapInArrow(run, f"{types}, votes long, terms array<int>")


def _fires(votes: np.ndarray) -> np.ndarray:
    """A column for each voter."""
    return (votes[:, None] >> np.arange(VOTERS)) & 1


class LabelModel:
    """Two classes in which each voter fires with a rate of its own.

    ``fit`` takes the distinct vote patterns with their numbers of documents without a label, with
    label 0 and with label 1. Known labels hold their documents in their class; the others take
    part by their posterior. A voter's weight is 1 over its correlation with all voters within the
    classes, so a group of voters that say the same counts about as one.
    """

    def fit(self, patterns: np.ndarray, unknown: np.ndarray, zero: np.ndarray, one: np.ndarray) -> LabelModel:
        fires = _fires(patterns)
        self.weight = np.ones(VOTERS)
        post = (one + 0.1) / (zero + one + 1.0)
        for _ in range(30):
            mass = [unknown * (1 - post) + zero, unknown * post + one]
            self.prior = mass[1].sum() / (mass[0].sum() + mass[1].sum())
            self.rate = np.array([(m @ fires + 0.5) / (m.sum() + 1.0) for m in mass])
            self.weight = 1.0 / np.mean([self._repeats(fires, m) for m in mass], axis=0)
            post = self.posterior(patterns)
        return self

    @staticmethod
    def _repeats(fires: np.ndarray, mass: np.ndarray) -> np.ndarray:
        total = max(mass.sum(), 1e-9)
        mean = mass @ fires / total
        cov = (fires * mass[:, None]).T @ fires / total - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        correlation = np.clip(cov / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(correlation, 1.0)
        return correlation.sum(axis=1)

    def posterior(self, patterns: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """Chance of class 1 by the votes, with the ``label`` as one more voter if it is given."""
        fires = _fires(patterns)
        yes = np.log(self.rate[1] / self.rate[0]) * self.weight
        no = np.log((1 - self.rate[1]) / (1 - self.rate[0])) * self.weight
        odds = np.log(self.prior / (1 - self.prior)) + fires @ yes + (1 - fires) @ no
        if label is not None:
            odds = odds + np.where(label == 1, LABEL_ODDS, -LABEL_ODDS)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_linear(rows: list[np.ndarray], votes: np.ndarray, target: np.ndarray, n_terms: int) -> np.ndarray:
    """Logistic regression over terms, voters and a constant; gradient steps over all rows."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    owner = np.repeat(np.arange(len(rows)), sizes)
    term = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    fires = np.column_stack([_fires(votes), np.ones(len(rows), np.int64)])
    weights = np.zeros(n_terms + VOTERS + 1)
    pace = np.full(len(weights), 1e-6)
    for _ in range(300):
        z = np.bincount(owner, weights[term], len(rows)) + fires @ weights[n_terms:]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        step = np.append(np.bincount(term, error[owner], n_terms), error @ fires)
        step = step / max(1, len(rows)) + 1e-6 * weights
        pace += step * step
        weights -= 0.3 * step / np.sqrt(pace)
    return weights


def score(voted: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column("terms")
            sizes = np.diff(terms.offsets.to_numpy())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            z = np.bincount(owner, weights[terms.flatten().to_numpy()], len(sizes)) + weights[-1]
            z += _fires(batch.column("votes").to_numpy()) @ weights[-VOTERS - 1 : -1]
            value = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.record_batch(
                [*(batch.column(k) for k in keep), pa.array(value)], names=[*keep, "score"]
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in voted.select(*keep).schema)
    return voted.select(*keep, "votes", "terms").mapInArrow(run, f"{types}, score double")


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column, keep: tuple[str, ...] = ("doc_id",)
) -> tuple[np.ndarray, DataFrame]:
    """Weights of the classifier, and the staged votes of all ``docs`` with their ``keep``."""
    marked = (
        labels.where(learnable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # Labels may be many: a merge join at every size, which adaptive execution can split.
    texts = docs.where(learnable).select("doc_id", "text").join(marked.hint("merge"), "doc_id")
    voters = Voters(mine(texts))
    voted = stage(vote(docs, voters, keep))
    joined = stage(voted.join(marked, "doc_id", "left"))
    known = F.col("toxic")
    patterns = joined.groupBy("votes").agg(
        F.count_if(known.isNull()).alias("unknown"),
        F.count_if(known == 0).alias("zero"),
        F.count_if(known == 1).alias("one"),
    ).toPandas()
    n_terms = len(voters.place)
    if not patterns["one"].sum() or not patterns["zero"].sum():
        return np.append(np.zeros(n_terms + VOTERS), -30.0), voted
    columns = [patterns[c].to_numpy() for c in ("votes", "unknown", "zero", "one")]
    model = LabelModel().fit(columns[0], *(c.astype(float) for c in columns[1:]))
    order = F.xxhash64("doc_id")
    rows = joined.where(known.isNotNull()).orderBy(order, "doc_id").limit(SAMPLE).select("votes", "terms", "toxic").toPandas()
    votes = rows["votes"].to_numpy()
    target = model.posterior(votes, rows["toxic"].to_numpy())
    terms = [np.asarray(t, np.int64) for t in rows["terms"]]
    return fit_linear(terms, votes, target, n_terms), voted


def detect(
    docs: DataFrame, labels: DataFrame, learnable: Column, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` and ``score`` of every row of ``docs``. Labels are learned from where ``learnable``,
    a condition on ``doc_id``, holds."""
    weights, voted = learn(docs, labels, learnable, keep)
    return score(voted, weights, keep)


def held_out(folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(False))

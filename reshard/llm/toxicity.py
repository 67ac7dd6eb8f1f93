"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols by a lexicon machine (insult, threat, target, negation, reported speech, other); a second machine
reads the symbols of a clause and remembers whether a negation or a report is open, so that a match leaves it with its
context. The weight of each context is learned, and so is the insult lexicon: stems whose documents are labelled toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import pieces, stored

# Cue words of the four languages of the corpus.
THREATS = "kill hurt destroy shoot stab töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your youre du dich dein euch tu toi vous ton tú te ti usted vosotros".split()
NEGATIONS = "not no never none nicht kein keine nie ne pas jamais non nunca jamás tampoco".split()
REPORTS = "said says wrote quoted called sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
# How many words a negation stays open.
NEGATION_REACH = 3

# Bounds of the fit. Scores cover all documents; only learning uses a sample of labelled rows.
MAX_LABELLED = 20_000
MAX_TERMS = 100_000
PREFIXES = range(3, 9)
LEAST_SUPPORT = 4
LEAST_SHARE = 0.01
LEAST_PRECISION = 0.97
# A stem of few texts, most of them copies of each other, says more about the text than about toxicity.
LEAST_VARIETY = 0.5
FREE_SHARE = 0.05

WORD = re.compile(r"[^\W\d_]+")
SYMBOL = re.compile(r"[^\W\d_]+|[\"“”„«»]")
CLAUSE = re.compile(r"[.!?;]+")
CONTEXTS = ("insult", "insult_at_target", "insult_negated", "insult_reported", "threat", "threat_at_target", "threat_negated", "threat_reported")
# Weights before any label is seen: quoting and negating weaken a match.
PRIOR = np.array([2.0, 2.5, 0.5, 0.5, 2.0, 2.5, 0.5, 0.5])
PRIOR_BIAS = -3.0


def terms_of(text: str) -> set[str]:
    """Prefixes of the words of a text, and whole words (closed by $)."""
    out = set()
    for word in set(WORD.findall(text.lower())):
        out.update(word[:k] for k in PREFIXES if len(word) >= k)
        out.add(word + "$")
    return out


def signature(text: str) -> int:
    """Smallest hash of three neighbouring words: near copies mostly share it, so a group of them counts a few times."""
    words = WORD.findall(text.lower())
    return min((xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) >> 1 for i in range(max(1, len(words) - 2))), default=0)


@dataclass(frozen=True)
class Grammar:
    """The lexicon and the weights of the contexts."""

    stems: frozenset[str]
    weights: tuple[float, ...] = tuple(PRIOR)
    bias: float = PRIOR_BIAS

    def symbol(self, word: str) -> str:
        if not word.isalpha():
            return "Q"
        if any(word[:k] in self.stems for k in PREFIXES) or word + "$" in self.stems:
            return "I"
        for symbol, words in (("T", THREATS), ("U", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            if word in words:
                return symbol
        return "O"

    def matched(self, text: str) -> list[int]:
        """Matches per context, from all clauses of a text."""
        counts, known = Counter(), {}
        for line in text.lower().split("\n"):
            quoted = False  # a quotation goes on over clauses, but ends with its line
            for clause in CLAUSE.split(line):
                symbols = [known.get(w) or known.setdefault(w, self.symbol(w)) for w in SYMBOL.findall(clause)]
                if "I" in symbols or "T" in symbols:
                    counts.update(clause_matches(symbols, quoted))
                quoted ^= symbols.count("Q") % 2 == 1
        return [counts[c] for c in CONTEXTS]

    def score(self, counts: list[int]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + float(np.dot(self.weights, np.log1p(counts)))))))


def clause_matches(symbols: list[str], quoted: bool = False) -> list[str]:
    """Run the context machine over one clause; a state is (told, in quotes, words for which a negation stays open)."""
    target, told, negated, out = "U" in symbols, False, 0, []
    for symbol in symbols:
        if symbol == "R":
            told = True
        elif symbol == "Q":
            quoted = not quoted
        elif symbol == "N":
            negated = NEGATION_REACH + 1
        elif symbol in "IT":
            kind = "insult" if symbol == "I" else "threat"
            end = "_reported" if told or quoted else "_negated" if negated else "_at_target" if target else ""
            out.append(kind + end)
        negated = max(0, negated - 1)
    return out


def held_out(id_col: str) -> Column:
    """Rows kept away from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """Grammar from labelled rows outside the held-out fold, at most MAX_LABELLED of them chosen by a hash of the id.

    A stem enters the lexicon when enough different documents with it are toxic and hardly any other document has it;
    of stems that begin alike the shortest stays. Without toxic rows the lexicon is empty and the prior weights hold.
    Rows labelled twice count as toxic if one label says so; NULL ids, labels and texts are left out.
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col))
    chosen = chosen.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = stored(rows.join(F.broadcast(chosen), "_id").select("text", F.col("_toxic").cast("int").alias("toxic")))

    def of_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            seen = Counter()
            for text in piece.column("text").to_pylist():
                sign = signature(text)
                seen.update((t, sign) for t in terms_of(text))
            columns = [pa.array([t for t, _ in seen], pa.string()), pa.array([s for _, s in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["term", "sign", "n"])

    toxic = rows.where("toxic = 1").select("text").mapInArrow(of_toxic, "term string, sign bigint, n bigint")
    terms = toxic.groupBy("term").agg(F.count_distinct("sign").alias("toxic"), F.sum("n").alias("texts"))
    positives = rows.where("toxic = 1").count()
    varied = (F.col("toxic") >= LEAST_VARIETY * F.col("texts")) | (F.col("toxic") >= FREE_SHARE * positives)
    terms = terms.where(varied & (F.col("toxic") >= max(LEAST_SUPPORT, LEAST_SHARE * positives)))
    terms = terms.orderBy(F.desc("toxic"), "term").limit(MAX_TERMS).collect()
    toxic_of = {r["term"]: r["toxic"] for r in terms}

    def of_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counts = Counter()
            for text in piece.column("text").to_pylist():
                counts.update(t for t in terms_of(text) if t in toxic_of)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    clean = rows.where("toxic = 0").select("text").mapInArrow(of_clean, "term string, n bigint")
    clean_of = {r["term"]: r["n"] for r in clean.groupBy("term").agg(F.sum("n").alias("n")).collect()} if terms else {}
    sure = {t for t, n in toxic_of.items() if n >= LEAST_PRECISION * (n + clean_of.get(t, 0))}
    grammar = Grammar(frozenset(t for t in sure if not any(t[:k] in sure for k in PREFIXES if k < len(t))))
    return weighted(grammar, rows)


def weighted(grammar: Grammar, rows: DataFrame) -> Grammar:
    """The same lexicon with context weights fitted to labelled rows: logistic regression drawn towards the prior."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counts = [grammar.matched(t) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.list_(pa.int64())), piece.column("toxic")], ["counts", "toxic"])

    found = rows.mapInArrow(contexts, "counts array<bigint>, toxic int").groupBy("counts", "toxic").count().collect()
    if not found:
        return grammar
    x = np.log1p(np.array([r["counts"] for r in found], float))
    y, n = np.array([r["toxic"] for r in found], float), np.array([r["count"] for r in found], float)
    x1 = np.hstack([x, np.ones((len(x), 1))])
    prior = np.append(PRIOR, PRIOR_BIAS)
    w, hold = prior.copy(), np.append(np.full(len(PRIOR), 1.0), 0.1)
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        slope = x1.T @ (n * (p - y)) + hold * (w - prior)
        bend = (x1 * (n * p * (1 - p))[:, None]).T @ x1 + np.diag(hold)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Grammar(grammar.stems, tuple(float(v) for v in w[:-1]), float(w[-1]))


def toxicity_scores(docs: DataFrame, grammar: Grammar, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns with the probability that they are toxic; a column of that name is replaced.

    Whole texts are read. NULL and empty texts have no match and get the score of the bias. Rows do not influence each
    other, so order, repetition and partitions do not matter.
    """
    carried = [c for c in docs.columns if c != name]
    others = F.struct(*[F.col(f"`{c}`") for c in carried])
    rows = docs.select(others.alias("row"), F.col(text_col).alias("text"))
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        empty = grammar.score([0] * len(CONTEXTS))
        for piece in pieces(batches):
            texts = pc.fill_null(piece.column("text"), "")
            split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
            words = split.flatten().dictionary_encode()
            hits = np.array([is_match(grammar, w, known) for w in words.dictionary.to_pylist()], bool)
            hit = np.concatenate(([0], np.cumsum(hits[words.indices.to_numpy(zero_copy_only=False)]))) if len(words) else np.zeros(1, int)
            ends = split.offsets.to_numpy() - split.offsets[0].as_py()
            scores = np.full(piece.num_rows, empty)
            for i in np.flatnonzero(hit[ends[1:]] > hit[ends[:-1]]):
                scores[i] = grammar.score(grammar.matched(texts[int(i)].as_py()))
            if len(known) > 1_000_000:
                known.clear()
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(scores)], ["row", "score"])

    schema = rows.select("row").schema.add("score", "double")
    return rows.mapInArrow(score, schema).select("row.*", F.col("score").alias(name))


def is_match(grammar: Grammar, token: str, known: dict[str, bool]) -> bool:
    """Whether a white-space separated token holds an insult or a threat."""
    if token not in known:
        known[token] = any(grammar.symbol(w) in "IT" for w in WORD.findall(token))
    return known[token]

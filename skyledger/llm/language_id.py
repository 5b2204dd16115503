"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

A language gives each piece a probability. A word's probability is the sum over all its segmentations into pieces, found by
a forward algorithm in logarithms; a text's is the product over its words (runs of letters, lower-cased, marked in front).
Probabilities are learned by expectation maximisation with the matching backward pass, from word counts of a bounded sample:
``SAMPLE_PER_LANGUAGE`` labelled documents of each language, chosen by the hash of their id. All documents are scored over their whole texts.

Null texts and those without a letter give ``und`` and score 0. Without labelled documents every text gives ``und``. Ties go to the
language that sorts first. Characters outside the vocabulary cost the same in every language. Repeated rows are scored alike.
Very long texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .piece_trie import VOCABULARY, PieceTrie, build_trie, char_bytes, marked, matches
from .scratch import Scratch, add_columns, share

SAMPLE_PER_LANGUAGE = 400
ROUNDS = 3
SMOOTHING = 0.05
OTHER_CHARACTER = -16.0  # log probability, in every language
DEEPEST = 600.0  # logarithm of the smallest probability that is summed as it is
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST_WORD = 200  # characters; a longer run of letters is scored as consecutive words of this length
CACHE = 200_000
SLAB = 1 << 19


@dataclass
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray  # piece x language


def words_of(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    if found and max(map(len, found)) > LONGEST_WORD:
        found = [w[i : i + LONGEST_WORD] for w in found for i in range(0, len(w), LONGEST_WORD)]
    return found


def batches_of(words: list[str]) -> Iterator[list[str]]:
    words = sorted(words, key=len)
    at = 0
    while at < len(words):
        width = 3 * len(words[min(at + 10_000, len(words)) - 1]) + 4
        yield words[at : at + max(1, min(10_000, SLAB // width))]
        at += max(1, min(10_000, SLAB // width))


def _edges(trie: PieceTrie, words: list[str]):
    """Start by start: (start, rows, ends, pieces) of all pieces in the words, piece -1 for a lone character without one."""
    m, lengths = marked(words)
    reached = np.zeros(m.shape, bool)
    reached[:, 0] = True
    edges = []
    for s in range(m.shape[1] - 1):
        size = char_bytes(m[:, s])
        rows = np.flatnonzero((s < lengths) & reached[:, s] & (size > 0))
        if not len(rows):
            continue
        single = np.zeros(len(words), bool)
        for r, end, ids in matches(trie, m, lengths, s, rows):
            single[r[size[r] == end - s]] = True
            reached[r, end] = True
            edges.append((s, r, np.full(len(r), end), ids))
        r = rows[~single[rows]]
        if len(r):
            end = np.minimum(s + size[r], lengths[r])
            reached[r, end] = True
            edges.append((s, r, end, np.full(len(r), -1, np.int32)))
    return m.shape, lengths, edges


def forward(trie: PieceTrie, log_p: np.ndarray, words: list[str]) -> tuple[np.ndarray, tuple]:
    """Log of the summed probability of all segmentations (word x language), and what a backward pass needs.

    Short words are summed as probabilities, long ones, whose probabilities would underflow, as their logarithms.
    """
    shape, lengths, edges = _edges(trie, words)
    table = np.vstack([log_p, np.full((1, log_p.shape[1]), OTHER_CHARACTER)])  # row -1
    usable = table[np.isfinite(table)]
    plain = shape[1] * -usable.min(initial=OTHER_CHARACTER) < DEEPEST
    if plain:
        table = np.exp(table)
        alpha = np.zeros((*shape, log_p.shape[1]))
        alpha[:, 0] = 1
        for s, r, end, ids in edges:
            alpha[r, end] += alpha[r, s] * table[ids]
    else:
        alpha = np.full((*shape, log_p.shape[1]), -np.inf)
        alpha[:, 0] = 0
        for s, r, end, ids in edges:
            alpha[r, end] = np.logaddexp(alpha[r, end], alpha[r, s] + table[ids])
    total = alpha[np.arange(len(words)), lengths]
    with np.errstate(divide="ignore"):
        return np.log(total) if plain else total, (alpha, lengths, edges, table, plain)


def expected_counts(trie: PieceTrie, log_p: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (piece x language) for word counts (word x language)."""
    _, (alpha, lengths, edges, table, plain) = forward(trie, log_p, words)
    last = np.arange(len(words)), lengths
    used, at = [], []
    if plain:
        beta = np.zeros(alpha.shape)
        beta[last] = counts / np.maximum(alpha[last], np.finfo(float).tiny)
        for s, r, end, ids in reversed(edges):
            step = table[ids] * beta[r, end]
            used.append(alpha[r, s] * step)
            at.append(ids)
            beta[r, s] += step
    else:
        beta = np.full(alpha.shape, -np.inf)
        beta[last] = 0
        total = alpha[last]
        for s, r, end, ids in reversed(edges):
            step = table[ids] + beta[r, end]
            used.append(np.exp(np.minimum(alpha[r, s] + step - total[r], 0)) * counts[r])
            at.append(ids)
            beta[r, s] = np.logaddexp(beta[r, s], step)
    flat, ids = np.concatenate(used), np.concatenate(at) + 1  # the lone character without a piece first
    return np.stack([np.bincount(ids, flat[:, c], len(table))[1:] for c in range(table.shape[1])], axis=1)


def learned(counted: DataFrame, trie: PieceTrie, classes: int) -> np.ndarray:
    """Log probability of each piece in each class by expectation maximisation, from a table (word, class, n) of counts.

    Executors sum the expected uses; only a sum for each piece and class comes to the driver. What text never yields has minus infinity.
    Sums differ in their last digits with the order of tasks; they are rounded, so that ties stay ties.
    """
    spark = counted.sparkSession
    shared = share(spark, trie)
    usable = np.zeros(len(trie.pieces), bool)
    usable[trie.piece[trie.piece >= 0]] = True
    log_p = np.where(usable[:, None], -np.log(usable.sum()), -np.inf) * np.ones((1, classes))
    for _ in range(ROUNDS):
        now = share(spark, log_p)

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            trie, log_p = shared(), now()
            used = np.zeros(log_p.shape)
            for batch in batches:
                at: dict[str, int] = {}
                rows = [at.setdefault(w, len(at)) for w in batch.column(0).to_pylist()]
                counts = np.zeros((len(at), log_p.shape[1]))
                np.add.at(counts, (rows, np.asarray(batch.column(1))), np.asarray(batch.column(2)))
                for words in batches_of(list(at)):
                    used += expected_counts(trie, log_p, words, counts[[at[w] for w in words]])
            piece, of = np.nonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(of.astype(np.int32)), pa.array(used[piece, of])], names=["piece", "class", "used"])

        used = np.where(usable[:, None], SMOOTHING, 0.0) * np.ones((1, classes))
        for r in counted.mapInArrow(expect, "piece int, class int, used double").groupBy("piece", "class").agg(F.sum("used").alias("used")).collect():
            used[r[0], r[1]] += r[2]
        with np.errstate(divide="ignore"):
            log_p = np.round(np.log(used / used.sum(axis=0)), 6)
    return log_p


def _sampled(labelled: DataFrame, sizes: DataFrame) -> DataFrame:
    """At most about SAMPLE_PER_LANGUAGE documents of each language by the hash of their id. ``sizes`` has a row for each language of the model."""
    share_of = sizes.select(F.col("lang").alias("s_lang"), F.least(F.lit(1.0), SAMPLE_PER_LANGUAGE / F.col("n")).alias("share"))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return labelled.join(F.broadcast(share_of), F.col("lang") == F.col("s_lang")).where(lot < F.col("share"))


def train(labelled: DataFrame, trie: PieceTrie) -> LanguageModel | None:
    """Fit from (doc_id, text, lang); None where nothing is labelled. There are as many languages as a model can hold, so they are collected."""
    scratch = Scratch(labelled.sparkSession)
    sizes = labelled.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = labelled.sparkSession.createDataFrame(sizes.collect(), sizes.schema)
    languages = sorted(r.lang for r in sizes.collect())
    if not languages:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def rows() -> pa.RecordBatch:
            flat = [(w, languages.index(lang), n) for lang, c in seen.items() for w, n in c.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in flat], kind) for j, kind in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["word", "class", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text or ""))
                if sum(map(len, seen.values())) > CACHE:
                    yield rows()
                    seen.clear()
        yield rows()

    counted = _sampled(labelled, sizes).select("lang", "text").mapInArrow(count, "word string, class int, n long").groupBy("word", "class").agg(F.sum("n").alias("n"))
    counted = scratch.save(counted)
    model = LanguageModel(languages, learned(counted, trie, len(languages)))
    scratch.drop(counted)
    return model


def identify(docs: DataFrame, labelled: DataFrame, vocabulary: str = VOCABULARY, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred and score (the posterior of the prediction under equal priors).

    A column of the table that has a result's name is kept; the result then gets underscores in front of its own.
    """
    trie = build_trie(vocabulary)
    shared = share(docs.sparkSession, (trie, train(labelled.select("doc_id", "text", "lang"), trie)))

    def start():
        trie, model = shared()
        row_of: dict[str, int] = {}
        table = np.zeros((1024, len(model.languages) if model else 1))

        def work(column: pa.Array) -> list[pa.Array]:
            nonlocal table
            texts = [words_of(t or "") if model else [] for t in column.to_pylist()]
            new = set().union(*texts) - row_of.keys()
            if len(row_of) + len(new) > CACHE:
                row_of.clear()
                new = set().union(*texts)
            while len(row_of) + len(new) > len(table):
                table = np.vstack([table, np.zeros_like(table)])
            for words in batches_of(list(new)):
                first = len(row_of)
                table[first : first + len(words)] = forward(trie, model.log_p, words)[0]
                row_of.update(zip(words, range(first, first + len(words)), strict=True))
            pred, score = [], []
            for words in texts:
                if not words:
                    pred.append("und")
                    score.append(0.0)
                    continue
                logs = table[np.fromiter(map(row_of.__getitem__, words), np.int64, len(words))].sum(axis=0)
                best = int(logs.argmax())
                pred.append(model.languages[best])
                score.append(float(1 / np.exp(logs - logs[best]).sum()))
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

        return work

    return add_columns(docs, [F.col("text")], docs.columns if keep is None else keep, {"lang_pred": StringType(), "score": DoubleType()}, start)


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves this remainder; a null id doesn't."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))

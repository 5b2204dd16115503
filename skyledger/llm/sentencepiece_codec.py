"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie, with byte fallback.

Spaces become the marker U+2581 and one marker is put before the text. No piece has a marker after another character,
so the best segmentation of a text is that of its runs of markers with the word after them, each solved once and remembered.
The vocabulary's file has merge ranks in place of scores, so pieces get log probabilities by expectation maximisation over the counted
runs of all documents, from equal ones (``language_id.learned`` with one class).
A character without a piece costs the least score less 10 and is spelt in byte pieces. Decoding joins pieces and bytes,
turns markers into spaces and drops the first space; it restores every text that has no marker of its own.

Null texts give null ids and decode to null; empty texts give no ids; repeated rows are encoded alike; very long texts are read whole; an empty
table gives no rows. Of equal segmentations the one found from the earliest start wins. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import replace
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType

from .language_id import learned
from .piece_trie import SPACE, VOCABULARY, PieceTrie, build_trie, char_bytes, marked, matches
from .scratch import Scratch, add_columns, share

CACHE = 500_000  # remembered runs of each worker; it starts anew beyond
LONG_RUN = 256  # bytes; longer runs are solved one at a time
SLAB = 1 << 20
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def runs_of(text: str) -> list[str]:
    """Runs of markers, at least one, with the word after them; without their first marker."""
    if "  " in text or SPACE in text or text[:1] == " " or text[-1:] == " ":
        return [r[1:] for r in RUNS.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ") if text else []


def learned_scores(docs: DataFrame, text_col: str, trie: PieceTrie) -> np.ndarray:
    """Log probability of each piece over the runs of all documents; what text never yields has the least one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["run", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(runs_of(text or ""))
                if len(seen) > CACHE:
                    yield rows()
                    seen.clear()
        yield rows()

    scratch = Scratch(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "run string, n long").groupBy("run").agg(F.sum("n").alias("n"))
    counted = scratch.save(counted.select("run", F.lit(0).alias("class"), "n"))
    log_p = learned(counted, trie, 1)[:, 0]
    scratch.drop(counted)
    return np.where(np.isfinite(log_p), log_p, log_p[np.isfinite(log_p)].min())


def viterbi(trie: PieceTrie, m: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best segmentation of each run of bytes, one after the other, and the bounds of each; of equal ones, the one found from the earliest start."""
    n, width = m.shape
    best = np.full((n, width), -np.inf)
    best[:, 0] = 0
    back, via = np.zeros((n, width), np.int32), np.full((n, width), -1, np.int32)
    missing = trie.scores.min() - 10
    for s in range(width - 1):
        size = char_bytes(m[:, s])
        rows = np.flatnonzero((s < lengths) & np.isfinite(best[:, s]) & (size > 0))
        if not len(rows):
            continue
        single = np.zeros(n, bool)

        def offer(r: np.ndarray, end: np.ndarray | int, score: np.ndarray, ids: np.ndarray | int, s: int = s) -> None:
            better = score > best[r, end]
            r, e = r[better], (end[better] if isinstance(end, np.ndarray) else end)
            best[r, e], back[r, e] = score[better], s
            via[r, e] = ids[better] if isinstance(ids, np.ndarray) else ids

        for r, end, ids in matches(trie, m, lengths, s, rows):
            single[r[size[r] == end - s]] = True
            offer(r, end, best[r, s] + trie.scores[ids], ids)
        r = rows[~single[rows]]
        if len(r):
            offer(r, s + size[r], best[r, s] + missing, -1)
    # From the ends back, for all runs at once; a character without a piece gives its bytes' pieces, or the unknown one.
    spelt = (trie.byte_ids >= 0).all()
    steps, row, end = [], np.arange(n), lengths.astype(np.int64)
    while len(row):
        start, ids = back[row, end].astype(np.int64), via[row, end]
        known = ids >= 0
        steps.append((row[known], ids[known]))
        lost = np.flatnonzero(~known)
        if not spelt:
            steps.append((row[lost], np.full(len(lost), trie.unknown, np.int32)))
        else:
            for back_by in range(1, 5):
                here = lost[end[lost] - start[lost] >= back_by]
                steps.append((row[here], trie.byte_ids[m[row[here], end[here] - back_by]].astype(np.int32)))
        row, end = row[start > 0], start[start > 0]
    rows, ids = np.concatenate([x[0] for x in steps])[::-1], np.concatenate([x[1] for x in steps])[::-1]
    order = np.argsort(rows, kind="stable")
    return ids[order], np.searchsorted(rows[order], np.arange(n + 1))


class Encoder:
    """Ids of texts. Those of each run are solved once and remembered as bytes of 32-bit numbers."""

    def __init__(self, trie: PieceTrie):
        self.trie, self.known = trie, {}

    def learn(self, runs: set[str]) -> None:
        """Solves new runs; if there is no room for them beside the known ones, these are forgotten and all are solved."""
        new = runs - self.known.keys()
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = runs
        new = sorted(new, key=len)
        at = 0
        while at < len(new):
            width = 4 * len(new[min(at + 20_000, len(new)) - 1]) + 4
            count = 1 if 4 * len(new[at]) > LONG_RUN else max(1, min(20_000, SLAB // width))
            part = new[at : at + count]
            ids, cuts = viterbi(self.trie, *marked(part))
            flat, at_byte = ids.tobytes(), (4 * cuts).tolist()
            self.known.update(zip(part, (flat[a:z] for a, z in pairwise(at_byte)), strict=True))
            at += count

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        runs = [None if t is None else runs_of(t) for t in texts]
        self.learn(set().union(*(r for r in runs if r)))
        known = self.known.__getitem__
        return [None if r is None else np.frombuffer(b"".join(map(known, r)), np.int32) for r in runs]


class Decoder:
    def __init__(self, trie: PieceTrie):
        self.raw = [p.replace(SPACE, " ").encode() for p in trie.pieces]
        for b, i in enumerate(trie.byte_ids):
            if i >= 0:
                self.raw[i] = bytes([b])

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, restore: bool = False) -> DataFrame:
    """``docs`` without the text, with ids and n_ids; with ``restore`` also whether decoding the ids gives the text again.

    A column of the table that has one of these names is kept; the result's name is then ``piece_ids`` and so on, with underscores if that exists too.
    """
    ranked = build_trie(vocabulary)
    shared = share(docs.sparkSession, replace(ranked, scores=learned_scores(docs, text_col, ranked)))
    kept = [c for c in docs.columns if c != text_col]

    def start():
        trie = shared()
        encoder, decoder = Encoder(trie), Decoder(trie)

        def work(column: pa.Array) -> list[pa.Array]:
            texts = column.to_pylist()
            ids = encoder.encode(texts)
            flat = [x for x in ids if x is not None]
            offsets = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)), mask=pa.array([x is None for x in ids]))
            out = [lists, pa.array([None if x is None else len(x) for x in ids], pa.int32())]
            if restore:
                out.append(pa.array([None if x is None else decoder.decode(x) == t.replace(SPACE, " ") for x, t in zip(ids, texts, strict=True)], pa.bool_()))
            return out

        return work

    added = {"ids": ArrayType(IntegerType()), "n_ids": IntegerType()} | ({"restored": BooleanType()} if restore else {})
    taken = {c.lower() for c in kept}
    return add_columns(docs, [F.col(f"`{text_col}`")], kept, {(c if c not in taken else f"piece_{c}"): kind for c, kind in added.items()}, start, 2048)


def decode(tokens: DataFrame, ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens`` with the column ``text`` in place of ids; an own column ``text`` is kept, and the result is then ``_text``."""
    shared = share(tokens.sparkSession, build_trie(vocabulary))

    def start():
        decoder = Decoder(shared())
        return lambda column: [pa.array([None if not x.is_valid else decoder.decode(np.asarray(x.values, np.int32)) for x in column], pa.string())]

    return add_columns(tokens, [F.col(f"`{ids_col}`")], [c for c in tokens.columns if c != ids_col], {"text": StringType()}, start)

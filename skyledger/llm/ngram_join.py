"""Exact Jaccard self-join of documents' word n-gram sets by vertical partitioning.

1. Equal sets collapse to one, known by a number.
2. The global n-gram order begins with the order of 64-bit hashes. A set's lower part is as long as it takes for two linked sets to share
   ``common`` n-grams there. Lower parts are ordered anew, by the number of sets that hold an n-gram there (counted over all documents), rarest first.
   Of that order each set posts the prefix that two linked sets must share a member of; n-grams of one set alone come first and are posted by none.
   A set with too few n-grams in common with any other posts nothing. All of this is exact: it follows from sizes alone.
3. The order of hashes is cut into ``FRAGMENTS`` fragments. Each candidate pair's overlap is counted fragment by fragment, and the partial
   counts are summed per pair.

A group of near copies isn't expanded into all its pairs. In each of some rounds, every block of sets with a posted n-gram
is compared with one leader, and only across components found so far; the first leader is the set with the least share of n-grams of its own,
which is likely the one that the others were made from. When a round links few sets, a last one compares all that are still in different components, so no
link between components is missed. Pairs are dropped before counting only by sound bounds: sizes, and the parities of 512 hash cells,
whose differing number is at most that of differing n-grams.

Texts without words, empty and null texts have an empty set, are linked with nothing and are their own component. Each row counts as one document,
repeated rows and repeated ids too: rows of one id with different texts may lie in different components. A row without an id takes part like others;
a component's id is its least one, null if it has none. Very long texts are read whole. Ties: none arise in results. An empty table gives no rows.
Other columns are not read, and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch, give_back, share
from .wordhash import Words, mix, shingle_hashes

STAR_SHARE = 4  # another round with leaders follows one that links so large a part of the sets: a fourth
FRAGMENTS = 4
CELLS = 8  # longs of 64 parity cells each
BLOOM_BITS = 1 << 27  # 16 MB at most are broadcast
BLOOM_TASKS = 64
SLACK = (1, 2)  # how much longer than a plain prefix the lower part of a set is


class Threshold:
    """Jaccard similarity of at least num / den, in whole numbers."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("threshold must be in (0, 1]")
        self.num, self.den = num, den

    def overlap(self, n: int) -> int:
        """Least overlap of a set of n with a linked one, and the least size of that."""
        return -(-n * self.num // self.den)

    def extra(self, n: int) -> int:
        """N-grams that the lower part is to share with that of a linked set which isn't smaller. It never falls as n grows."""
        need = self.overlap(n)
        return max(1, min(need, -(-(n - need + 1) * SLACK[0] // SLACK[1])))

    def lower(self, n: int) -> int:
        return n - self.overlap(n) + self.extra(n)

    def common(self, n: int) -> int:
        """N-grams that the lower part shares with that of any linked set."""
        return self.extra(self.overlap(n))

    def only_equal(self, n: int) -> bool:
        """Whether a set of n is linked only with equal ones: no other size or set is near enough."""
        largest = n + n * self.den // self.num
        return largest * (self.den - self.num) // (self.den + self.num) == 0


def _sets(words: Words, texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of each text."""
    for first, bounds, hashes in words.chunks(texts):
        for i in range(len(bounds) - 1):
            yield first + i, np.unique(shingle_hashes(hashes[bounds[i] : bounds[i + 1]], k))


def _signature(tokens: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return mix(tokens).sum(dtype=np.uint64), np.bitwise_xor.reduce(tokens * np.uint64(0x9E3779B97F4A7C15) ^ (tokens >> np.uint64(29)))


def _parities(tokens: np.ndarray) -> np.ndarray:
    """Whether each hash cell holds an odd number of n-grams, as 64-bit numbers."""
    cells = 64 * CELLS
    return np.packbits((np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1).astype(np.uint8)).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)))


def _summaries(num: int, den: int, k: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, limit = Words(), Threshold(num, den)
        for batch in (whole.slice(low, 1024) for whole in batches for low in range(0, whole.num_rows, 1024)):
            rows = batch.num_rows
            sizes, common, signatures = np.zeros(rows, np.int64), np.zeros(rows, np.int32), np.zeros((rows, 2), np.uint64)
            parity = np.zeros((rows, CELLS), np.int64)
            lower = [np.zeros(0, np.uint64)] * rows
            for row, tokens in _sets(words, batch.column(1), k):
                n = sizes[row] = len(tokens)
                if not n:
                    continue
                signatures[row], parity[row] = _signature(tokens), _parities(tokens)
                if not limit.only_equal(int(n)):
                    lower[row], common[row] = tokens[: limit.lower(int(n))], limit.common(int(n))
            columns = [batch.column(0), *batch.columns[2:], pa.array(sizes), *(pa.array(signatures[:, j].copy().view(np.int64)) for j in (0, 1))]
            columns += [pa.array(common), _lists(lower), *(pa.array(parity[:, j].copy()) for j in range(CELLS))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *kept, "n", "sig1", "sig2", "common", "lower", *(f"p{j}" for j in range(CELLS))])
        give_back()

    return run


def _bits(sig1: np.ndarray, sig2: np.ndarray, size: int) -> np.ndarray:
    """Places of a set in a Bloom filter of so many bits, a power of two."""
    return np.stack([sig1 & (size - 1), sig2 & (size - 1)])


def _bloom(chosen: DataFrame) -> np.ndarray:
    """A Bloom filter of sets by their signatures, of at most ``BLOOM_BITS``: beyond that it lets more others pass, and loses none."""
    size = 64
    while size < BLOOM_BITS and size < 16 * chosen.count():
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[_bits(np.asarray(batch.column(0)), np.asarray(batch.column(1)), size)] = True
        longs = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(longs)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(longs[at])], names=["at", "bits"])

    found = chosen.select("sig1", "sig2").coalesce(BLOOM_TASKS).mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    longs = np.zeros(size // 64, np.int64)
    longs[np.asarray(found["at"])] = np.asarray(found["bits"])
    return np.unpackbits(longs.view(np.uint8)).view(bool)


def _fragments(k: int, bloom):
    """(sig1, sig2, n, n-grams of each fragment) of each text whose set may be in the Bloom filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = Words(), bloom()
        edges = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                keys, parts = [], []
                for _, tokens in _sets(words, batch.column(0).slice(low, 512), k):
                    if len(tokens) and known[_bits(*(x.view(np.int64) for x in _signature(tokens)), len(known))].all():
                        at = np.concatenate([[0], np.searchsorted(tokens, edges), [len(tokens)]])
                        keys.append((*(int(x.view(np.int64)) for x in _signature(tokens)), len(tokens)))
                        parts.extend(tokens[at[f] : at[f + 1]] for f in range(FRAGMENTS))
                outer = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * FRAGMENTS)
                columns = [pa.array([x[j] for x in keys], pa.int64()) for j in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(outer, _lists(parts))], names=["sig1", "sig2", "n", "parts"])
        give_back()

    return run


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, n_shingles, component_id, part, kept columns) per row: components of all pairs with Jaccard similarity >= num / den.

    ``part`` is a number of the component, null for rows with an empty set. The columns ``keep`` of ``docs`` are carried along.
    """
    scratch, keep = Scratch(docs.sparkSession), keep or []
    carried = [f"k{i}" for i in range(len(keep))]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(k) for c, k in zip(keep, carried, strict=True)))
    parity, signature = [f"p{j}" for j in range(CELLS)], ["sig1", "sig2", "n"]
    fields = ["id long", *(f"{k} {docs.schema[c].dataType.simpleString()}" for c, k in zip(keep, carried, strict=True)), "n long, sig1 long, sig2 long, common int, lower array<long>", *(f"{p} long" for p in parity)]
    summary = scratch.save(texts.mapInArrow(_summaries(num, den, words, carried), ", ".join(fields)))
    rows = scratch.save(summary.select("id", *signature, *carried))
    equal = summary.where("n > 0").groupBy(*signature).agg(F.min("id").alias("id"), *(F.any_value(c).alias(c) for c in ("common", "lower", *parity)))
    sets = scratch.save(equal.withColumn("s", F.monotonically_increasing_id()))
    scratch.drop(summary)

    grams = sets.select("s", "common", F.explode("lower").alias("gram"))
    several = scratch.save(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"))
    met = grams.join(several, "gram").groupBy("s").agg(F.first("common").alias("common"), F.collect_list(F.struct("sets", "gram")).alias("met")).where("size(met) >= common")
    prefix = met.select("s", F.size("met").alias("m"), F.expr("slice(sort_array(met), 1, size(met) - common + 1)").alias("prefix"))
    posted = scratch.save(prefix.select("s", "m", F.explode("prefix.gram").alias("gram")))
    shared = posted.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram")
    posts = scratch.save(posted.join(shared, "gram").select("gram", "s", "m"))
    whole, sets = sets, scratch.save(sets.select("s", "id", *signature, F.size("lower").alias("size_lower"), *parity))
    scratch.drop(several, posted, whole)
    labels = _links(sets, posts, texts, Threshold(num, den), words, parity, signature, scratch)

    ids = scratch.save(labels.join(sets.select("s", "id"), "s").groupBy("part").agg(F.min("id").alias("least")))
    named = sets.select("s", "id", *signature).join(labels.join(ids, "part"), "s", "left")
    named = scratch.save(named.select(*signature, F.coalesce("part", "s").alias("part"), F.when(F.col("part").isNull(), F.col("id")).otherwise(F.col("least")).alias("least")))
    scratch.keep(rows, named)
    out = rows.join(named, signature, "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"), "part", *(F.col(k).alias(c) for c, k in zip(keep, carried, strict=True)))


def _links(sets: DataFrame, posts: DataFrame, texts: DataFrame, limit: Threshold, words: int, parity: list[str], signature: list[str], scratch: Scratch) -> DataFrame:
    """(s, part): the component of each set that shares a posted n-gram, known by its least set."""
    once = scratch.save(posts.groupBy("s").agg(F.first("m").alias("m")))
    labels = scratch.save(once.select("s", F.col("s").alias("part")))
    if posts.isEmpty():
        return labels
    chosen = scratch.save(sets.join(once, "s").select("s", "id", *signature, *parity, (1 - F.col("m") / F.col("size_lower")).alias("own_share")))
    digests = chosen.select("s", "n", *parity)
    # Texts are read again, and none is dealt out whose set can't be among the chosen.
    bloom = share(sets.sparkSession, _bloom(chosen))
    read = texts.select("text").mapInArrow(_fragments(words, bloom), "sig1 long, sig2 long, n long, parts array<array<long>>").groupBy(*signature).agg(F.any_value("parts").alias("parts"))
    segments = scratch.save(read.join(chosen.select("s", *signature), signature).select("s", F.posexplode("parts").alias("fragment", "tokens")))

    links = tested = None
    num, den = limit.num, limit.den
    differing = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in parity), F.lit(0))
    room = F.expr(f"{den - num} * (a_n + b_n)")
    # All parities go along with every posted n-gram of the last round: 128 cells in place of the 512 let pairs through that grow with the square of a block.
    bounds = (F.abs(F.col("a_n") - F.col("b_n")) * (den + num) <= room) & (differing * (den + num) <= room)
    side = lambda t, c: t.select(F.col("s").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("n", *parity)))
    turn, stars, posted = 0, True, once.count()
    while True:
        block = posts.select("gram", "s").join(labels, "s")
        rank = F.struct("own_share", "s") if turn == 0 else F.struct(F.xxhash64("s", F.lit(turn)), "s")
        leaders = (block.join(chosen.select("s", "own_share"), "s") if turn == 0 else block).groupBy("gram").agg(F.min_by("s", rank).alias("a"), F.min("part").alias("lo"), F.max("part").alias("hi"))
        # Written, so that in the joins below a hot n-gram's rows can be split among tasks.
        lead = scratch.save(leaders.where("lo < hi").select("gram", "a").join(labels.select(F.col("s").alias("a"), F.col("part").alias("a_part")), "a"))
        if stars:
            pairs = block.join(lead, "gram").where("part <> a_part").select("a", F.col("s").alias("b")).distinct()
            pairs = pairs.join(side(digests, "a"), "a").join(side(digests, "b"), "b")
        else:
            rest = scratch.save(block.join(lead.select("gram"), "gram").join(digests, "s"))
            ends = lambda c: rest.select("gram", F.col("s").alias(c), F.col("part").alias(f"{c}_part"), *(F.col(x).alias(f"{c}_{x}") for x in ("n", *parity)))  # noqa: E731, B023
            pairs = ends("a").join(ends("b"), "gram").where("a < b and a_part <> b_part")
        pairs = pairs.where(bounds).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), differing.alias("gap"), F.col("b").alias("own")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        if stars:  # one leader for each set, the likeliest
            pairs = pairs.groupBy("own").agg(F.min(F.struct("gap", "a", "b")).alias("x")).select("x.a", "x.b")
        pairs = scratch.save(pairs.select("a", "b").distinct())
        ends_of = pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct()
        needed = segments.join(ends_of, "s", "left_semi")
        part = lambda c: needed.select(F.col("s").alias(c), "fragment", F.col("tokens").alias(f"{c}_tokens"))  # noqa: E731, B023
        counted = pairs.join(part("b"), "b").join(part("a"), ["a", "fragment"]).select("a", "b", F.size(F.array_intersect("a_tokens", "b_tokens")).alias("both"), (F.size("a_tokens") + F.size("b_tokens")).alias("total"))
        counted = counted.groupBy("a", "b").agg(F.sum("both").alias("both"), F.sum("total").alias("total"))
        new = scratch.save(counted.where(f"{den} * both >= {num} * (total - both)").select("a", "b"))
        links = new if links is None else links.unionByName(new)
        tested = pairs if tested is None else tested.unionByName(pairs)
        scratch.drop(lead)
        old, labels = labels, scratch.save(once.join(connected_components(links, scratch), F.col("s") == F.col("id"), "left").select("s", F.coalesce("component", "s").alias("part")))
        scratch.drop(old)
        if not stars:
            return labels
        stars, turn = STAR_SHARE * new.count() >= posted, turn + 1

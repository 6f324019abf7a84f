"""Packing documents into sequences of bounded length by a grouping genetic algorithm."""

from __future__ import annotations

import math
import os
import random
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from heapq import nsmallest
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.plans.shared import materialise
from tidegrid.plans.ship import ship

#: Documents that one island holds at a time, islands for each shard, epochs with
#: migration between them, individuals and generations of an epoch.
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 4096, 2, 2, 6, 24
#: Bins of a crossover that exchange items, and loose items of which pairs are tried at a time.
EXCHANGES, PAIRED = 64, 48
#: White space of the pattern by which the tokenizer cuts text, and where such a cut always is
#: in wider white space: before its last character, if something follows.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE = re.compile(f"[{_SPACE}]{{2}}")
_CUT = re.compile(f"(?<=[{_SPACE}])(?=[{_SPACE}][^{_SPACE}])")


class _Encoder:
    """Token ids (little-endian bytes) of whole texts.

    Ids of a byte-level tokenizer are the ranks of its merges, so its vocabulary gives
    the same ids to an encoder by ranks, which is several times as fast. Texts that
    hold the string of a special token go to the tokenizer itself. The pattern by which
    text is cut looks ahead only to leave the last of several white-space characters to
    what follows. Texts are cut there first, so the pattern goes without and is matched
    by an automaton.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN

        self.path = path
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # bytes that print stand for themselves in the vocabulary, the others for what follows 255
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        del self.tokenizer  # few texts need it, and workers keep their encoder
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.ranked = tiktoken.Encoding("byte_level", pat_str=PATTERN.replace(r"\s+(?!\S)|", ""), mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif _WIDE.search(text):
            ids = [i for part in _CUT.split(text) for i in self.ranked.encode_ordinary(part)]
        else:
            ids = self.ranked.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)


#: A worker makes its encoder once.
_encoder = lru_cache(maxsize=1)(_Encoder)


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, size: int, end: int) -> Iterator[pa.RecordBatch]:
    encoder, last = _encoder(path), np.array([end], "<u4").tobytes()
    for batch in batches:
        out: dict[str, list] = {"doc": [], "piece": [], "start": [], "length": [], "crc": []}
        for i, text in enumerate(batch.column(1)):
            ids = encoder.ids(text.as_py() or "") + last
            n = len(ids) // 4
            stop = (n - 1) % size + 1  # the first piece takes the remainder
            start = piece = 0
            while start < n:
                out["doc"].append(i)
                out["piece"].append(piece)
                out["start"].append(start)
                out["length"].append(stop - start)
                out["crc"].append(zlib.crc32(memoryview(ids)[4 * start : 4 * stop]))
                start, stop, piece = stop, stop + size, piece + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(out["doc"], pa.int64())), pa.array(out["piece"], pa.int32()), *[pa.array(out[k], pa.int64()) for k in ("start", "length", "crc")]],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


Bins = list[list[int]]


def _best_fit(items: list[int], sizes: list[int], bins: Bins, loads: list[int], size: int) -> None:
    """Put items, largest first, into the fullest bin with room; open bins where none has."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    mask = 0
    for b, load in enumerate(loads):
        if load < size:
            by_room[size - load].append(b)
            mask |= 1 << (size - load)
    for i in items:
        s = sizes[i]
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b = size, len(bins)
            bins.append([])
            loads.append(0)
        bins[b].append(i)
        loads[b] += s
        by_room[room - s].append(b)
        mask |= 1 << (room - s)


def _worth(individual: tuple[Bins, list[int]]) -> tuple[int, int]:
    """Fewer bins first, then more uneven loads: they leave room that can be emptied."""
    return -len(individual[0]), sum(load * load for load in individual[1])


def _exchange(bins: Bins, loads: list[int], loose: list[int], sizes: list[int], size: int, rng: random.Random) -> list[int]:
    """Give bins with room up to two loose items for up to two of theirs, where these fill them better; what is loose then.

    EXCHANGES bins are drawn, and pairs are looked for among PAIRED loose items at a time. What a bin gives away is
    smaller than what it takes, so loose items become easier to fit.
    """
    loose = sorted(loose, key=lambda i: sizes[i])
    for b in rng.sample(range(len(bins)), min(EXCHANGES, len(bins))):
        room = size - loads[b]
        if not room or not loose:
            continue
        held = [sizes[i] for i in loose]
        first = rng.randrange(max(1, len(loose) - PAIRED + 1))
        gain, out, new = 0, (), ()
        for given in ((), *((i,) for i in bins[b]), *combinations(bins[b], 2)):
            own = sum(sizes[i] for i in given)
            k = bisect_right(held, own + room) - 1
            if k >= 0 and held[k] - own > gain:
                gain, out, new = held[k] - own, given, (k,)
            low, high = first, min(len(loose), first + PAIRED) - 1
            while low < high:
                both = held[low] + held[high]
                if both > own + room:
                    high -= 1
                    continue
                if both - own > gain:
                    gain, out, new = both - own, given, (low, high)
                low += 1
            if gain == room:
                break
        if gain:
            bins[b] = [i for i in bins[b] if i not in out] + [loose[k] for k in new]
            loads[b] += gain
            loose = sorted([*(i for k, i in enumerate(loose) if k not in new), *out], key=lambda i: sizes[i])
    return loose


def _cross(a: tuple[Bins, list[int]], b: tuple[Bins, list[int]], sizes: list[int], size: int, rng: random.Random) -> tuple[Bins, list[int]]:
    """Inject well-filled bins of b into a, drop a's bins that repeat their items and a few of its emptiest, fit the rest again."""
    share = rng.uniform(0.2, 0.5)
    chosen = [(items, load) for items, load in zip(*b) if load >= size - 1 and rng.random() < share]
    bins, loads = [list(items) for items, _ in chosen], [load for _, load in chosen]
    taken = {i for items in bins for i in items}
    blurred = [load + size / 16 * rng.random() for load in a[1]]
    order = nsmallest(6, range(len(blurred)), key=blurred.__getitem__)
    emptied, loose = set(order[: rng.randint(3, 6)]), []
    for k, (items, load) in enumerate(zip(*a)):
        if k not in emptied and taken.isdisjoint(items):
            bins.append(list(items))
            loads.append(load)
        else:
            loose += [i for i in items if i not in taken]
    loose = _exchange(bins, loads, loose, sizes, size, rng)
    _best_fit(loose[::-1], sizes, bins, loads, size)
    return bins, loads


def best_fit_decreasing(sizes: list[int], size: int) -> tuple[Bins, list[int]]:
    bins: Bins = []
    loads: list[int] = []
    _best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, bins, loads, size)
    return bins, loads


def evolved(sizes: list[int], size: int, people: list[tuple[Bins, list[int]]], rng: random.Random) -> list[tuple[Bins, list[int]]]:
    """The population after an epoch, best first; an empty one begins with the best fit of decreasing sizes.

    Others begin from blurred orders of sizes. A packing into the fewest bins that the
    sum of sizes allows ends the search.
    """
    least = -(-sum(sizes) // size)
    people = sorted(people or [best_fit_decreasing(sizes, size)], key=_worth, reverse=True)[:POPULATION]
    if len(people[0][0]) == least:
        return people
    while len(people) < POPULATION:
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + 0.15 * rng.random()))
        bins: Bins = []
        loads: list[int] = []
        _best_fit(order, sizes, bins, loads, size)
        people.append((bins, loads))
    ranked = [(_worth(x), x) for x in people]
    for _ in range(GENERATIONS):
        ranked.sort(key=lambda x: x[0], reverse=True)
        if len(ranked[0][1][0]) == least:
            break
        (_, a), (_, b) = rng.sample(ranked[: POPULATION // 2 + 1], 2)
        child = _cross(a, b, sizes, size, rng)
        ranked[-1] = _worth(child), child
    return [x for _, x in sorted(ranked, key=lambda x: x[0], reverse=True)]


def _evolve(rows: pd.DataFrame, size: int, epoch: int) -> pd.DataFrame:
    """One epoch of one island; ``people`` has each individual's bin of the row, ``migrant`` that of its neighbour's best."""
    rows = rows.sort_values("row", ignore_index=True)
    sizes = rows["length"].tolist()
    rng = random.Random(f"{rows['shard'].iat[0]}/{rows['island'].iat[0]}/{epoch}")
    known = []
    if len(rows["people"].iat[0]):
        for places in [*np.stack(rows["people"].to_list()).T, rows["migrant"].to_numpy()]:
            bins: Bins = [[] for _ in range(int(places.max()) + 1)]
            for i, b in enumerate(places.tolist()):
                bins[b].append(i)
            known.append((bins, np.bincount(places, rows["length"]).astype(np.int64).tolist()))
    people = evolved(sizes, size, known, rng)
    places = np.zeros((len(rows), len(people)), np.int32)
    for k, (bins, _) in enumerate(people):
        places[[i for items in bins for i in items], k] = np.repeat(np.arange(len(bins)), [len(items) for items in bins])
    offset, load = np.zeros(len(rows), np.int64), np.array(people[0][1])[places[:, 0]]
    for items in people[0][0]:
        at = 0
        for i in items:
            offset[i], at = at, at + sizes[i]
    out = rows.assign(people=list(places), bin=places[:, 0].astype(np.int64), offset=offset, load=load, bins=len(people[0][0]))
    return out[["row", "shard", "island", "length", "people", "bin", "offset", "load", "bins"]]


def _epoch(size: int, epoch: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: _evolve(rows, size, epoch)


_EVOLVED = "row long, shard long, island int, length long, people array<int>, bin long, offset long, load long, bins long"


def _pack(items: DataFrame, shards: int, level: int, size: int) -> DataFrame:
    """Best packing of every shard: ``row, length, shard, bin, offset, load``."""
    dealt = items.select("row", "length", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)).alias("shard"))
    people = dealt.select("*", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"), F.array().cast("array<int>").alias("people"), F.lit(-1).cast("long").alias("migrant"))
    for epoch in range(EPOCHS):
        after = materialise(people.groupBy("shard", "island").applyInPandas(_epoch(size, epoch), _EVOLVED), "islands")
        elite = after.select("row", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bin").alias("migrant"))
        people = after.select("row", "length", "shard", "island", "people").join(elite, ["row", "island"])
    best = after.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("best"))
    return after.join(best, "shard").where("island = best.island").select("row", "length", "shard", "bin", "offset", "load")


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end: int = 2) -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``. A document is its text's ids (null: none) and ``end``;
    longer ones are cut into pieces of ``size``, of which the first takes the
    remainder. ``tokenizer`` is the path of a byte-level tokenizer file, the same
    on all machines. Rows that repeat an id are packed as rows of their own; an
    empty table gives no sequence; other columns are not read.

    Full pieces are sequences already. The others are dealt by a hash to shards of
    about 4096, each evolved on two islands, which keep their populations and exchange
    their best packing between epochs. Sequences with room left in the best packing are emptied, and
    their pieces from all shards are dealt anew, until one shard holds what is
    left or nothing more is gained.
    """
    ship(docs.sparkSession)
    pieces = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        lambda batches: _tokenise(batches, tokenizer, size, end),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long",
    )
    pieces = materialise(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    settled = pieces.where(F.col("length") == size).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = pieces.where(F.col("length") < size).select("row", "length")
    n, level = items.count(), 0
    while n:
        shards = max(1, math.ceil(n / SHARD))
        packed = materialise(_pack(items, shards, level, size), "packed")
        last = shards == 1 or level == 8
        done = packed if last else packed.where(F.col("load") >= size - 1)
        sequence = F.expr(f"shiftleft({level}L, 58) + shiftleft(shard, 20) + bin").alias("sequence_id")
        settled = settled.unionByName(done.select("row", sequence, "offset"))
        if last:
            break
        items = packed.where(F.col("load") < size - 1).select("row", "length")
        before, n, level = n, items.count(), level + 1
        if n > 0.9 * before:
            settled = settled.unionByName(packed.where(F.col("load") < size - 1).select("row", sequence, "offset"))
            break
    return pieces.join(settled, "row").drop("row")

"""Packing of tokenized documents into fixed-size sequences by a grouping genetic algorithm.

`token_pieces` encodes every document once (documents longer than a sequence are cut);
only narrow rows of lengths go on. Pieces are dealt by hash to blocks of about
`block_rows`; each block is one packing problem, solved on several islands. An island
holds a small population of packings, which starts from pieces in random orders. Crossover
injects whole well-filled bins of one parent into another, drops the bins that held the same
pieces, and puts displaced pieces back by best fit. Between epochs each island's best packing
migrates to the next island of its block. A block that meets its lower bound (total length /
capacity) stops early; one that ends above it takes best-fit-decreasing if that is better.

Blocks are independent tasks of bounded size, so memory does not depend on the corpus;
each block gives away less than one sequence. Epochs are written to the shared folder.

Edge cases: a null text is empty and is packed as its end token alone; repeated rows are
packed once each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from plumbline.llm.arrow import chunks
from plumbline.llm.catalogue import query
from plumbline.session import stage

CAPACITY = 4096
END = 1
# words of Latin-1 letters, ASCII digits and ASCII marks without the apostrophe: their
# pre-tokens are the letter runs, the single digits and the runs of marks
SIMPLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
CACHE_WORDS = 700_000


def _byte_letters() -> list[str]:
    """Printable stand-ins of the 256 bytes as byte-level tokenizers write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordIds(dict):
    """Ids (packed unsigned 32-bit) by word, filled on demand and emptied when full.

    The tokenizer never joins text across white space, so the ids of a text are those of
    its words in a row. Simple words go to the model pre-token by pre-token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.parts = self.tokenizer.model, {}
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_in = re.compile("|".join(added) or r"(?!)").search
        self.letters = _byte_letters()

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            shown = text if text.isascii() else "".join(self.letters[b] for b in text.encode())
            ids = [t.id for t in self.model.tokenize(shown)]
            found = self.parts[text] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        low = word.lower()
        pieces = SIMPLE.findall(low)
        if len("".join(pieces)) == len(low) and not self.special_in(word):
            found = b"".join(map(self.part, pieces))
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        spaced = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.__getitem__, spaced.split(" ")))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32); `row` is unique."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
    tail = np.array([end], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches):
        ids, row = word_ids(tokenizer), TaskContext.get().partitionId() << 36
        for part in chunks(batches, "text"):
            out = ([], [], [], [], [], [])
            keys = part.column("doc_id")
            for i, value in enumerate(part.column("text").to_pylist()):
                packed = ids.encode(value or "") + tail
                for n, at in enumerate(range(0, len(packed), step)):
                    piece = packed[at : at + step]
                    for column, x in zip(out, (row, i, n, at // 4, len(piece) // 4, zlib.crc32(piece))):
                        column.append(x)
                    row += 1
            arrays = [pa.array(c, pa.int32() if j == 2 else pa.int64()) for j, c in enumerate(out)]
            arrays[1] = keys.take(arrays[1])
            yield pa.RecordBatch.from_arrays(arrays, names)

    return narrow.mapInArrow(run, f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# --- one block ---------------------------------------------------------------------


Packing = tuple[np.ndarray, list[int]]  # bin of each piece, and the bins' loads


def best_fit(order: np.ndarray, lengths: np.ndarray, capacity: int, start: Packing | None = None) -> Packing:
    """Put the pieces in `order` one by one where the least room is left; open a bin if none has room."""
    number, loads = (np.full(len(lengths), -1), []) if start is None else (start[0].copy(), list(start[1]))
    rooms: dict[int, list[int]] = {}
    mask = 0
    for b, load in enumerate(loads):
        if load < capacity:
            rooms.setdefault(capacity - load, []).append(b)
            mask |= 1 << capacity - load
    placed = []
    for size in lengths[order].tolist():
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = rooms[room]
            b = own.pop()
            if not own:
                mask ^= 1 << room
            loads[b] += size
        else:
            room, b = capacity, len(loads)
            loads.append(size)
        placed.append(b)
        if room > size:
            rooms.setdefault(room - size, []).append(b)
            mask |= 1 << room - size
    number[order] = placed
    return number, loads


def _fitness(packing: Packing) -> tuple[int, float]:
    """Fewer bins are better; then fuller ones."""
    loads = np.array(packing[1], float)
    return -len(loads), float(loads @ loads)


def _cross(a: Packing, b: Packing, lengths: np.ndarray, capacity: int, rng) -> Packing:
    """Inject about half of b's well-filled bins into a: a's bins with the same pieces go, and
    their other pieces are put back by best fit."""
    loads_a, loads_b = np.array(a[1]), np.array(b[1])
    chosen = (loads_b >= np.quantile(loads_b, 0.3)) & (rng.random(len(loads_b)) < 0.5)
    taken = chosen[b[0]]
    hit = np.zeros(len(loads_a), bool)
    hit[a[0][taken]] = True
    place_a, place_b = np.cumsum(~hit) - 1, np.cumsum(chosen) - 1 + (~hit).sum()
    number = np.where(taken, place_b[b[0]], np.where(hit[a[0]], -1, place_a[a[0]]))
    loose = np.flatnonzero(number < 0)
    loads = [*loads_a[~hit].tolist(), *loads_b[chosen].tolist()]
    return best_fit(loose[np.argsort(-lengths[loose], kind="stable")], lengths, capacity, (number, loads))


def _mutate(a: Packing, lengths: np.ndarray, capacity: int, rng) -> Packing:
    """Dissolve the emptiest bin and a few others; refill, roughly the longest pieces first."""
    loads = np.array(a[1])
    drop = np.zeros(len(loads), bool)
    drop[[loads.argmin(), *rng.integers(0, len(loads), max(1, len(loads) // 50))]] = True
    number = np.where(drop[a[0]], -1, (np.cumsum(~drop) - 1)[a[0]])
    loose = np.flatnonzero(number < 0)
    order = loose[np.argsort(-lengths[loose] * rng.uniform(0.8, 1.2, len(loose)), kind="stable")]
    return best_fit(order, lengths, capacity, (number, loads[~drop].tolist()))


def evolve(lengths: np.ndarray, seeds: list[Packing], capacity: int, rng, population: int, generations: int) -> Packing:
    """The best packing of a population that starts from `seeds`, or from pieces in random orders."""
    bound = -(-int(lengths.sum()) // capacity)
    people = list(seeds)
    while len(people) < population:
        mate = _mutate(seeds[len(people) % len(seeds)], lengths, capacity, rng) if seeds else best_fit(rng.permutation(len(lengths)), lengths, capacity)
        people.append(mate)
    scored = sorted(((_fitness(p), i, p) for i, p in enumerate(people)), key=lambda x: x[:2], reverse=True)
    for n in range(generations):
        if len(scored[0][2][1]) <= bound:
            break
        x, y = rng.integers(0, len(scored), 2)
        child = _mutate(_cross(scored[x][2], scored[y][2], lengths, capacity, rng), lengths, capacity, rng)
        scored = sorted([*scored, (_fitness(child), len(people) + n, child)], key=lambda s: s[:2], reverse=True)[:population]
    return scored[0][2]


def settled(best: Packing, lengths: np.ndarray, capacity: int) -> Packing:
    """The packing, or best-fit-decreasing where that needs fewer bins."""
    if len(best[1]) <= -(-int(lengths.sum()) // capacity):
        return best
    plain = best_fit(np.argsort(-lengths, kind="stable"), lengths, capacity)
    return plain if len(plain[1]) < len(best[1]) else best


def _epoch(items: DataFrame, islands: int, capacity: int, population: int, generations: int, epoch: int, last: bool) -> DataFrame:
    """(row, block, island, bin, bins): each island's best packing."""

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1])
        group = group.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        lengths = group["length"].to_numpy()
        seeds = []
        if group["elites"].iloc[0] is not None:
            elites = np.stack(group["elites"].to_numpy())
            numbers = [elites[:, k] for k in (island, (island - 1) % islands)]
            seeds = [(n.astype(np.int64), np.bincount(n, lengths).astype(np.int64).tolist()) for n in numbers]
        best = evolve(lengths, seeds, capacity, np.random.default_rng([block, island, epoch]), population, generations)
        number, loads = settled(best, lengths, capacity) if last else best
        return pd.DataFrame({"row": group["row"], "block": block, "island": island, "bin": number.astype(np.int32), "bins": len(loads)})

    dealt = items.withColumn("island", F.explode(F.array(*map(F.lit, range(islands)))))
    return dealt.groupBy("block", "island").applyInPandas(run, "row long, block long, island int, bin int, bins int")


def pack(
    pieces: DataFrame,
    *,
    capacity: int = CAPACITY,
    block_rows: int = 16_384,
    islands: int = 3,
    epochs: int = 2,
    population: int = 4,
    generations: int = 12,
) -> DataFrame:
    """Adds sequence_id and offset to pieces (row, length, ...); reads `pieces` several times, so stage them."""
    blocks = max(1, -(-pieces.count() // block_rows))
    items = pieces.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    state = items.withColumn("elites", F.lit(None).cast("array<int>"))
    for epoch in range(epochs):
        best = stage(_epoch(state, islands, capacity, population, generations, epoch, epoch + 1 == epochs), f"epoch{epoch}")
        if epoch + 1 < epochs:
            slots = [F.max(F.when(F.col("island") == k, F.col("bin"))) for k in range(islands)]
            state = items.join(best.groupBy("row").agg(F.array(*slots).alias("elites")), "row")
    winner = best.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("w")).select(F.col("block").alias("w_block"), F.col("w.island").alias("w_island"))
    chosen = best.join(winner, (F.col("block") == F.col("w_block")) & (F.col("island") == F.col("w_island")))
    placed = chosen.select("row", (F.shiftleft("block", 32) + F.col("bin")).alias("sequence_id"))
    inside = W.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(W.unboundedPreceding, -1)
    return pieces.join(placed, "row").withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))


def packed_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = stage(token_pieces(docs, tokenizer), "pieces")
    return pack(pieces, **options).drop("row")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_best_fit_packing")
def op10_best_fit_packing(t) -> DataFrame:
    return packed_documents(t("documents"), tokenizer_path())

"""Problem 8: fill containers of fixed capacity with documents, measured in tokens of a public tokenizer.

Only sizes matter for what fits, and there are at most ``capacity`` of them: the corpus is reduced to a histogram of
at most 2 048 rows, which is packed on the driver by bin completion, and the documents then take the places of their
size. So the packing is global, exact in its counts, and no document or id ever travels to the driver.

Bin completion (branch and bound), the same for every number of items: the incumbent is best-fit decreasing over the histogram. A node takes the largest
remaining size and enumerates the undominated fillings of the room beside it, least waste and largest items first; it branches on
them, each used as often as the counts allow or once. The first one is looked for by itself, the others when the search comes back to the node. A branch is cut when its waste so far already costs
as many containers as the best solution known, and the search stops at the lower bound (Martello and Toth's L2). ``STEPS`` bounds
the steps of the whole search and ``VISITS`` those of one enumeration; the best solution found by then stands, and :func:`report` gives it beside best-fit and the bound.

A document larger than a container is cut into full containers and a rest, which is packed like any other. The rank of
a document among those of its size is counted in two steps over parts by hash, so a size that a third of the
documents have is no single task.

Defined results: null and empty texts have 0 tokens and stand once with no container; repeated rows are packed each;
an empty corpus gives no rows.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.runtime import is_small, materialize

CAPACITY, STEPS, VISITS, FILLINGS = 2048, 1_000_000, 2_000, 64
#: Rows of a part within which the documents of one size are ranked, and the least number of parts.
PART_ROWS, PARTS = 200_000, 64
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
# Fixed value: how the public byte-level vocabulary cuts text into words before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

Filling = tuple[int, ...]


def completions(counts: dict[int, int], room: int, limit: int, nodes: int, spent: list[int] | None = None) -> list[Filling]:
    """Undominated fillings of ``room``, least waste first and among these largest items first: none can take another
    item, and in none two items could give way to one that fits in their place. At most ``nodes`` steps are made, and no more once ``limit`` fillings
    without waste are known; ``spent`` counts the steps."""
    sizes = sorted((s for s, n in counts.items() if n > 0 and s <= room), reverse=True)
    negative = [-s for s in sizes]
    found: list[tuple[int, Filling]] = []
    left = {s: counts[s] for s in sizes}
    budget, full = nodes, 0

    def visit(at: int, room: int, chosen: list[int]) -> bool:
        """Whether to stop."""
        nonlocal budget, full
        budget -= 1
        fits = bisect.bisect_left(negative, -room)
        more = False
        for k in range(max(at, fits), len(sizes)):
            s = sizes[k]
            if left[s] == 0:
                continue
            more = True
            left[s] -= 1
            chosen.append(s)
            stop = visit(k, room - s, chosen)
            chosen.pop()
            left[s] += 1
            if stop or budget <= 0:
                return True
        if not more and not any(left[s] for s in sizes[fits:at]) and not _dominated(chosen, room, left):
            found.append((room, tuple(chosen)))
            full += room == 0
        return full >= limit

    visit(0, room, [])
    if spent is not None:
        spent[0] += nodes - budget
    found.sort(key=lambda f: (f[0], tuple(-s for s in f[1])))
    return list(dict.fromkeys(c for _, c in found))[: max(limit, 1)] or [_greedy(counts, room)]


def _dominated(chosen: list[int], waste: int, left: dict[int, int]) -> bool:
    """Whether a larger item could take the place of one or of two chosen ones. Looks a bounded way; missing a case only
    leaves one more branch."""
    if 0 < waste and any(left.get(t, 0) > 0 for s in set(chosen) for t in range(s + 1, s + min(waste, 32) + 1)):
        return True
    pairs = {a + b for i, a in enumerate(chosen) for b in chosen[i + 1 :]} if len(chosen) <= 12 else set()
    return any(left.get(s, 0) > 0 for p in pairs for s in range(p, min(p + waste, p + 8) + 1))


def _greedy(counts: dict[int, int], room: int) -> Filling:
    out = []
    left = dict(counts)
    for s in sorted(left, reverse=True):
        while s <= room and left[s] > 0:
            left[s] -= 1
            room -= s
            out.append(s)
    return tuple(out)


Packing = list[tuple[Filling, int]]


def least_containers(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Martello and Toth's lower bound L2: for each threshold, items that leave less room than it need a container each, those above half
    too, and the items between the threshold and half fill what room the latter leave."""
    sizes = [s for s, n in counts.items() if n > 0]
    best = -(-sum(s * counts[s] for s in sizes) // capacity)
    for k in sorted({s for s in sizes if 2 * s <= capacity} | {0}):
        alone = sum(counts[s] for s in sizes if s > capacity - k)
        large = [s for s in sizes if s <= capacity - k and 2 * s > capacity]
        n = sum(counts[s] for s in large)
        room = n * capacity - sum(s * counts[s] for s in large)
        rest = sum(s * counts[s] for s in sizes if 2 * s <= capacity and s >= k)
        best = max(best, alone + n + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Packing:
    """Best-fit decreasing over a histogram: containers of the same filling are handled together."""
    open_: dict[int, dict[Filling, int]] = {}  # room: filling: containers
    rooms: list[int] = []

    def put(room: int, filling: Filling, times: int) -> None:
        if times:
            if room not in open_:
                open_[room] = {}
                bisect.insort(rooms, room)
            open_[room][filling] = open_[room].get(filling, 0) + times

    for s in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        left = counts[s]
        while left:
            at = bisect.bisect_left(rooms, s)
            if at == len(rooms):
                room, filling, times = capacity, (), left
            else:
                room = rooms[at]
                filling, times = open_[room].popitem()
                if not open_[room]:
                    del open_[room], rooms[at]
            each = room // s  # a container is filled before the next one of its room is begun
            full = min(times, left // each)
            put(room - each * s, filling + (s,) * each, full)
            left -= full * each
            if full < times:
                some = min(left, each) if left < each else 0
                if some:
                    put(room - some * s, filling + (s,) * some, 1)
                    left -= some
                if filling:
                    put(room, filling, times - full - (some > 0))
    return [(f, n) for of in open_.values() for f, n in of.items()]


def n_containers(packing: Packing) -> int:
    return sum(n for _, n in packing)


def pack(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> Packing:
    """(filling, times) of containers that hold all items; every size is between 1 and ``capacity``."""
    left = {s: n for s, n in counts.items() if n > 0}
    if not left:
        return []
    best = best_fit(left, capacity)
    fewest, bound = n_containers(best), least_containers(left, capacity)
    total = sum(s * n for s, n in left.items())

    spent = [0]

    def branches() -> Iterator[tuple[Filling, int]]:
        top = max(left)
        tried: set[Filling] = set()
        for limit in (1, FILLINGS):
            left[top] -= 1
            fillings = completions(left, capacity - top, limit, VISITS, spent)
            left[top] += 1
            for fill in fillings:
                if fill not in tried:
                    tried.add(fill)
                    filling = (top, *fill)
                    most = min(left[s] // filling.count(s) for s in set(filling))
                    yield filling, most
                    if most > 1:
                        yield filling, 1

    def take(filling: Filling, times: int) -> None:
        for s in set(filling):
            left[s] -= times * filling.count(s)
            if not left[s]:
                del left[s]

    def give_back(filling: Filling, times: int) -> None:
        for s in filling:
            left[s] = left.get(s, 0) + times

    chosen: Packing = []
    used = waste = 0
    stack = [branches()]
    while stack and spent[0] < steps and fewest > bound:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                filling, times = chosen.pop()
                give_back(filling, times)
                used -= times
                waste -= times * (capacity - sum(filling))
            continue
        spent[0] += 1
        filling, times = step
        lost = waste + times * (capacity - sum(filling))
        if -(-(total + lost) // capacity) >= fewest:
            continue  # the waste so far and what remains need so many containers at least
        take(filling, times)
        chosen.append(step)
        used, waste = used + times, lost
        if not left:
            if used < fewest:
                best, fewest = list(chosen), used
            chosen.pop()
            give_back(filling, times)
            used, waste = used - times, waste - times * (capacity - sum(filling))
        else:
            stack.append(branches())
    return best


def report(counts: dict[int, int], packing: Packing, capacity: int = CAPACITY) -> dict[str, int]:
    """Containers by best-fit decreasing, by bin completion, and the lower bound."""
    counts = {s: n for s, n in counts.items() if n > 0}
    return {"best_fit": n_containers(best_fit(counts, capacity)), "bin_completion": n_containers(packing), "least": least_containers(counts, capacity) if counts else 0}


def token_counts(documents: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) under the vocabulary file of a public byte-level tokenizer."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        with open(f"{tokenizers}/{vocabulary}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [len(encode(t)) if t else 0 for t in b["text"]]})

    return documents.select("doc_id", "text").mapInPandas(count, "doc_id bigint, n_tokens bigint")


def pieces(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, n_tokens): a document as it is packed; larger ones are cut at whole containers."""
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity).cast("int") - 1)
    cut = sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    return cut.select("doc_id", "piece", (F.col("piece") * capacity).cast("bigint").alias("start"), F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece") * capacity).cast("bigint").alias("n_tokens"))


def assign(sizes: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """(doc_id, piece, start, n_tokens, container) for every piece of every document of ``sizes``."""
    return assigned(sizes, capacity, steps)[0]


def assigned(sizes: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> tuple[DataFrame, dict[str, int]]:
    """:func:`assign` with the :func:`report` of the packing."""
    spark = sizes.sparkSession
    cut = materialize(pieces(sizes, capacity), "pieces")  # ids and sizes
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(PARTS, -(-cut.count() // PART_ROWS)))).cast("int")
    within = Window.partitionBy("n_tokens", "part").orderBy("doc_id", "piece")
    ranked = materialize(cut.withColumn("part", part).withColumn("rank", F.row_number().over(within).cast("bigint") - 1), "ranked")
    cells = ranked.groupBy("n_tokens", "part").agg(F.count(F.lit(1)).alias("n"))  # at most capacity x parts rows
    before = Window.partitionBy("n_tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "cells")
    histogram = {int(r[0]): int(r[1]) for r in cells.filter("n_tokens > 0").groupBy("n_tokens").agg(F.sum("n")).collect()}  # at most capacity rows
    packing = pack(histogram, capacity, steps)
    used: dict[int, int] = {}
    rows, base = [], 0
    for fill, times in packing:
        for s in sorted(set(fill)):
            m = fill.count(s)
            rows.append((s, used.get(s, 0), m * times, times, base))
            used[s] = used.get(s, 0) + m * times
        base += times
    shipped = spark.sparkContext.broadcast(rows)  # one row per step and size

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for s, start, _n, times, first in shipped.value:
            spans.setdefault(s, []).append((start, times, first))
        starts = {s: [x[0] for x in v] for s, v in spans.items()}
        for b in batches:
            out: list[int | None] = []
            for s, r in zip(b["n_tokens"], b["place"]):
                if s == 0:
                    out.append(None)
                    continue
                start, times, first = spans[s][bisect.bisect_right(starts[s], r) - 1]
                out.append(first + (r - start) % times)
            yield pd.DataFrame({"doc_id": b["doc_id"], "piece": b["piece"], "start": b["start"], "n_tokens": b["n_tokens"], "container": pd.array(out, "Int64")})

    offsets = cells.select("n_tokens", "part", "before")
    placed = ranked.join(F.broadcast(offsets) if is_small(offsets) else offsets, ["n_tokens", "part"]).withColumn("place", F.col("rank") + F.col("before"))
    done = placed.select("doc_id", "piece", "start", "n_tokens", "place").mapInPandas(place, "doc_id bigint, piece int, start bigint, n_tokens bigint, container bigint")
    return done, report(histogram, packing, capacity)

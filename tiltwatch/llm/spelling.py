"""Spelling variants: near words found by pivotal grams, each led to its most common form."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import drop_kept, keep

# A run is made of these letters; only A-Z are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Code points of a gram, and edits between near words. The parts below rely on both.
Q, EDITS = 2, 1
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def drop_by_checksum(every: int) -> Callable[[Column, Column], Column]:
    """Noise for :func:`vocabulary`: every so many runs, by crc32 of ``id:run``, lose the code point that it picks."""

    def noise(doc_id: Column, run: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
        at = (h % F.length(run)).cast("int")
        return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)

    return noise


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 7,
    min_count: int = 2,
    noise: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``(word, n)``: every run of letters of whole texts with its number of occurrences.

    Runs are lower-cased (A-Z), then changed by ``noise(id, run)`` if given.
    Words shorter than ``min_length`` code points or rarer than ``min_count``
    are left out. A NULL text has no runs, a NULL id counts as an empty one,
    repeated rows count repeatedly, other columns are ignored.
    """
    # A run may lose one code point to the noise but never gains one.
    wanted = F.lit(f"{LETTERS}{{{min_length},}}")
    lowered = F.translate(F.col(text_col), UPPER, UPPER.lower())
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(lowered, wanted, F.lit(0))).alias("run"))
    words = runs.select((noise(F.col("id"), F.col("run")) if noise else F.col("run")).alias("word"))
    return (
        words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Rank of every gram of two code points, rarest first; ties in code-point order.

    Words are made of 90 letters after lower-casing, so there are at most
    8,100 grams whatever the corpus: that is what reaches the driver.
    """
    grams = words.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(Q))
    )).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {gram: i for i, (_, gram) in enumerate(sorted((r["n"], r["gram"]) for r in rows))}


def prefix(word: str, ranks: dict[str, int]) -> tuple[list[int], int]:
    """Positions of the word's gram prefix, ascending, and the rank of its last gram.

    The prefix is the ``Q * EDITS + 1`` rarest grams, and all more that are as
    rare as the last of them.
    """
    order = [ranks[word[i : i + Q]] for i in range(len(word) - Q + 1)]
    last = sorted(order)[Q * EDITS]
    return [i for i, r in enumerate(order) if r <= last], last


def pivots(positions: list[int], costs: list[int], wanted: int = EDITS + 1) -> list[int]:
    """Positions of ``wanted`` disjoint grams of least total cost, by dynamic programming.

    ``best[k][i]`` is the least cost of ``k`` disjoint grams among the first
    ``i``; equal costs prefer the earlier grams.
    """
    none = float("inf")
    n = len(positions)
    free, j = [], 0
    for i in range(n):  # how many of the grams before i end before it starts
        while positions[j] + Q <= positions[i]:
            j += 1
        free.append(j)
    best = [[0] * (n + 1)] + [[none] * (n + 1) for _ in range(wanted)]
    for k in range(1, wanted + 1):
        for i in range(1, n + 1):
            best[k][i] = min(best[k][i - 1], best[k - 1][free[i - 1]] + costs[i - 1])
    taken, i = [], n
    for k in range(wanted, 0, -1):
        while best[k][i - 1] == best[k][i]:
            i -= 1
        taken.append(positions[i - 1])
        i = free[i - 1]
    return taken[::-1]


def _hashes(word: str) -> tuple[list[int], list[int]]:
    """Rolling hash of each beginning, and the powers to take one from another."""
    sums, powers = [0], [1]
    for c in word:
        sums.append((sums[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    return sums, powers


def _keys(word: str, at: int, side: int, other: int, hashes: tuple[list[int], list[int]]) -> tuple[int, int]:
    """Keys of a gram that no edit touches, shared by near words where the other has ``other`` code points.

    The edit lies right of the gram (side 0: everything up to its end is
    equal) or left of it (side 1: everything from its start is). Of what
    remains, one half is equal as well, halved by the *indexed* word's length.
    """
    sums, powers = hashes
    n = len(word)

    def part(i: int, j: int) -> int:
        return (sums[j] - sums[i] * powers[j - i]) % _PRIME

    fixed = at + Q if side == 0 else n - at
    rest = other - fixed
    first, second = rest // 2, rest - rest // 2
    low, high = (fixed, n) if side == 0 else (0, at)
    equal = part(0, at + Q) if side == 0 else part(at, n)
    found = []
    for half, (i, j) in enumerate(((low, low + first), (high - second, high))):
        if low <= i <= j <= high:
            key = xxhash.xxh64_intdigest(struct.pack("<BqqQQ", 2 * side + half, fixed, other, equal, part(i, j)))
            found.append(key - (1 << 63))
    return found


def postings(word: str, ranks: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Keys under which the word is indexed, keys under which it looks for others, last rank of its prefix."""
    positions, last = prefix(word, ranks)
    hashes, n = _hashes(word), len(word)
    left, right = pivots(positions, [ranks[word[i : i + Q]] for i in positions])
    index = [k for i in positions for side in (0, 1) for k in _keys(word, i, side, n, hashes)]
    # One edit spares the left pivot and all before it, or the right one and all after it.
    search = [
        k for i, side in ((left, 0), (right, 1)) for other in (n - 1, n, n + 1) for k in _keys(word, i, side, other, hashes)
    ]
    return index, search, last


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``, a < b: distinct words of ``(word, n)`` one inserted, deleted or replaced code point apart.

    Pivotal grams: grams are ranked by rarity. Near words share a pivot of
    the one whose prefix ends earlier with the prefix of the other, at a
    position that the single edit allows; keys hold the position, the length
    and a hash of what must be equal there, so a common gram makes no long
    list. Candidates are verified inside the join. Exact: no link is lost and
    no list is cut. Words need four code points or more to have two disjoint
    pivots; shorter ones, and NULL, are ignored.
    """
    words = words.filter(F.length("word") > Q * EDITS + Q - 1)
    ranks = gram_ranks(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(columns[0]), 2000):
                out: tuple[list, ...] = ([], [], [], [], [])
                for word, n in zip(*(c[start : start + 2000] for c in columns)):
                    index, search, last = postings(word, ranks)
                    keys = index + search
                    out[0].extend(keys)
                    out[1].extend([False] * len(index) + [True] * len(search))
                    out[2].extend([word] * len(keys))
                    out[3].extend([n] * len(keys))
                    out[4].extend([last] * len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.string()),
                     pa.array(out[3], pa.int64()), pa.array(out[4], pa.int32())],
                    ["key", "looks", "word", "n", "last"],
                )

    rows = keep(
        words.select("word", F.col("n").cast("long").alias("n"))
        .mapInArrow(run, "key long, looks boolean, word string, n long, last int"),
        "postings",
    )
    looking = rows.filter("looks").select("key", F.col("word").alias("s"), F.col("n").alias("s_n"), F.col("last").alias("s_last"))
    indexed = rows.filter("NOT looks").select("key", F.col("word").alias("r"), F.col("n").alias("r_n"), F.col("last").alias("r_last"))
    near = looking.join(indexed, "key").filter(
        (F.col("s_last") <= F.col("r_last")) & (F.col("s") != F.col("r"))
        & (F.levenshtein("s", "r", EDITS) == EDITS)
    )
    first = F.col("s") < F.col("r")
    return near.select(
        F.when(first, F.col("s")).otherwise(F.col("r")).alias("a"),
        F.when(first, F.col("s_n")).otherwise(F.col("r_n")).alias("a_n"),
        F.when(first, F.col("r")).otherwise(F.col("s")).alias("b"),
        F.when(first, F.col("r_n")).otherwise(F.col("s_n")).alias("b_n"),
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the end of each chain of ``(word, form)``, by doubling the step.

    A form is at least ten times as common as its word, so counts that fit a
    long allow chains of 19 steps, which five rounds cover.
    """
    now = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = keep(
            now.join(ahead, "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        moved = not new.filter("moved").isEmpty()
        drop_kept(now)
        now = new.select("word", "root")
        if not moved:
            return now


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every row of ``(word, n)``, whose words are distinct.

    ``form`` is the near word of the largest count, ties going to the smallest
    in code-point order, if it is at least ``factor`` (10 or more) times as common as the
    word, else NULL. ``root`` follows forms to the last. A word without near
    words has ``n_near`` 0 and is its own root. No words give no rows.
    """
    if factor < 10:
        raise ValueError("a form must be at least ten times as common as its word")
    words = keep(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = keep(near_pairs(words), "near")
    sides = pairs.select("a", "a_n", "b", "b_n").unionAll(pairs.select("b", "b_n", "a", "a_n"))
    led = sides.toDF("word", "n", "other", "other_n").groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    common = -F.col("best.less") >= factor * F.col("n")
    led = keep(
        led.select(
            "word", "n_near", F.when(common, F.col("best.other")).alias("form"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "led",
    )
    roots = _roots(led.filter("form IS NOT NULL"))
    return words.join(led.join(roots, "word", "left"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"),
    )

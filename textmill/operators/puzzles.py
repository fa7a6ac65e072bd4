"""Exactly checkable puzzles: native enumeration where the space is small, search elsewhere.

Native solvers join a puzzle table with an assignment table of at most a few thousand rows
(bits or permutations of a bounded size) and keep what satisfies every clue. The others run
a bounded search, one puzzle at a time, that stops at the second solution.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest bit or permutation space that is built as a table.
MOST_BITS, MOST_ITEMS = 16, 7


def bit_masks(spark: SparkSession, bits: int) -> DataFrame:
    """All masks of ``bits`` bits: 2^bits rows, a bound that the puzzle size sets."""
    if bits > MOST_BITS:
        raise ValueError(f"{bits} bits are more than {MOST_BITS}")
    return spark.range(1 << bits).withColumnRenamed("id", "mask")


def orders(spark: SparkSession, n: int) -> DataFrame:
    """All orders of n items as arrays of positions: n! rows."""
    if n > MOST_ITEMS:
        raise ValueError(f"{n} items are more than {MOST_ITEMS}")
    return spark.createDataFrame([(list(p),) for p in permutations(range(n))], "places array<int>")


def enumerate_solutions(puzzles: DataFrame, space: DataFrame, holds: Column) -> DataFrame:
    """(puzzle_id, solutions, one) for every puzzle; ``one`` is the least solution's text.

    ``space`` has the candidates with a text column ``shown``; it is small and broadcast.
    """
    tried = puzzles.join(F.broadcast(space), holds, "left")
    return tried.groupBy("puzzle_id").agg(F.count("shown").alias("solutions"), F.min("shown").alias("one"))


def latin_solutions(size: int, fixed: dict[tuple[int, int], int], fits: Callable[[list[list[int]]], bool] | None, limit: int = 2, less: tuple = ()) -> int:
    """Number of latin squares with the given cells, ``less`` pairs (a < b) and final test, up to ``limit``."""
    grid = [[0] * size for _ in range(size)]
    for (r, c), v in fixed.items():
        grid[r][c] = v
    cells = [(r, c) for r in range(size) for c in range(size) if not grid[r][c]]
    found = 0

    def ok(r: int, c: int, v: int) -> bool:
        if any(grid[r][k] == v for k in range(size)) or any(grid[k][c] == v for k in range(size)):
            return False
        for (ar, ac), (br, bc) in less:
            a = v if (ar, ac) == (r, c) else grid[ar][ac]
            b = v if (br, bc) == (r, c) else grid[br][bc]
            if a and b and a >= b:
                return False
        return True

    def search(at: int) -> None:
        nonlocal found
        if found >= limit:
            return
        if at == len(cells):
            found += fits is None or fits(grid)
            return
        r, c = cells[at]
        for v in range(1, size + 1):
            if ok(r, c, v):
                grid[r][c] = v
                search(at + 1)
                grid[r][c] = 0

    search(0)
    return found


def visible(line: list[int]) -> int:
    """How many heights rise above all before them."""
    top = seen = 0
    for x in line:
        if x > top:
            top, seen = x, seen + 1
    return seen


def skyscraper_solutions(size: int, clues: dict[str, list[int]], limit: int = 2) -> int:
    """Squares whose edges show the clued numbers of towers (0: no clue)."""

    def fits(grid: list[list[int]]) -> bool:
        columns = [list(c) for c in zip(*grid)]
        views = {"left": grid, "right": [r[::-1] for r in grid], "top": columns, "bottom": [c[::-1] for c in columns]}
        return all(not n or visible(line) == n for side, lines in views.items() for line, n in zip(lines, clues.get(side, [0] * size)))

    return latin_solutions(size, {}, fits, limit)


def star_solutions(size: int, blocked: set[tuple[int, int]], regions: list[list[int]] | None = None, limit: int = 2) -> int:
    """One star in every row, none touching, at most one in a column, one in each region if given."""
    found = 0

    def search(row: int, chosen: list[int]) -> None:
        nonlocal found
        if found >= limit:
            return
        if row == size:
            found += regions is None or len({regions[r][c] for r, c in enumerate(chosen)}) == size
            return
        for c in range(size):
            if (row, c) not in blocked and c not in chosen and (not chosen or abs(chosen[-1] - c) > 1):
                search(row + 1, [*chosen, c])

    search(0, [])
    return found


def jug_paths(capacities: list[int], goal: int) -> tuple[int, int]:
    """(fewest moves, number of shortest move lists up to 2) to have ``goal`` in some jug, from empty."""
    level, seen, moves = {tuple([0] * len(capacities)): 1}, set(), 0
    while level:
        done = sum(n for state, n in level.items() if goal in state)
        if done:
            return moves, min(done, 2)
        seen |= set(level)
        after: dict[tuple[int, ...], int] = {}
        for state, n in level.items():
            for i, cap in enumerate(capacities):
                nexts = [(*state[:i], cap, *state[i + 1 :]), (*state[:i], 0, *state[i + 1 :])]
                for j in range(len(capacities)):
                    if i != j:
                        poured = min(state[i], capacities[j] - state[j])
                        new = list(state)
                        new[i] -= poured
                        new[j] += poured
                        nexts.append(tuple(new))
                for new in nexts:
                    if new != state and new not in seen:
                        after[new] = min(after.get(new, 0) + n, 2)
        level, moves = after, moves + 1
    return -1, 0


def crypt_solutions(words: list[str], total: str, base: int = 10, limit: int = 2) -> int:
    """Assignments of distinct digits to letters for which the words add up to the total."""
    letters = sorted(set("".join(words) + total))
    weight = dict.fromkeys(letters, 0)
    for word, sign in [*((w, 1) for w in words), (total, -1)]:
        for k, ch in enumerate(reversed(word)):
            weight[ch] += sign * base**k
    order = sorted(letters, key=lambda c: -abs(weight[c]))
    rest = [sum(abs(weight[c]) for c in order[k:]) * (base - 1) for k in range(len(order) + 1)]
    found = 0

    def search(at: int, used: int, value: int) -> None:
        nonlocal found
        if found >= limit or abs(value) > rest[at]:
            return
        if at == len(order):
            found += value == 0
            return
        for d in range(base):
            if not used >> d & 1:
                search(at + 1, used | 1 << d, value + d * weight[order[at]])

    search(0, 0, 0)
    return found


def numbrix_solutions(rows: int, cols: int, given: dict[int, tuple[int, int]], limit: int = 2) -> int:
    """Paths of 0 .. rows*cols-1 over neighbouring cells through the given values' cells."""
    at_cell = {cell: v for v, cell in given.items()}
    found = 0

    def search(value: int, cell: tuple[int, int], used: set[tuple[int, int]]) -> None:
        nonlocal found
        if found >= limit or given.get(value, cell) != cell or at_cell.get(cell, value) != value:
            return
        ahead = next((v for v in range(value + 1, rows * cols) if v in given), None)
        if ahead is not None and abs(given[ahead][0] - cell[0]) + abs(given[ahead][1] - cell[1]) > ahead - value:
            return
        if value == rows * cols - 1:
            found += 1
            return
        r, c = cell
        for new in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
            if 0 <= new[0] < rows and 0 <= new[1] < cols and new not in used:
                search(value + 1, new, used | {new})

    for r in range(rows):
        for c in range(cols):
            search(0, (r, c), {(r, c)})
    return found


def hitori_solutions(grid: list[list[int]], limit: int = 2, seen: list | None = None) -> int:
    """Shadings without repeats in lines, without touching shades, with one white region; ``seen`` gets them."""
    rows, cols, found = len(grid), len(grid[0]), 0
    shade = [[False] * cols for _ in range(rows)]

    def connected() -> bool:
        white = {(r, c) for r in range(rows) for c in range(cols) if not shade[r][c]}
        todo = [white.pop()] if white else []
        while todo:
            r, c = todo.pop()
            near = white & {(r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)}
            white -= near
            todo += near
        return not white

    def search(at: int) -> None:
        nonlocal found
        if found >= limit:
            return
        if at == rows * cols:
            if connected():
                found += 1
                if seen is not None:
                    seen.append([list(row) for row in shade])
            return
        r, c = divmod(at, cols)
        if not any(grid[r][k] == grid[r][c] and not shade[r][k] for k in range(c)) and not any(grid[k][c] == grid[r][c] and not shade[k][c] for k in range(r)):
            search(at + 1)
        if not (c and shade[r][c - 1]) and not (r and shade[r - 1][c]):
            shade[r][c] = True
            search(at + 1)
            shade[r][c] = False

    search(0)
    return found


def light_solutions(board: list[str], limit: int = 2, seen: list | None = None) -> int:
    """Lamp placements on '.', walls '#' or digits: all lit, no lamp sees another, digits met; ``seen`` gets them."""
    rows, cols = len(board), len(board[0])
    open_cells = [(r, c) for r in range(rows) for c in range(cols) if board[r][c] == "."]
    beams: dict[tuple[int, int], set[tuple[int, int]]] = {}
    for r, c in open_cells:
        beam = {(r, c)}
        for dr, dc in ((0, 1), (1, 0), (0, -1), (-1, 0)):
            y, x = r + dr, c + dc
            while 0 <= y < rows and 0 <= x < cols and board[y][x] == ".":
                beam.add((y, x))
                y, x = y + dr, x + dc
        beams[r, c] = beam
    digits = {(r, c): int(board[r][c]) for r in range(rows) for c in range(cols) if board[r][c].isdigit()}
    found = 0

    def search(at: int, lamps: frozenset) -> None:
        nonlocal found
        if found >= limit:
            return
        if at == len(open_cells):
            lit = set().union(*(beams[x] for x in lamps)) if lamps else set()
            near = lambda r, c: sum((y, x) in lamps for y, x in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)))
            if len(lit) == len(open_cells) and all(near(*cell) == n for cell, n in digits.items()):
                found += 1
                if seen is not None:
                    seen.append(lamps)
            return
        if not beams[open_cells[at]] & lamps:
            search(at + 1, lamps | {open_cells[at]})
        search(at + 1, lamps)

    search(0, frozenset())
    return found


def countdown_expressions(numbers: list[int], goal: int, limit: int = 2) -> tuple[int, int]:
    """(fewest operations, distinct canonical expressions with that many, up to ``limit``).

    Minus only to a positive result, divide only exactly and not by 1, no times 1; the
    operands of plus and times stand in order of (value, text).
    """
    n = len(numbers)
    table: dict[int, dict[tuple[int, str], int]] = {1 << k: {(v, str(v)): 0} for k, v in enumerate(numbers)}
    for mask in sorted(range(1, 1 << n), key=lambda m: m.bit_count()):
        if mask.bit_count() == 1:
            continue
        out: dict[tuple[int, str], int] = {}
        part = (mask - 1) & mask
        while part:
            if part > mask ^ part:
                for (a, x), na in table.get(part, {}).items():
                    for (b, y), nb in table.get(mask ^ part, {}).items():
                        (lo, lx), (hi, hx) = sorted(((a, x), (b, y)))
                        new = [(lo + hi, f"({lx}+{hx})")]
                        if lo > 1:
                            new.append((lo * hi, f"({lx}*{hx})"))
                            if hi % lo == 0:
                                new.append((hi // lo, f"({hx}/{lx})"))
                        if hi > lo:
                            new.append((hi - lo, f"({hx}-{lx})"))
                        for key in new:
                            out[key] = na + nb + 1
            part = (part - 1) & mask
        table[mask] = out
    hits = {text: ops for group in table.values() for (v, text), ops in group.items() if v == goal}
    least = min(hits.values(), default=-1)
    return least, min(limit, sum(ops == least for ops in hits.values()))


def zebra_solutions(houses: int, axes: dict[str, list[str]], clues: list[tuple], limit: int = 2) -> int:
    """Assignments of every axis's values to houses under clues (kind, a, b): same, left, beside, at."""
    names = list(axes)
    place: dict[str, int] = {}
    found = 0

    def holds() -> bool:
        for kind, a, b in clues:
            x = place.get(a)
            y = b if kind == "at" else place.get(b)
            if x is None or y is None:
                continue
            if kind in ("same", "at") and x != y or kind == "left" and x + 1 != y or kind == "beside" and abs(x - y) != 1:
                return False
        return True

    def search(k: int) -> None:
        nonlocal found
        if found >= limit:
            return
        if k == len(names):
            found += 1
            return
        for order in permutations(range(houses)):
            place.update(zip(axes[names[k]], order))
            if holds():
                search(k + 1)
        for v in axes[names[k]]:
            place.pop(v, None)

    search(0)
    return found


def search_udf(rows: DataFrame, solve: Callable[[dict], int], schema: str = "puzzle_id long, family string, solutions long") -> DataFrame:
    """(puzzle_id, family, solutions) of rows (puzzle_id, family, spec JSON), one puzzle at a time."""
    import json

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = [solve({"family": f, **json.loads(s)}) for f, s in zip(frame.family, frame.spec)]
            yield pd.DataFrame({"puzzle_id": frame.puzzle_id, "family": frame.family, "solutions": counts})

    return rows.mapInPandas(run, schema)


def solve(spec: dict) -> int:
    """Solutions of a puzzle by family, up to 2."""
    kind = spec["family"]
    cells = lambda d: {tuple(map(int, k.split(","))): v for k, v in d.items()}
    if kind == "futoshiki":
        return latin_solutions(spec["size"], cells(spec["given"]), None, 2, tuple((tuple(a), tuple(b)) for a, b in spec["less"]))
    if kind == "skyscraper":
        return skyscraper_solutions(spec["size"], spec["clues"])
    if kind in ("starbattle", "blocked_star"):
        return star_solutions(spec["size"], {tuple(x) for x in spec.get("blocked", [])}, spec.get("regions"))
    if kind == "jug":
        return jug_paths(spec["capacities"], spec["goal"])[1]
    if kind == "cryptarithmetic":
        return crypt_solutions(spec["words"], spec["total"], spec.get("base", 10))
    if kind == "numbrix":
        return numbrix_solutions(spec["rows"], spec["cols"], {int(v): tuple(c) for v, c in spec["given"].items()})
    if kind == "hitori":
        return hitori_solutions(spec["grid"])
    if kind == "lightup":
        return light_solutions(spec["board"])
    if kind == "countdown":
        return countdown_expressions(spec["numbers"], spec["goal"])[1]
    if kind == "zebra":
        return zebra_solutions(spec["houses"], spec["axes"], [tuple(c) for c in spec["clues"]])
    raise ValueError(kind)

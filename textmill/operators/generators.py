"""Puzzle rows: generate until exactly one solution is left, render the answer, parse and check one.

Every family has a maker (a seeded draw of a specification and its solution text) and a
parser (answer text to a value, null on malformed text). A maker draws, tightens its clues
and asks the solver; the seed comes from the row's identity, so a retried task makes the
same puzzle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import combinations, permutations, product
from random import Random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import row_seed
from . import puzzles as Z

Made = tuple[dict, str]
NAMES = ("Ada", "Bo", "Cy", "Di", "Ed")


def grid_text(rows: list[list]) -> str:
    return "\n".join(" ".join(map(str, r)) for r in rows)


def latin(rng: Random, n: int) -> list[list[int]]:
    """A latin square: a cyclic one with rows, columns and values shuffled."""
    rows, cols, values = (rng.sample(range(n), n) for _ in range(3))
    return [[values[(r + c) % n] + 1 for c in cols] for r in rows]


def tighten(rng: Random, clues: list, count: Callable[[list], int]) -> list:
    """Clues in random order until one solution is left, then without those that are not needed."""
    rng.shuffle(clues)
    kept: list = []
    for clue in clues:
        kept.append(clue)
        if count(kept) == 1:
            break
    for clue in list(kept):
        less = [c for c in kept if c is not clue]
        if count(less) == 1:
            kept = less
    return kept


def futoshiki(rng: Random, n: int = 4) -> Made:
    g = latin(rng, n)
    pairs = [((r, c), x) for r, c in product(range(n), repeat=2) for x in ((r, c + 1), (r + 1, c)) if max(x) < n]
    less = [list(map(list, p if g[p[0][0]][p[0][1]] < g[p[1][0]][p[1][1]] else p[::-1])) for p in rng.sample(pairs, n)]
    cells = [(r, c, g[r][c]) for r, c in product(range(n), repeat=2)]
    spec = lambda kept: {"family": "futoshiki", "size": n, "given": {f"{r},{c}": v for r, c, v in kept}, "less": less}
    return spec(tighten(rng, cells, lambda kept: Z.solve(spec(kept)))), grid_text(g)


def skyscraper(rng: Random, n: int = 4) -> Made:
    while True:
        g = latin(rng, n)
        cols = [list(c) for c in zip(*g)]
        clues = {side: [Z.visible(x) for x in lines] for side, lines in (("left", g), ("right", [r[::-1] for r in g]), ("top", cols), ("bottom", [c[::-1] for c in cols]))}
        if Z.skyscraper_solutions(n, clues) == 1:
            return {"size": n, "clues": clues}, grid_text(g)


def star(rng: Random, n: int = 5) -> Made:
    spots = [p for p in permutations(range(n)) if all(abs(a - b) > 1 for a, b in zip(p, p[1:]))]
    chosen = rng.choice(spots)
    free = [[r, c] for r in range(n) for c in range(n) if chosen[r] != c]
    blocked = tighten(rng, free, lambda kept: Z.star_solutions(n, {tuple(x) for x in kept}))
    return {"size": n, "blocked": blocked}, grid_text([["*" if chosen[r] == c else "." for c in range(n)] for r in range(n)])


def numbrix(rng: Random, n: int = 4) -> Made:
    path = [(r, c if r % 2 == 0 else n - 1 - c) for r in range(n) for c in range(n)]
    for _ in range(60):  # backbite: a new end is spliced into the path
        r, c = path[-1]
        new = rng.choice([x for x in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)) if 0 <= min(x) and max(x) < n])
        k = path.index(new)
        path[k + 1 :] = path[:k:-1]
        if rng.random() < 0.3:
            path.reverse()
    cells = list(enumerate(path))
    given = tighten(rng, cells, lambda kept: Z.numbrix_solutions(n, n, dict(kept)) if len(kept) > 2 else 2)
    where = {cell: v for v, cell in cells}
    return {"rows": n, "cols": n, "given": {str(v): list(x) for v, x in given}}, grid_text([[where[r, c] for c in range(n)] for r in range(n)])


def jug(rng: Random, n: int = 2) -> Made:
    while True:
        caps = rng.sample(range(3, 12), n)
        goal = rng.randint(1, max(caps) - 1)
        moves, ways = Z.jug_paths(caps, goal)
        if ways == 1 and moves > 2:
            return {"capacities": caps, "goal": goal}, str(moves)


def cryptarithmetic(rng: Random) -> Made:
    while True:
        a, b = rng.randint(11, 99), rng.randint(11, 99)
        digits = sorted(set(f"{a}{b}{a + b}"))
        code = dict(zip(digits, rng.sample("ABCDEFGHIJ", len(digits))))
        words, total = ["".join(code[d] for d in str(x)) for x in (a, b)], "".join(code[d] for d in str(a + b))
        if Z.crypt_solutions(words, total) == 1:
            return {"words": words, "total": total}, " ".join(f"{ch}={d}" for d, ch in sorted(code.items(), key=lambda x: x[1]))


def countdown(rng: Random) -> Made:
    while True:
        numbers, goal = sorted(rng.sample(range(2, 13), 4)), rng.randint(20, 99)
        ops, ways = Z.countdown_expressions(numbers, goal)
        if ops > 1 and ways == 1:
            return {"numbers": numbers, "goal": goal}, str(ops)


def hitori(rng: Random, n: int = 4) -> Made:
    while True:
        g = latin(rng, n)
        for _ in range(n):
            r, c, k = (rng.randrange(n) for _ in range(3))
            g[r][c] = g[r][k] if rng.random() < 0.5 else g[k][c]
        seen: list = []
        if Z.hitori_solutions(g, 2, seen) == 1 and any(map(any, seen[0])):
            return {"grid": g}, grid_text([["#" if s else "." for s in row] for row in seen[0]])


def lightup(rng: Random, n: int = 4) -> Made:
    while True:
        walls = {tuple(rng.randrange(n) for _ in range(2)) for _ in range(n + 1)}
        board = ["".join(("#" if rng.random() < 0.4 else str(rng.randint(0, 2))) if (r, c) in walls else "." for c in range(n)) for r in range(n)]
        seen: list = []
        if Z.light_solutions(board, 2, seen) == 1 and seen[0]:
            return {"board": board}, grid_text([["L" if (r, c) in seen[0] else board[r][c] for c in range(n)] for r in range(n)])


def zebra(rng: Random, n: int = 3) -> Made:
    axes = {"color": ["red", "blue", "green"], "pet": ["cat", "dog", "fish"], "drink": ["tea", "milk", "water"]}
    at = {v: k for values in axes.values() for k, v in enumerate(rng.sample(values, n))}
    clues: list = [["at", v, k] for v, k in at.items()]
    for a, b in permutations(at, 2):
        if at[a] == at[b]:
            clues.append(["same", a, b])
        elif at[a] + 1 == at[b]:
            clues.append(["left", a, b])
        elif abs(at[a] - at[b]) == 1:
            clues.append(["beside", a, b])
    kept = tighten(rng, clues, lambda some: Z.zebra_solutions(n, axes, [tuple(c) for c in some]))
    rows = [[next(v for v in values if at[v] == k) for values in axes.values()] for k in range(n)]
    return {"houses": n, "axes": axes, "clues": kept}, grid_text(rows)


def lineup_count(n: int, clues: list) -> int:
    ok = {"before": lambda p, a, b: p[a] < p[b], "next": lambda p, a, b: abs(p[a] - p[b]) == 1, "at": lambda p, a, b: p[a] == b}
    return sum(all(ok[k](p, a, b) for k, a, b in clues) for p in permutations(range(n)))


def lineup(rng: Random, n: int = 4) -> Made:
    place = rng.sample(range(n), n)
    clues: list = [["at", a, place[a]] for a in range(n)]
    clues += [["before", a, b] for a, b in permutations(range(n), 2) if place[a] < place[b]]
    clues += [["next", a, b] for a, b in combinations(range(n), 2) if abs(place[a] - place[b]) == 1]
    kept = tighten(rng, clues, lambda some: lineup_count(n, some))
    return {"people": list(NAMES[:n]), "clues": kept}, " ".join(NAMES[a] for a in sorted(range(n), key=lambda a: place[a]))


def kakurasu_sums(mask: int, n: int) -> tuple[list[int], list[int]]:
    cells = [(k // n, k % n) for k in range(n * n) if mask >> k & 1]
    return [sum(c + 1 for r, c in cells if r == k) for k in range(n)], [sum(r + 1 for r, c in cells if c == k) for k in range(n)]


def kakurasu(rng: Random, n: int = 3) -> Made:
    while True:
        mask = rng.randrange(1, 1 << n * n)
        sums = kakurasu_sums(mask, n)
        if sum(kakurasu_sums(m, n) == sums for m in range(1 << n * n)) == 1:
            return {"size": n, "rows": sums[0], "cols": sums[1]}, grid_text([[mask >> (r * n + c) & 1 for c in range(n)] for r in range(n)])


def knights_count(n: int, says: list) -> int:
    holds = {"knave": lambda m, b: not m >> b & 1, "knight": lambda m, b: m >> b & 1 == 1, "count": lambda m, b: m.bit_count() == b}
    return sum(all((m >> a & 1 == 1) == holds[kind](m, b) for a, kind, b in says) for m in range(1 << n))


def knights(rng: Random, n: int = 4) -> Made:
    while True:
        says = [[a, (kind := rng.choice(["knave", "knight", "count"])), rng.randint(0, n) if kind == "count" else rng.randrange(n)] for a in range(n)]
        if knights_count(n, says) == 1:
            mask = next(m for m in range(1 << n) if knights_count_one(m, says))
            return {"speakers": n, "says": says}, " ".join("knight" if mask >> k & 1 else "knave" for k in range(n))


def knights_count_one(mask: int, says: list) -> bool:
    holds = {"knave": lambda b: not mask >> b & 1, "knight": lambda b: mask >> b & 1 == 1, "count": lambda b: mask.bit_count() == b}
    return all((mask >> a & 1 == 1) == holds[kind](b) for a, kind, b in says)


def splits(n: int, subsets: list) -> list[int]:
    """Masks with the first element in group A in which every subset meets both groups."""
    return [m for m in range(0, 1 << n, 2) if all(len({m >> e & 1 for e in s}) == 2 for s in subsets)]


def setsplitting(rng: Random, n: int = 5) -> Made:
    while True:
        subsets = [rng.sample(range(n), rng.randint(2, 3)) for _ in range(n)]
        found = splits(n, subsets)
        if len(found) == 1:
            return {"elements": n, "subsets": subsets}, " ".join("AB"[found[0] >> e & 1] for e in range(n))


MAKERS: dict[str, Callable[[Random], Made]] = {
    "futoshiki": futoshiki, "skyscraper": skyscraper, "blocked_star": star, "numbrix": numbrix, "jug": jug, "cryptarithmetic": cryptarithmetic, "countdown": countdown,
    "hitori": hitori, "lightup": lightup, "zebra": zebra, "lineup": lineup, "kakurasu": kakurasu, "knights": knights, "setsplitting": setsplitting,
}


def solutions(family: str, spec: dict) -> int:
    """Solutions of a made puzzle, up to two for the search families."""
    if family == "lineup":
        return lineup_count(len(spec["people"]), spec["clues"])
    if family == "kakurasu":
        return sum(kakurasu_sums(m, spec["size"]) == (spec["rows"], spec["cols"]) for m in range(1 << spec["size"] ** 2))
    if family == "knights":
        return knights_count(spec["speakers"], spec["says"])
    if family == "setsplitting":
        return len(splits(spec["elements"], spec["subsets"]))
    return Z.solve({"family": family, **spec})


#: Shape of an answer by family: cells of a grid, words of a line, assignments, or a number.
CELL = {"futoshiki": r"\d+", "skyscraper": r"\d+", "numbrix": r"\d+", "hitori": "[.#]", "kakurasu": "[01]", "blocked_star": r"[*.]", "lightup": r"[L.#\d]", "zebra": "[a-z]+"}


def parse_target(family: str, text: str | None) -> list | None:
    """The answer as rows of cells or a list of words; null on malformed text."""
    lines = [line.split() for line in (text or "").strip().splitlines() if line.strip()]
    if not lines:
        return None
    if family in CELL:
        square = len({len(x) for x in lines}) == 1
        return lines if square and all(re.fullmatch(CELL[family], c) for x in lines for c in x) else None
    if len(lines) != 1:
        return None
    shape = {"jug": r"\d+", "countdown": r"\d+", "cryptarithmetic": r"[A-Z]=\d", "knights": "knights?|knaves?", "setsplitting": "[AB]", "lineup": r"\w+"}[family]
    return lines[0] if all(re.fullmatch(shape, w) for w in lines[0]) else None


def is_correct(family: str, answer: str | None, target: str) -> bool:
    got = parse_target(family, answer)
    return got is not None and got == parse_target(family, target)


def generate(keys: DataFrame, seed: int = 0) -> DataFrame:
    """(puzzle_id, family, spec, target) for rows (puzzle_id, family)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [MAKERS[f](Random(int(s, 16))) for f, s in zip(frame.family, frame.seed)]
            yield pd.DataFrame({"puzzle_id": frame.puzzle_id, "family": frame.family, "spec": [json.dumps(s) for s, _ in made], "target": [t for _, t in made]})

    seeded = keys.select("puzzle_id", "family", row_seed(F.lit(seed), F.col("family"), F.col("puzzle_id")).alias("seed"))
    return seeded.mapInPandas(run, "puzzle_id long, family string, spec string, target string")


def check(rows: DataFrame, answer: str = "target") -> DataFrame:
    """(puzzle_id, family, solutions, parseable, correct) of made puzzles and an answer column."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {
                    "puzzle_id": frame.puzzle_id,
                    "family": frame.family,
                    "solutions": [solutions(f, json.loads(s)) for f, s in zip(frame.family, frame.spec)],
                    "parseable": [parse_target(f, a) is not None for f, a in zip(frame.family, frame[answer])],
                    "correct": [is_correct(f, a, t) for f, a, t in zip(frame.family, frame[answer], frame.target)],
                }
            )

    return rows.mapInPandas(run, "puzzle_id long, family string, solutions long, parseable boolean, correct boolean")

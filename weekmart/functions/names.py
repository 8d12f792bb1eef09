"""Column-name rules.  Names are metadata, so these run on the driver over
the list of names only; the data never leaves the executors.

Spark resolves names without regard to case, so names that differ only in
case clash."""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count, groupby


def _split_qualified(name: str) -> tuple[str, str]:
    """('Table', 'column') of ``Table[column]``; ('', bare name) otherwise."""
    table, bracket, rest = name.partition("[")
    column, closed, _ = rest.partition("]")
    if bracket and closed and column and table:
        return table, column
    return "", name.strip("[]")


def _positions(names: list[str]) -> dict[str, list[int]]:
    """Positions of each name, case aside."""
    groups: dict[str, list[int]] = defaultdict(list)
    for i, name in enumerate(names):
        groups[name.lower()].append(i)
    return groups


def bare_names(columns: list[str]) -> list[str]:
    """Drop the ``Table[...]`` qualifier unless two columns would share the
    bare name; then every clashing column keeps its qualified name."""
    split = [_split_qualified(c) for c in columns]
    out = [column for _, column in split]
    for places in _positions(out).values():
        for i in places if len(places) > 1 else ():
            if split[i][0]:
                out[i] = columns[i]
    return out


def match_names(have: list[str], wanted: list[str]) -> dict[str, int]:
    """For each wanted name that ``have`` holds, case aside, its position: the same
    spelling if there is one, else the first."""
    places = _positions(have)
    out: dict[str, int] = {}
    for name in wanted:
        found = places.get(name.lower(), [])
        if found:
            out[name] = next((i for i in found if have[i] == name), found[0])
    return out


def safe_name(name: str) -> str:
    """SQL-safe identifier: the runs of letters and digits (of any script)
    joined by single underscores; ``col`` if there is none, and ``c_`` before
    a leading digit."""
    runs = ["".join(chars) for wordy, chars in groupby(name, str.isalnum) if wordy]
    if not runs:
        return "col"
    joined = "_".join(runs)
    return f"c_{joined}" if joined[0].isdigit() else joined


def safe_names(columns: list[str]) -> list[str]:
    """safe_name for each column.  The first column of a name keeps it; its
    repeats get the first numbers that are free (``a``, ``a!``, ``a_1``)."""
    out: list[str] = []
    taken: set[str] = set()
    for wanted in map(safe_name, columns):
        free = (n for n in chain([wanted], (f"{wanted}_{k}" for k in count(1)))
                if n.lower() not in taken)
        out.append(next(free))
        taken.add(out[-1].lower())
    return out

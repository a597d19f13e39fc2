"""Nested windows built from one another instead of rescanning every frame.

Spark evaluates a sliding frame of ``n`` rows in ``O(n)`` per row. When each
window length is a small multiple of the one before (5, 10, 20, 60), a frame is
the union of earlier frames of the same series shifted by whole windows, so only
the shortest one is scanned and the others need one ``lag`` per block:

    sum20[t] = sum10[t] + sum10[t - 10]

Nothing is subtracted, hence no cancellation as with differences of running
totals, and a null anywhere in a block makes the result null, which is exactly
the full-frame gate. Second moments are merged from block means and block
moments (pairwise form), so a constant frame keeps a variance of exactly zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.rolling import frame, gated

MAX_BLOCKS = 4
SHORTEST = 4


def chain(n: int) -> tuple[int, ...]:
    """Nested windows ending in ``n``, each 2, 3 or 4 times the one before.

    A length without such factors is a chain of itself: one plain frame.
    """
    out = [n]
    while True:
        block = next((k for k in (3, 2) if out[0] % k == 0 and out[0] // k >= SHORTEST), None)
        if block is None:
            return tuple(out)
        out.insert(0, out[0] // block)


def nests(windows: Sequence[int]) -> bool:
    """True when every window is 2..4 times the one before."""
    return all(b % a == 0 and 2 <= b // a <= MAX_BLOCKS for a, b in zip(windows, windows[1:]))


def state(name: str, n: int, part: str) -> str:
    return f"_{name}_{part}{n}"


class Ladder:
    """Steps for :func:`tidemark.operators.frames.over_rows` over nested ``windows``.

    ``sums`` and ``maxima`` map names to SQL expressions, ``pairs`` maps names to
    the two columns of a correlation. Results are read with :meth:`total`,
    :meth:`peak`, :meth:`variance` and :meth:`corr`.
    """

    def __init__(
        self,
        windows: Sequence[int],
        sums: Mapping[str, str] | None = None,
        maxima: Mapping[str, str] | None = None,
        pairs: Mapping[str, tuple[str, str]] | None = None,
    ):
        if not nests(windows):
            raise ValueError(f"windows {tuple(windows)} do not nest")
        self.windows = tuple(windows)
        self.sums, self.maxima, self.pairs = sums or {}, maxima or {}, pairs or {}

    def steps(self) -> list:
        out = [self._base]
        for shorter, longer in zip(self.windows, self.windows[1:]):
            out.append(self._shifted(shorter, longer // shorter))
            out.append(self._merged(shorter, longer))
        return out

    def total(self, name: str, n: int) -> Column:
        return F.col(state(name, n, "s"))

    def peak(self, name: str, n: int) -> Column:
        return F.col(state(name, n, "x"))

    def variance(self, name: str, n: int) -> Column:
        """Population variance of the first column of a pair."""
        return F.col(state(name, n, "va")) / n

    def corr(self, name: str, n: int) -> Column:
        m2a, m2b, co = (state(name, n, p) for p in ("va", "vb", "co"))
        return F.expr(f"try_divide({co}, sqrt({m2a}) * sqrt({m2b}))")

    def _base(self, w: WindowSpec) -> dict[str, Column]:
        n = self.windows[0]
        f = frame(w, n)
        cols = {}
        for name, sql in self.sums.items():
            x = F.expr(sql)
            cols[state(name, n, "s")] = gated(F.sum(x).over(f), f, n, x)
        for name, sql in self.maxima.items():
            x = F.expr(sql)
            cols[state(name, n, "x")] = gated(F.max(x).over(f), f, n, x)
        for name, (first, second) in self.pairs.items():
            both = f"{first} IS NOT NULL AND {second} IS NOT NULL"
            a = F.expr(f"CASE WHEN {both} THEN {first} END")
            b = F.expr(f"CASE WHEN {both} THEN {second} END")
            full = lambda value: gated(value.over(f), f, n, a)
            cols[state(name, n, "ma")] = full(F.avg(a))
            cols[state(name, n, "mb")] = full(F.avg(b))
            cols[state(name, n, "va")] = full(F.var_pop(a)) * n
            cols[state(name, n, "vb")] = full(F.var_pop(b)) * n
            cols[state(name, n, "co")] = full(F.covar_pop(a, b)) * n
        return cols

    def _parts(self, n: int) -> list[str]:
        return [
            *(state(s, n, "s") for s in self.sums),
            *(state(m, n, "x") for m in self.maxima),
            *(state(p, n, k) for p in self.pairs for k in ("ma", "mb", "va", "vb", "co")),
        ]

    def _shifted(self, n: int, blocks: int):
        return lambda w: {
            f"{part}_lag{j}": F.lag(part, j * n).over(w)
            for part in self._parts(n)
            for j in range(1, blocks)
        }

    def _merged(self, shorter: int, longer: int):
        blocks = longer // shorter

        def parts(name: str, kind: str) -> list[str]:
            base = state(name, shorter, kind)
            return [base, *(f"{base}_lag{j}" for j in range(1, blocks))]

        def step(_w: WindowSpec) -> dict[str, Column]:
            sql = {}
            for name in self.sums:
                sql[state(name, longer, "s")] = " + ".join(parts(name, "s"))
            for name in self.maxima:
                xs = parts(name, "x")
                present = " AND ".join(f"{x} IS NOT NULL" for x in xs)
                sql[state(name, longer, "x")] = (
                    f"CASE WHEN {present} THEN greatest({', '.join(xs)}) END"
                )
            for name in self.pairs:
                ma, mb = parts(name, "ma"), parts(name, "mb")
                gaps = [
                    (f"({ma[i]} - {ma[j]})", f"({mb[i]} - {mb[j]})")
                    for i, j in combinations(range(blocks), 2)
                ]
                between = {
                    "va": " + ".join(f"{a} * {a}" for a, _ in gaps),
                    "vb": " + ".join(f"{b} * {b}" for _, b in gaps),
                    "co": " + ".join(f"{a} * {b}" for a, b in gaps),
                }
                for kind, means in (("ma", ma), ("mb", mb)):
                    sql[state(name, longer, kind)] = f"({' + '.join(means)}) / {blocks}D"
                for kind, spread in between.items():
                    within = " + ".join(parts(name, kind))
                    sql[state(name, longer, kind)] = (
                        f"{within} + ({spread}) * {shorter / blocks!r}D"
                    )
            return {name: F.expr(text) for name, text in sql.items()}

        return step

"""Pieces of DuckDB SQL for the oracles, written independently of the Spark expressions."""

from __future__ import annotations

import math

W = "PARTITION BY series_id ORDER BY date"
BARS = """bars AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS open,
    max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume FROM orders GROUP BY ALL)"""
GAPPY = "SELECT *, CASE WHEN day(date) % 7 <> 0 THEN close END AS gappy FROM bars"
ASSET = """asset AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS asset, avg(l_discount) AS rate FROM lineitem GROUP BY ALL)"""


def over(n: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(f: str, x: str, n: int, least: int | None = None) -> str:
    return f"(CASE WHEN count({x}) {over(n)} >= {n if least is None else least} THEN {f}({x}) {over(n)} END)"


def lag(x: str, k: int) -> str:
    return f"{'lag' if k >= 0 else 'lead'}({x}, {abs(k)}) OVER ({W})"


def flag(c: str) -> str:
    return f"coalesce({c}, false)::INTEGER"


def pad(x: str) -> str:
    return f"last_value({x} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def pct(x: str, k: int) -> str:
    return f"({x} / nullif({lag(x, k)}, 0) - 1)"


def up(a: str, b: str) -> str:
    return flag(f"{a} > {b} AND {lag(a, 1)} <= {lag(b, 1)}")


def down(a: str, b: str) -> str:
    return flag(f"{a} < {b} AND {lag(a, 1)} >= {lag(b, 1)}")


def tr() -> str:
    return f"greatest(high - low, abs(high - {lag('close', 1)}), abs(low - {lag('close', 1)}))"


def shown(c: str, d) -> str:
    """A column as it is (None), rounded (a number), or with so many significant digits (text)."""
    if d is None:
        return c
    return f"round({c}, {d}) AS {c}" if isinstance(d, int) else f"CASE WHEN {c} IS NOT NULL THEN CAST(printf('%.{int(d) - 1}e', {c}) AS DOUBLE) END AS {c}"


def joined(oracles: list[str], columns: list[str], keys: str = "series_id, date") -> str:
    """Queries of the same keys side by side."""
    parts = [f"o{k} AS MATERIALIZED ({sql})" for k, sql in enumerate(oracles)]
    return f"WITH {', '.join(parts)} SELECT {keys}, {', '.join(columns)} FROM o0 " + " ".join(f"JOIN o{k} USING ({keys})" for k in range(1, len(oracles)))


def chain(steps: list, out: dict[str, int | None], keys: str = "series_id, date", ctes: tuple[str, ...] = (BARS,), base: str = "bars", tail: str = "") -> str:
    """steps: dicts of new columns, each seeing the ones before, or SQL with {prev}. out: decimals by column (None: as it is)."""
    parts, prev = list(ctes), base
    for k, s in enumerate(steps):
        body = s.format(prev=prev) if isinstance(s, str) else f"SELECT *, {', '.join(f'{e} AS {c}' for c, e in s.items())} FROM {prev}"
        parts.append(f"t{k} AS MATERIALIZED ({body})")
        prev = f"t{k}"
    cols = ", ".join(shown(c, d) for c, d in out.items())
    return f"WITH {', '.join(parts)} SELECT {keys}{', ' if keys else ''}{cols} FROM {prev} {tail}"


def numbered() -> dict[str, str]:
    return {"rn": f"row_number() OVER ({W})"}


def ewm(x: str, span: int, name: str, first: int = 1) -> str:
    """Closed form of the recursive mean, by a join of each row with what still counts; x is there from row `first` on."""
    a = 2 / (span + 1)
    k = math.ceil(36.84 / -math.log(1 - a))
    return f"""SELECT p.*, e.v AS {name} FROM {{prev}} p LEFT JOIN (SELECT x.series_id, x.rn,
        sum(y.{x} * CASE WHEN y.rn = {first} THEN power({1 - a!r}, x.rn - {first}) ELSE {a!r} * power({1 - a!r}, x.rn - y.rn) END) AS v
        FROM {{prev}} x JOIN {{prev}} y ON x.series_id = y.series_id AND y.rn BETWEEN x.rn - {k} AND x.rn AND y.rn >= {first} GROUP BY ALL) e
        ON p.series_id = e.series_id AND p.rn = e.rn"""


def wilder(x: str, n: int, name: str) -> str:
    k = math.ceil(36.84 / -math.log(1 - 1 / n)) + n
    keep = (n - 1) / n
    return f"""SELECT p.*, e.v AS {name} FROM {{prev}} p LEFT JOIN (SELECT x.series_id, x.rn,
        sum(y.{x} * CASE WHEN y.rn <= {n} THEN power({keep!r}, x.rn - {n}) / {n} ELSE power({keep!r}, x.rn - y.rn) / {n} END) AS v
        FROM {{prev}} x JOIN {{prev}} y ON x.series_id = y.series_id AND y.rn BETWEEN x.rn - {k} AND x.rn WHERE x.rn >= {n} GROUP BY ALL) e
        ON p.series_id = e.series_id AND p.rn = e.rn"""


def scorr(a: str, b: str, n: int) -> str:
    x, y = f"(CASE WHEN {b} IS NOT NULL THEN {a} END)", f"(CASE WHEN {a} IS NOT NULL THEN {b} END)"
    s = f"(stddev_pop({x}) {over(n)} * stddev_pop({y}) {over(n)})"
    return f"(CASE WHEN count({x} + {y}) {over(n)} >= {n} AND {s} > 1e-12 THEN covar_pop({x}, {y}) {over(n)} / {s} END)"

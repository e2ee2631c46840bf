"""Plain-text reports of measure tables, each under its header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from gaugeworks.operators.labelling import signature


def header(protocol: Mapping, run_hash: str, reserves: Sequence[str]) -> str:
    """What every measure must be read with: the protocol's signature, the hash of what was measured, and the reserves."""
    return "\n".join([f"protocol {protocol.get('version', '?')} ({signature(protocol)})", f"runs {run_hash}", *[f"reserve: {r}" for r in reserves]])


def table(df: DataFrame, title: str, most: int = 40) -> str:
    """The first rows of a small, ordered table as aligned text; a last line says if there are more."""
    taken = df.limit(most + 1).collect()
    rows = [[("" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)) for v in r] for r in taken[:most]]
    width = [max(map(len, c)) for c in zip(df.columns, *rows, strict=True)] if rows else [len(c) for c in df.columns]
    line = lambda r: "  ".join(v.ljust(w) for v, w in zip(r, width, strict=True)).rstrip()
    return "\n".join([title, line(df.columns), *map(line, rows), *([f"... more than {most} rows"] if len(taken) > most else [])])

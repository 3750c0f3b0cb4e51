"""Exponentially weighted mean and deviation as folds over sorted arrays.

A running state is ``struct(n, mean, c, q)``: number of points, weighted mean,
weighted sum of squared deviations and sum of squared weights, with weights
summing to one. The bias-corrected deviation is ``sqrt(c / (1 - q))``.

The update is linear in the past, so a stretch of points can be summarised
without knowing what came before it and applied to any earlier state later.
That lets long series be folded block by block in parallel.

Functions take and give SQL expression text, which names columns or lambda
variables; ``pyspark.sql.functions.expr`` turns the finished text into a column
in one call, however many terms it has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points appended at once while listing states, to keep array copies short.
CHUNK = 64


def double(x: float) -> str:
    return f"{x!r}D"


def _state(n: str, mean: str, c: str, q: str) -> str:
    return f"named_struct('n', {n}, 'mean', {mean}, 'c', {c}, 'q', {q})"


def first_state(x: str, alpha: float) -> str:
    """State that, once fed ``x``, equals a series holding just ``x``."""
    keep = 1.0 - alpha
    q = (1.0 - alpha * alpha) / (keep * keep) if keep > 0 else 0.0
    return _state("0L", f"CAST({x} AS DOUBLE)", "0D", double(q))


def stored_state(alpha: float) -> str:
    """State of a saved baseline row; a bare (mean, std) is taken as long settled."""
    q = f"coalesce(q, {double(alpha / (2.0 - alpha))})"
    return _state(f"coalesce(n, {2**31}L)", "mean", f"coalesce(c, std * std * (1D - {q}))", q)


def advance(s: str, x: str, alpha: float) -> str:
    """State after one more point."""
    a, keep = double(alpha), double(1.0 - alpha)
    d = f"({x} - {s}.mean)"
    return _state(
        f"{s}.n + 1L",
        f"{s}.mean + {a} * {d}",
        f"{keep} * ({s}.c + {a} * {d} * {d})",
        f"{double((1.0 - alpha) ** 2)} * {s}.q + {double(alpha * alpha)}",
    )


def silent(s: str, k: str, alpha: float) -> str:
    """State after ``k`` more points of 0, in closed form."""
    left = f"pow({double(1.0 - alpha)}, {k})"
    return _state(
        f"{s}.n + {k}",
        f"{left} * {s}.mean",
        f"{left} * {s}.c + {left} * (1D - {left}) * {s}.mean * {s}.mean",
        f"{left} * {left} * {s}.q + {double(alpha / (2.0 - alpha))} * (1D - {left} * {left})",
    )


def state_std(s: str) -> str:
    """Deviation of a state; NULL while fewer than two points were seen."""
    return f"CASE WHEN {s}.n >= 2 AND {s}.q < 1D THEN sqrt({s}.c / (1D - {s}.q)) END"


EMPTY_BLOCK = "named_struct('n', 0L, 'w', 0D, 'mean', 0D, 'c', 0D, 'q', 0D)"


def extend_block(b: str, x: str, alpha: float) -> str:
    """A block's summary after one more point. ``w`` is the weight all points of
    the block have together."""
    a, keep = double(alpha), double(1.0 - alpha)
    w, d = f"({keep} * {b}.w + {a})", f"({x} - {b}.mean)"
    return f"""named_struct(
        'n', {b}.n + 1L,
        'w', {w},
        'mean', {b}.mean + {a} / {w} * {d},
        'c', {keep} * {b}.c + {double(alpha * (1.0 - alpha))} * {b}.w / {w} * {d} * {d},
        'q', {double((1.0 - alpha) ** 2)} * {b}.q + {double(alpha * alpha)})"""


def silent_block(b: str, k: str, alpha: float) -> str:
    """A block's summary after ``k`` more points of 0."""
    left = f"pow({double(1.0 - alpha)}, {k})"
    w = f"({left} * {b}.w + 1D - {left})"
    share = f"{left} * {b}.w / greatest({w}, 1e-300D)"
    return f"""named_struct(
        'n', {b}.n + {k},
        'w', {w},
        'mean', {share} * {b}.mean,
        'c', {left} * {b}.c + {share} * (1D - {left}) * {b}.mean * {b}.mean,
        'q', {left} * {left} * {b}.q + {double(alpha / (2.0 - alpha))} * (1D - {left} * {left}))"""


def after_gap(b: str, p: str, alpha: float, gaps: bool) -> str:
    """A block's summary after point ``p`` and, with ``gaps``, the zeros before it."""
    if not gaps:
        return extend_block(b, f"{p}.value", alpha)
    inner = silent_block(b, f"{p}.gap", alpha)
    return f"aggregate(array({inner}), {EMPTY_BLOCK}, (none, g) -> {extend_block('g', f'{p}.value', alpha)})"


def block_summary(points: str, alpha: float, gaps: bool = False) -> str:
    """Summary of consecutive points, independent of everything before them.

    Points are structs with a ``value`` and, with ``gaps``, a ``gap``: how many
    points of 0 come before it. They are read in place.
    """
    return f"aggregate({points}, {EMPTY_BLOCK}, (b, p) -> {after_gap('b', 'p', alpha, gaps)})"


def apply_block(s: str, block: str, alpha: float) -> str:
    """The state after all points of a summarised block."""
    left = f"pow({double(1.0 - alpha)}, {block}.n)"
    d = f"({block}.mean - {s}.mean)"
    return _state(
        f"{s}.n + {block}.n",
        f"{s}.mean + (1D - {left}) * {d}",
        f"{left} * {s}.c + {block}.c + {left} * (1D - {left}) * {d} * {d}",
        f"{left} * {left} * {s}.q + {block}.q",
    )


def apply_blocks(start: str, blocks: str, alpha: float) -> str:
    """The state after several summarised blocks, structs with a ``summary``."""
    return f"aggregate({blocks}, {start}, (s, b) -> {apply_block('s', 'b.summary', alpha)})"


def final_state(points: str, alpha: float, start: str) -> str:
    return f"aggregate({points}, {start}, (s, p) -> {advance('s', 'p.value', alpha)})"


def all_states(points: str, alpha: float, start: str, gaps: bool = False) -> str:
    """``start`` followed by the state after each point: one more than points."""
    last = "element_at(acc, -1)"
    grown = advance(last, "p.value", alpha)
    if gaps:
        inner = silent(last, "p.gap", alpha)
        grown = f"aggregate(array({inner}), {start}, (none, s) -> {advance('s', 'p.value', alpha)})"
    one_chunk = f"aggregate(chunk, array(element_at(done, -1)), (acc, p) -> concat(acc, array({grown})))"
    chunks = f"""transform(
        sequence(0, greatest(CAST(ceil(size({points}) / {CHUNK}) AS INT) - 1, 0)),
        i -> slice({points}, i * {CHUNK} + 1, {CHUNK}))"""
    return f"aggregate({chunks}, array({start}), (done, chunk) -> concat(done, slice({one_chunk}, 2, {CHUNK})))"


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in deviations; 0 where the deviation is 0."""
    return F.when(std == 0, F.lit(0.0)).otherwise((x - mean) / std)

"""One-sided cumulative sums with resets, as folds and as block summaries.

A sum moves to ``max(0, sum + d)``; beyond the limit it raises an alarm and starts
anew from 0. What a block of steps makes of the sum before it, ``s``, is

  ``greatest(s + a, b)``  while nothing alarms, a max-plus function,
  ``out``                 from the step on that alarms whatever ``s`` was,
  ``pieces``              for larger ``s``: those above ``above`` alarm first at one
                          step, and leave the block with the piece's own sum.

A step makes a new piece only where the running total of steps reaches a new
high, so there are few. Summaries are worked out without knowing ``s``, in
parallel, and applied in time order.

Functions take and give SQL expression text, like those for smoothing.
"""

from __future__ import annotations

from surgelens.functions.smoothing import CHUNK, double

_PIECES = "array<struct<above:double,s:double>>"
# ``high`` is the highest running total so far, ``out`` NULL until all sums alarm.
EMPTY = f"named_struct('a', 0D, 'b', -1e300D, 'high', 0D, 'out', CAST(NULL AS DOUBLE), 'pieces', CAST(array() AS {_PIECES}))"


def moved(s: str, d: str, limit: float) -> str:
    """The sum after a step, and 0 after an alarm."""
    return f"CASE WHEN {s} + {d} > {double(limit)} THEN 0D ELSE greatest(0D, {s} + {d}) END"


def extended(u: str, d: str, limit: float) -> str:
    """A block's summary after one more step."""
    h, a, b = double(limit), f"({u}.a + {d})", f"greatest(0D, {u}.b + {d})"
    kept = f"transform({u}.pieces, p -> named_struct('above', p.above, 's', {moved('p.s', d, limit)}))"
    fresh = f"array(named_struct('above', {h} - {a}, 's', 0D))"
    return f"""named_struct(
        'a', {a},
        'b', {b},
        'high', greatest({u}.high, {a}),
        'out', CASE WHEN {u}.out IS NOT NULL THEN {moved(f'{u}.out', d, limit)} WHEN {b} > {h} THEN 0D END,
        'pieces', CASE WHEN {u}.out IS NULL AND {a} > {u}.high THEN concat({kept}, {fresh}) ELSE {kept} END)"""


def summary(steps: str, limit: float) -> str:
    """Summary of consecutive steps, an array of doubles."""
    return f"aggregate({steps}, {EMPTY}, (u, d) -> {extended('u', 'd', limit)})"


def applied(s: str, u: str) -> str:
    """The sum after a summarised block: pieces are in the order of their steps."""
    alarmed = f"get(filter({u}.pieces, p -> {s} > p.above), 0).s"
    return f"coalesce({alarmed}, {u}.out, greatest({s} + {u}.a, {u}.b))"


def listed(items: str, start: str, grown: str) -> str:
    """``start`` and the state after each item; ``grown`` names ``state`` and ``item``."""
    step = f"aggregate(array(element_at(acc, -1)), {start}, (none, state) -> {grown})"
    one = f"aggregate(chunk, array(element_at(done, -1)), (acc, item) -> concat(acc, array({step})))"
    chunks = f"""transform(
        sequence(0, greatest(CAST(ceil(size({items}) / {CHUNK}) AS INT) - 1, 0)),
        i -> slice({items}, i * {CHUNK} + 1, {CHUNK}))"""
    return f"aggregate({chunks}, array({start}), (done, chunk) -> concat(done, slice({one}, 2, {CHUNK})))"

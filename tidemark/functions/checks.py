"""Row checks as plain predicates (stay inside whole-stage codegen).

A check is ``(condition, reason)``. ``label`` gives the joined reason text
('' when every check passes) and a boolean that is true when none fired.
Filtering on the boolean lets Catalyst drop the reason text entirely when
only good rows are used. A null condition counts as passed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Check = tuple[Column, str]


def label(checks: list[Check], sep: str = ";") -> tuple[Column, Column]:
    reason = F.concat_ws(sep, *[F.when(cond, F.lit(text)) for cond, text in checks])
    fired = reduce(lambda a, b: a | b, [F.coalesce(cond, F.lit(False)) for cond, _ in checks])
    return reason, ~fired

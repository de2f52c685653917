"""Bind values once for use inside array lambdas.

A lambda body is evaluated per element, and anything it mentions from outside is evaluated again each
time. Binding the outside values as fields of a one-element array keeps array expressions linear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body: Callable[..., Column], **values: Column) -> Column:
    """``body(**values)`` with every value evaluated exactly once."""
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.get(F.transform(bound, lambda s: body(**{k: s[k] for k in values})), F.lit(0))

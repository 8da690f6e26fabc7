"""Statistics that stay null where they are undefined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Window means are rounded to this many places before they are graded. Their last bits depend on
# the order in which tasks finish, and a mean that equals a threshold must not change its level.
GRADING_PLACES = 9


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; null for no row, one row or a constant side (``corr`` would raise).

    Rows with a null on either side are left out of all three moments.
    """
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))

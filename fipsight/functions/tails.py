"""Student-t tail probabilities as a JVM-side expression.

P(T > |t|) for ``df`` degrees of freedom equals ``0.5 * I_x(df/2, 1/2)`` with
``x = df / (df + t^2)`` (regularized incomplete beta). The beta function is evaluated by the
Apache Commons Math class that ships with Spark, through the SQL ``java_method`` expression, so no
Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fipsight.functions.casts import _col


def t_tail(t, dof, tails: int = 1) -> Column:
    """One-sided (``tails=1``) or two-sided (``tails=2``) p-value of a t statistic."""
    if tails not in (1, 2):
        raise ValueError("tails must be 1 or 2")
    t_c = _col(t).cast("double")
    d_c = _col(dof).cast("double")
    x = d_c / (d_c + t_c * t_c)
    ibeta = F.call_function(
        "java_method", F.lit("org.apache.commons.math3.special.Beta"), F.lit("regularizedBeta"),
        x, d_c / F.lit(2.0), F.lit(0.5)).try_cast("double")
    return F.when(t_c.isNotNull() & (d_c > 0) & ~F.isnan(t_c), F.lit(0.5 * tails) * ibeta)

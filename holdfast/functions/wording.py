"""Reader-facing wording of model inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast import fixed

#: wording of one-per-category inputs, by the column they come from
CATEGORY_WORDING = {
    "preferred_payment_method": lambda v: "Usually pays by " + v.replace("_", " "),
    "customer_state": lambda v: "Located in " + v,
}


def plain_label(name: str) -> str:
    """Readable name of a model input; a step prefix such as ``numeric__`` is dropped."""
    bare = name.partition("__")[2] or name
    known = fixed.FEATURE_LABELS.get(bare)
    if known is None:
        column = max((c for c in CATEGORY_WORDING if bare.startswith(c + "_")), key=len, default=None)
        known = CATEGORY_WORDING[column](bare[len(column) + 1 :]) if column else bare.replace("_", " ").capitalize()
    return known


def yes_no(label: Column, flag: Column) -> Column:
    """``label: Yes`` or ``No``; NULL is not available."""
    return F.concat(
        label, F.when(flag.isNull(), ": not available").when(flag, ": Yes").otherwise(": No")
    )


def measured(label: Column, value: Column, typical: Column | None = None) -> Column:
    """``label: 1,234`` or ``12.3``, with the typical value of returning customers where known."""
    number = F.when(F.abs(value) < 1000, F.format_number(value, 1)).otherwise(
        F.format_number(value, 0)
    )
    note = F.lit("")
    if typical is not None:
        note = F.coalesce(
            F.concat(
                F.lit(" (typical for returning customers: "), F.format_number(typical, 1), F.lit(")")
            ),
            F.lit(""),
        )
    return F.coalesce(
        F.concat(label, F.lit(": "), number, note), F.concat(label, F.lit(": not available"))
    )

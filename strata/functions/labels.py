"""Display labels for codes and zones."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment type code → label used by the dashboard.
PAYMENT_TYPE_LABELS: dict[int, str] = {
    0: "Flex fare",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}
UNKNOWN_LABEL = "Unknown"
ZONE_LABEL_SEPARATOR = " — "


def payment_label(code: Column, labels: dict[int, str] | None = None) -> Column:
    """Known code → label, other code → ``Type <n>``, NULL → ``Unknown``.

    The map is a literal folded into the plan (no join, no UDF).
    """
    table = labels if labels is not None else PAYMENT_TYPE_LABELS
    lookup = F.create_map(*chain.from_iterable((F.lit(k).cast("bigint"), F.lit(v)) for k, v in table.items()))
    return (
        F.when(code.isNull(), F.lit(UNKNOWN_LABEL))
        .otherwise(
            F.coalesce(
                F.try_element_at(lookup, code.cast("bigint")),
                F.concat(F.lit("Type "), code.cast("bigint").cast("string")),
            )
        )
    )


def zone_label(borough: Column, zone_name: Column) -> Column:
    return F.concat_ws(ZONE_LABEL_SEPARATOR, borough, zone_name)

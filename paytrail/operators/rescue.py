"""What parsing by a fixed schema loses: unreadable texts, mistyped and unknown fields.

Parsing sets a field that does not fit to NULL and skips fields it does not know. Such
fields are kept here as JSON text, with their values as sent. A message that lost nothing is
parsed once only; just odd ones are read again as VARIANT.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail import contract as c

RESCUED, FAULTS = "rescued_fields", "rescue_reason"
UNREADABLE = "json_unreadable"
MISTYPED = "field_mistyped:"


def _known() -> Column:
    return F.array(*(F.lit(name) for name in c.MESSAGE_SCHEMA.names))


def _empty() -> Column:
    """Names of the message's fields that are NULL after parsing."""
    named = (F.when(F.col(name).isNull(), F.lit(name)) for name in c.MESSAGE_SCHEMA.names)
    return F.array_compact(F.array(*named))


def rescue(parsed: DataFrame, text: str = "raw_value") -> DataFrame:
    """Add ``rescued_fields`` and ``rescue_reason``, both NULL where parsing lost nothing.

    The fields are a JSON object of what was lost: fields of an unknown name, null ones included,
    and known fields whose value is not null but became NULL. Names count as written, in upper or
    lower case. The reason is ``json_unreadable`` for a text that is missing, no JSON object or
    names a field twice, which has nothing to rescue; else ``field_mistyped:<name>`` for each
    known field, in the contract's order, joined by pipes. Unknown fields alone are no fault.
    """
    keys = F.json_object_keys(F.col(text))
    odd = (F.size(F.array_except(keys, _known())) > 0) | (F.size(F.array_intersect(keys, _empty())) > 0)
    fields = F.try_parse_json(F.col(text)).cast("map<string, variant>")

    def lost(name: Column, value: Column) -> Column:
        unknown = ~F.array_contains(_known(), name)
        return unknown | (F.array_contains(_empty(), name) & ~F.is_variant_null(value))

    kept = F.map_filter(fields, lost)
    found = F.when(odd, F.when(F.size(kept) > 0, F.to_json(kept)))
    return parsed.withColumn(RESCUED, found).withColumn(FAULTS, F.nullif(_faults(F.col(text)), F.lit("")))


def _faults(text: Column) -> Column:
    keys = F.json_object_keys(F.col(RESCUED))
    mistyped = F.transform(
        F.filter(_known(), lambda name: F.array_contains(keys, name)),
        lambda name: F.concat(F.lit(MISTYPED), name),
    )
    # A text cut off inside may show its keys, but cannot be parsed.
    read = F.json_object_keys(text).isNotNull() & F.try_parse_json(text).isNotNull()
    return F.when(~read, F.lit(UNREADABLE)).when(F.col(RESCUED).isNotNull(), F.concat_ws("|", mistyped))

"""JSON texts as variants, strictly: one whole document or nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def document(text: Column | str) -> Column:
    """The variant of a text that is exactly one JSON document; else null.

    The parser itself stops after a first document. Inside brackets, whatever follows
    makes a second entry or no JSON at all.
    """
    t = F.col(text) if isinstance(text, str) else text
    listed = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))
